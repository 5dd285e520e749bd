"""What several operators here share: staged tables, Arrow batches, word splitting."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from maskline.sources.staging import stage

# A flat part of many texts handled at once inside a task, in characters.
# It bounds the memory of a Python worker; a single longer text is its own part.
SLICE_CHARS = 2_000_000


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the Python workers import this library, as `--py-files` would; once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(), "maskline.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage is cut, nothing is computed twice."""
    return stage(df, label)[0]


def give_back() -> None:
    """Return to the system what the tasks before this one left free in a Python worker.

    Spark keeps its workers between tasks, and the allocators keep what was freed: some 150 MB
    of a worker that has scored, hashed and encoded texts, while others of the executor need it.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def rows_of(batches: Iterator[pa.RecordBatch], text_column: str = "text") -> Iterator[tuple[list, ...]]:
    """Column lists of slices whose texts hold about SLICE_CHARS characters together."""
    for batch in batches:
        columns = [batch.column(i) for i in range(batch.num_columns)]
        sized = batch.column(batch.schema.get_field_index(text_column))
        length = pc.list_value_length if pa.types.is_list(sized.type) else pc.binary_length
        sizes = np.asarray(pc.fill_null(length(sized), 0)).astype(np.int64)
        start, total = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if total and total + size > SLICE_CHARS:
                yield tuple(c.slice(start, i - start).to_pylist() for c in columns)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield tuple(c.slice(start).to_pylist() for c in columns)


def map_rows(df: DataFrame, make: Callable, schema: str | StructType, text_column: str = "text") -> DataFrame:
    """`make(*columns)` over slices of rows; it returns the output columns as lists or Arrow arrays."""
    ship(df.sparkSession)
    arrow = to_arrow_schema(schema if isinstance(schema, StructType) else StructType.fromDDL(schema))

    def run(batches):
        give_back()
        for columns in rows_of(batches, text_column):
            out = make(*columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) if not isinstance(c, pa.Array) else c.cast(f.type) for c, f in zip(out, arrow)],
                schema=arrow,
            )

    return df.mapInArrow(run, schema)


def words_of(text: str | None) -> list[bytes]:
    """ASCII-lower-cased words between ASCII white space (space, 9-13), as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordHashes(dict):
    """64-bit hashes of words, each computed once while it stays in the table."""

    LIMIT = 1_000_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64, element by element (wraps around)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of `size` words, in text order; shorter texts are one run."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, np.uint64)
    size_used = min(size, n)
    out = np.full(n - size_used + 1, size_used, np.uint64)
    for k in range(size_used):
        out = mixed(out + hashes[k : n - size_used + 1 + k] + np.uint64(0x9E3779B97F4A7C15))
    return out


def keep_rows(df: DataFrame, decide: Callable, text_column: str = "text") -> DataFrame:
    """The rows, with all their columns, for which `decide(texts)` says so (a list of booleans)."""
    if len(set(df.columns)) != len(df.columns):
        raise ValueError("column names must differ")
    ship(df.sparkSession)
    place = df.columns.index(text_column)

    def run(batches):
        give_back()
        for batch in batches:
            texts = batch.column(place)
            keep = []
            for (part,) in rows_of([pa.RecordBatch.from_arrays([texts], names=["text"])]):
                keep += decide(part)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return df.mapInArrow(run, df.schema)


def with_row_key(df: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    """The table with a column of a new name that says key and text in one short, never null string."""
    name = "row_key"
    while name in df.columns:
        name += "_"
    parts = F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("null")), F.xxhash64(F.col(text)).cast("string"))
    return df.withColumn(name, parts), name
