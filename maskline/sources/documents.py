"""Reading and writing texts, tables and payloads."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskline.functions.leaves import is_json
from maskline.sources.staging import stage


# Files that a task reads, and what it hands on at once: files, and bytes of them.
TASK_FILES = 20_000
BATCH_FILES, BATCH_BYTES = 1_000, 16 * 1024 * 1024


def read_folder(spark: SparkSession, path: str, lang: str | None = None) -> DataFrame:
    """One row per file below `path`: doc_id (path inside the folder), text, and lang if given.

    A task lists the folder into a staged table of names, and other tasks read the files, so the driver
    never holds a list of them. Which files count is as Spark has it: none that are empty, none
    whose name begins with `_` or `.`. What is no folder (a file, a pattern), or lies where
    `pyarrow.fs` cannot read, is read by Spark itself.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    folder = _uri(files.makeQualified(place).toUri().toASCIIString().rstrip("/"))
    if not (files.exists(place) and files.getFileStatus(place).isDirectory() and _opens(folder)):
        docs = _read_by_spark(spark, path)
    else:
        names, n_files = stage(spark.range(0, 1, 1, 1).mapInArrow(partial(_list_files, folder), "name string"), "files")
        parts = max(spark.sparkContext.defaultParallelism, -(-n_files // TASK_FILES))
        read = names.repartition(parts, "name").mapInArrow(partial(_read_files, folder), "doc_id string, text binary")
        docs = read.select("doc_id", F.col("text").cast("string").alias("text"))
    return docs if lang is None else docs.withColumn("lang", F.lit(lang))


def _read_by_spark(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    # File paths come as URIs, in which a plus is a plus.
    place = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    place = F.regexp_replace(place, r"\A[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    folder = _folder(spark, path)
    # Where a file system reports files under another root, the folder's own name is looked for.
    inside = F.regexp_replace(place, rf"\A.*?/\Q{folder.rsplit('/', 1)[-1]}\E/", "")
    name = F.when(place.startswith(f"{folder}/"), F.substr(place, F.lit(len(folder) + 2))).otherwise(inside)
    return files.select(name.alias("doc_id"), F.col("value").alias("text"))


def _opens(folder: str) -> bool:
    from pyarrow.fs import FileSystem, FileType

    try:
        files, base = FileSystem.from_uri(folder)
        return files.get_file_info(base).type == FileType.Directory
    except (OSError, pa.ArrowException):
        return False


def _counts(name: str) -> bool:
    """Whether Spark reads a file, or looks into a folder, of this name."""
    hidden = name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")
    return not hidden


def _entries(files, folder: str) -> Iterator[tuple[str, bool, int]]:
    """Name, whether it is a folder, and size of what is in a folder; of a local one without a list of all."""
    from pyarrow.fs import FileSelector, FileType, LocalFileSystem

    if isinstance(files, LocalFileSystem):
        with os.scandir(folder) as found:
            for entry in found:
                inside = entry.is_dir()
                yield entry.name, inside, 0 if inside else entry.stat().st_size
    else:
        for info in files.get_file_info(FileSelector(folder)):
            yield info.base_name, info.type == FileType.Directory, info.size or 0


def _list_files(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow.fs import FileSystem

    files, base = FileSystem.from_uri(folder)
    for batch in batches:
        names, left = [], [""] * batch.num_rows
        while left:
            inside = left.pop()
            for name, is_folder, size in _entries(files, f"{base}/{inside}"):
                if not _counts(name):
                    continue
                if is_folder:
                    left.append(f"{inside}{name}/")
                elif size:
                    names.append(inside + name)
                if len(names) == 10 * BATCH_FILES:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["name"])
                    names = []
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["name"])


def _read_files(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow.fs import FileSystem

    files, base = FileSystem.from_uri(folder)

    def handed_on(names: list[str], texts: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.binary())], names=["doc_id", "text"])

    for batch in batches:
        names, texts, size = [], [], 0
        for name in batch.column(0).to_pylist():
            with files.open_input_stream(f"{base}/{name}") as data:  # as Spark, compressed files by their names
                texts.append(data.read())
            names.append(name)
            size += len(texts[-1])
            if len(names) == BATCH_FILES or size >= BATCH_BYTES:
                yield handed_on(names, texts)
                names, texts, size = [], [], 0
        yield handed_on(names, texts)


def _folder(spark: SparkSession, path: str) -> str:
    """The path without scheme, host and last slash, from the root."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(place).toUri().getPath().rstrip("/")


def read_table(spark: SparkSession, path: str, format: str = "parquet", schema=None, **options) -> DataFrame:
    """A table of typed and free-text columns from any format Spark reads."""
    reader = spark.read.format(format).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_payloads(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """JSON payloads, one per line; a malformed line is an error.

    With a schema its fields become columns. Without one, payloads of any shape come as
    the text column `payload`, to be named in `json` when tokenized; blank lines are skipped.
    """
    if schema is not None:
        return spark.read.schema(schema).json(path, mode="FAILFAST")
    lines = spark.read.text(path).where(F.trim("value") != "")
    wrong = F.raise_error("malformed JSON payload").cast("string")
    return lines.select(F.when(F.expr(is_json("value")), F.col("value")).otherwise(wrong).alias("payload"))


def write_documents(docs: DataFrame, path: str, format: str = "parquet") -> None:
    """Rewritten documents with their names as a column, not one file each."""
    docs.write.mode("errorifexists").format(format).save(path)


def write_folder(docs: DataFrame, path: str, *, name: str = "doc_id", text: str = "text") -> None:
    """One file per document, named as `read_folder` names them, in a folder that does not exist yet.

    Tasks write into a hidden folder beside `path`, each file whole or not at all, so a task
    may run again; the folder gets its name in one step when all files are there. `path` may
    lie where both Spark and `pyarrow.fs` can write (file, hdfs, s3, gs). Null texts become
    empty files. Names that are null, occur twice, lead out of the folder, or that Spark
    would not read back (a part beginning with `_` or `.`) are errors; only names are
    shuffled to find that out.
    """
    spark = docs.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(conf)
    target = files.makeQualified(target)
    if files.exists(target):
        raise FileExistsError(f"{path} exists")
    rows = docs.select(F.col(name).cast("string").alias("name"), F.coalesce(text, F.lit("")).alias("text"))
    readable = F.coalesce(F.col("name").rlike(_READABLE), F.lit(False))
    wrong = rows.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where(~readable | (F.col("n") > 1)).first()
    if wrong is not None:
        raise ValueError(f"{wrong['n']} documents named {wrong['name']!r}: not names of single files in a folder")
    hidden = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}-{uuid.uuid4().hex}")
    files.mkdirs(hidden)
    try:
        rows.mapInArrow(partial(_write_files, _uri(hidden.toUri().toASCIIString())), "files bigint").agg(F.sum("files")).collect()
        if not files.rename(hidden, target):
            raise OSError(f"{path} could not be created")
    finally:
        files.delete(hidden, True)


# Path parts parted by single slashes; none begins with a dot, an underscore, or is empty.
_READABLE = r"\A[^/._\x00][^/\x00]*+(/[^/._\x00][^/\x00]*+)*+\z"


def _uri(path: str) -> str:
    scheme, _, rest = path.partition(":")
    rest = rest if rest.startswith("//") else "//" + rest
    return f"{'s3' if scheme == 's3a' else scheme}:{rest}"


def _write_files(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow.fs import FileSystem

    files, base = FileSystem.from_uri(folder)
    made: set[str] = set()
    for batch in batches:
        for name, text in zip(batch.column("name"), batch.column("text")):
            place = f"{base}/{name.as_py()}"
            parent = place.rpartition("/")[0]
            if parent not in made:
                files.create_dir(parent, recursive=True)
                made = made if len(made) < 10_000 else set()
                made.add(parent)
            begun = f"{parent}/.{uuid.uuid4().hex}"
            with files.open_output_stream(begun) as out:
                out.write(text.as_buffer())
            files.move(begun, place)
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["files"])
