"""Benchmark decontamination by SimHash windows (operator 6).

Every window of a text that is as long as a benchmark item is held against the items
of that length, and a text shorter than an item as a whole:

1. Windows with too few of the items' shingles cannot reach the similarity. A bit table
   of TABLE_BITS bits (its size never grows) holds the items' shingles, marked with the
   item's length, and is broadcast; only windows with enough hits go on. False hits
   cost time, never a result.
2. The windows left get a 64-bit SimHash. Fingerprints are cut into RADIUS + 1 blocks:
   any two within RADIUS agree on a whole block, so an equi-join on (length, block,
   value) finds all of them; the Hamming distance is then checked.
3. Weighted similarity (shingles with their multiplicities, sum of minima over sum of
   maxima) is computed exactly and decides.

At the threshold the expected distance of two fingerprints is below 10; RADIUS is some
3.6 standard deviations above, at a similarity of 0.85 4.4.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskline.llm.common import WordHashes, map_rows, mixed, rows_of, shingle_hashes, ship, staged, with_row_key

RADIUS = 20
BLOCKS = RADIUS + 1
TABLE_BITS = 1 << 24
_PUNCTUATION = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))


def _words(text: str | None) -> list[bytes]:
    """ASCII-lower-cased words without ASCII punctuation."""
    if not text:
        return []
    return text.encode("utf-8", "surrogatepass").lower().translate(None, _PUNCTUATION).split()


def _slot(shingles: np.ndarray, length: int) -> np.ndarray:
    """Places in the bit table of shingles of items with `length` words; 0 stands for any length."""
    salt = np.uint64(length * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return (mixed(shingles + salt) % np.uint64(TABLE_BITS)).astype(np.int64)


def simhash(shingles: np.ndarray, weights: np.ndarray) -> int:
    """64 bits: the sign of the weighted vote of the shingles' bits."""
    bits = np.unpackbits(mixed(shingles).view(np.uint8).reshape(-1, 8), axis=1)
    vote = (2 * bits.astype(np.int64) - 1).T @ weights
    return int(np.packbits(vote > 0).view(np.int64)[0])


def _blocks(fingerprint):
    """Column expression: the RADIUS + 1 blocks of a fingerprint."""
    edges = [round(i * 64 / BLOCKS) for i in range(BLOCKS + 1)]
    values = [
        F.struct(
            F.lit(i).alias("block"),
            F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value"),
        )
        for i, (a, b) in enumerate(zip(edges, edges[1:]))
    ]
    return F.explode(F.array(*values))


def _bag(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, counts = np.unique(shingles, return_counts=True)
    return values, counts.astype(np.int64)


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    *,
    key: str = "doc_id",
    item_key: str = "item_id",
    text: str = "text",
    words: int = 5,
    least: float = 0.8,
) -> DataFrame:
    """Pairs of a text and a benchmark item it contains: key, item key, similarity, start.

    similarity is that of the best window, start the word it begins at (the first of
    equals). Words are lower-cased (A-Z) and lose ASCII punctuation. Items without words
    match nothing; an item with fewer words than a shingle is one shingle. Null keys are
    kept as such; rows that share a key are reported as one. A text shorter than an item is
    held against it as a whole. Other columns are not carried.
    """
    spark = docs.sparkSession
    ship(spark)
    names = WordHashes()
    item_rows = items.select(F.col(item_key).alias("item"), F.col(text).alias("text"))
    item_type = item_rows.schema["item"].dataType.simpleString()

    def describe(ids, texts):
        out = []
        for i, t in zip(ids, texts):
            split = _words(t)
            if split:
                found = shingle_hashes(names.of(split), words)
                out.append((i, len(split), simhash(*_bag(found)), found.view(np.int64)))
        return [list(x) for x in zip(*out)] if out else [[], [], [], []]

    described = staged(
        map_rows(item_rows, describe, f"item {item_type}, length int, print bigint, bag array<bigint>"), "items"
    )

    def mark(batches):
        """The bit table's set places, as parts of a table of fixed size."""
        places = set()
        for batch in batches:
            for length, bag in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = np.array(bag, np.int64).view(np.uint64)
                for which in (0, length):
                    places.update(_slot(found, which).tolist())
        yield pa.RecordBatch.from_arrays([pa.array(sorted(places), pa.int32())], names=["place"])

    marked = described.select("length", "bag").mapInArrow(mark, "place int").distinct().toArrow()
    bits = np.zeros(TABLE_BITS, bool)
    bits[marked["place"].to_numpy()] = True
    lengths = sorted(r["length"] for r in described.select("length").distinct().collect())
    shared = spark.sparkContext.broadcast((np.packbits(bits), lengths))

    def enough(length: int) -> int:
        """Least number of common shingles of two windows of that length, counted with multiplicity."""
        n = max(1, length - words + 1)
        return max(1, math.ceil(2 * n * least / (1 + least) - 1e-9))

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_type = rows.schema["key"].dataType.simpleString()

    def windows(keys, texts):
        packed, sizes = shared.value
        hit = lambda at: (packed[at >> 3] >> (7 - (at & 7))) & 1
        out = []
        fewest = min((enough(n) for n in sizes if n >= words), default=0)
        short = [n for n in sizes if n < words]
        for k, t in zip(keys, texts):
            split = _words(t)
            if not split or not sizes:
                continue
            hashes = names.of(split)
            long = shingle_hashes(hashes, words) if len(split) >= words else hashes[:0]
            any_hit = hit(_slot(long, 0)) if fewest else long[:0]
            likely = fewest and int(any_hit.sum()) >= fewest
            for length in sizes:
                if length > len(split):
                    # the whole text, if it has shingles enough for the similarity
                    span = length - words + 1
                    if len(long) < least * span:
                        break
                    common = math.ceil(least * (len(long) + span) / (1 + least) - 1e-9)
                    if int(hit(_slot(long, length)).sum()) >= common:
                        out.append((k, length, 0, simhash(*_bag(long)), long.view(np.int64)))
                    continue
                if length >= words:
                    if not likely:
                        continue
                    shingles, span = long, length - words + 1
                    at = np.flatnonzero(any_hit)
                    own = np.zeros(len(long), np.int64)
                    own[at] = hit(_slot(long[at], length))
                else:
                    shingles, span = shingle_hashes(hashes, length), 1
                    own = hit(_slot(shingles, length)).astype(np.int64)
                total = np.concatenate([[0], np.cumsum(own)])
                starts = np.flatnonzero(total[span:] - total[:-span] >= enough(length))
                for a in starts.tolist():
                    bag = shingles[a : a + span]
                    out.append((k, length, a, simhash(*_bag(bag)), bag.view(np.int64)))
        return [list(x) for x in zip(*out)] if out else [[], [], [], [], []]

    found = staged(
        map_rows(rows, windows, f"key {key_type}, length int, start int, print bigint, bag array<bigint>"), "windows"
    )
    left = found.select("key", "length", "start", "print", _blocks(F.col("print")).alias("b"))
    right = described.select("item", "length", F.col("print").alias("item_print"), _blocks(F.col("print")).alias("b"))
    near = (
        left.select("*", "b.*")
        .drop("b")
        .join(right.select("*", "b.*").drop("b"), ["length", "block", "value"])
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
        .select("key", "length", "start", "print", "item")
        .distinct()
    )
    pairs = near.join(
        found.withColumnRenamed("key", "key2"),
        F.col("key").eqNullSafe(F.col("key2"))
        & (near["length"] == found["length"])
        & (near["start"] == found["start"])
        & (near["print"] == found["print"]),
    ).select("key", near["start"], "item", "bag")
    pairs = pairs.join(described.select(F.col("item").alias("item2"), F.col("bag").alias("item_bag")), F.col("item").eqNullSafe(F.col("item2")))

    def compare(keys, starts, ids, bags, item_bags):
        similarity = []
        for a, b in zip(bags, item_bags):
            (x, n), (y, m) = _bag(np.array(a, np.int64)), _bag(np.array(b, np.int64))
            _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
            common = int(np.minimum(n[i], m[j]).sum())
            similarity.append(common / (len(a) + len(b) - common))
        return keys, starts, ids, similarity

    schema = f"key {key_type}, start int, item {item_type}, similarity double"
    scored = map_rows(
        pairs.select("key", "start", "item", F.col("bag"), F.col("item_bag")), compare, schema, "bag"
    ).where(F.col("similarity") >= least - 1e-12)
    best = scored.groupBy("key", "item").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best")
    )
    return best.select(
        F.col("key").alias(key),
        F.col("item").alias(item_key),
        F.col("best.similarity").alias("similarity"),
        (-F.col("best.back")).alias("start"),
    )


def drop_leaks(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows, with all columns, whose text contains no item."""
    keyed, name = with_row_key(docs, key, text)
    leaks = find_leaks(keyed, items, key=name, text=text, **options).select(name).distinct()
    return keyed.join(leaks, name, "left_anti").select(*docs.columns)
