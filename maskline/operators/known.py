"""Literal values known beforehand, such as names no pattern can find."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskline.functions import sql as Q
from maskline.operators.lookup import broadcast_if_small, salted_join
from maskline.sources.staging import stage

KNOWN = "_known"
# Lists up to this length go to their rows whole; of longer ones a row gets what it may hold.
LIST_VALUES = 64
# Lengths of the substrings by which values of long lists are found; a value has the longest that fits.
GRAMS = (16, 8, 4, 2, 1)
ROW = ["_known_a", "_known_b"]
# Hashes of substrings: the factor of their polynomial, and those that say which bits of the filter stand for one.
FACTOR = 0x9E3779B97F4A7C15
PROBES = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
# Bits of the filter for each value, and at most (16 MB).
KEY_BITS, FILTER_BITS = 16, 1 << 27
# Rows whose substrings a task holds at once.
BATCH_ROWS = 1_000


def attach_known(
    df: DataFrame, known: DataFrame, on: Sequence[str], *, spread: Sequence[str], texts: Sequence[str] = ("text",)
) -> DataFrame:
    """Add the `_known` array of values that each row's `texts` may hold, in list order.

    `known` holds `on`, value, pii_type and seq; `on` names the columns that tell a row its
    list (a case, a scope; none: one list for all). Short lists go to their rows whole,
    broadcast when their measured size is small, else joined with hot groups salted.

    No row gets a list longer than that: each value is filed under one of its substrings
    (of the longest length in GRAMS that fits, the one that fewest values share). A text's
    substrings meet a bit filter of the filed ones in the task that cuts them, what is left
    meets the list by an equi-join, and a row collects only values whose substring it holds.
    """
    on = list(on)
    listed, n_values = stage(
        known.where("value is not null and value <> ''").select(*on, "seq", "value", "pii_type").distinct(), "known-values"
    )
    longest = listed.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if on and longest <= LIST_VALUES:
        return _whole_lists(df, listed, on, spread)
    return _by_substrings(df, listed, n_values, on, texts)


def _in_order() -> Column:
    return F.array_sort(F.collect_set(F.struct("seq", "value", "pii_type"))).alias(KNOWN)


def _whole_lists(df: DataFrame, listed: DataFrame, on: list[str], spread: Sequence[str]) -> DataFrame:
    lists = listed.groupBy(*on).agg(_in_order())
    n_bytes = F.expr(f"aggregate({KNOWN}, 0L, (n, k) -> n + octet_length(k.value) + 64)")
    lists, n_bytes_total = stage(lists, "known", n_bytes)
    n_rows = -(-n_bytes_total // 64)
    lists, small = broadcast_if_small(lists, n_rows, n_bytes_total)
    if small:
        return df.join(lists, on, "left")
    # such a table is read several times: its texts meet their lists once
    return stage(salted_join(df, lists, on, spread, "left"), "known-texts")[0]


def _grams(df: DataFrame, texts: Sequence[str], carry: Sequence[str], sizes: Sequence[int], *, own: bool, words=None) -> DataFrame:
    """`carry` and the hash `_gram` of every substring of the texts that has one of the `sizes`; each once for a row.

    With `own`, a text's substrings of the largest size that fits alone. With `words`, the
    broadcast words of `_filter`, those it lets through: most never leave the task.
    """
    schema = T.StructType([*df.select(*carry).schema.fields, T.StructField("_gram", T.LongType())])
    names, width, fewer = list(texts), len(carry), sorted(sizes)

    def held(gram: np.ndarray) -> np.ndarray:
        """The places of the hashes that the filter lets through."""
        bits, at = words.value, np.arange(len(gram))
        shift = np.uint64(64 - int(len(bits) * 64).bit_length() + 1)
        for factor in PROBES:
            place = (gram[at] * np.uint64(factor)) >> shift
            at = at[(bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1]
        return at

    def cut(column: list) -> tuple[np.ndarray, np.ndarray]:
        """Rows and hashes: polynomials over the code points, put together from those of half the size."""
        column = [t or "" for t in column]
        n = np.fromiter(map(len, column), np.int64, len(column))
        points = np.frombuffer("".join(column).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        ends, all_rows = np.cumsum(n), np.repeat(np.arange(len(column)), n)
        left = ends[all_rows] - np.arange(len(points))  # code points from here to the end of the text
        rows, grams, h, size = [], [], (points + np.uint64(1)) * np.uint64(FACTOR), 1
        fits = np.zeros(len(column), np.int64)
        for x in fewer:
            fits[n >= x] = x
        while len(h):
            if size in fewer:
                gram = h ^ (h >> np.uint64(29)) ^ np.uint64(size)
                at = np.arange(len(gram)) if words is None else held(gram)
                at = at[left[at] >= size]
                if own:
                    at = at[fits[all_rows[at]] == size]
                rows.append(all_rows[at])
                grams.append(gram[at])
            if size >= fewer[-1]:
                break
            h = h[:-size] * np.uint64(pow(FACTOR, size, 1 << 64)) + h[size:]
            size *= 2
        return np.concatenate([*rows, np.empty(0, np.int64)]), np.concatenate([*grams, np.empty(0, np.uint64)])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                pairs = [cut(part.column(width + i).to_pylist()) for i in range(len(names))]
                rows, grams = (np.concatenate(x) for x in zip(*pairs))
                order = np.lexsort((grams, rows))
                rows, grams = rows[order], grams[order].view(np.int64)
                first = np.ones(len(rows), bool)
                first[1:] = (rows[1:] != rows[:-1]) | (grams[1:] != grams[:-1])
                taken = part.select(range(width)).take(pa.array(rows[first]))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(grams[first])], names=[*taken.schema.names, "_gram"])

    return df.select(*carry, *[F.col(Q.name(t)).cast("string").alias(f"_string_{i}") for i, t in enumerate(names)]).mapInArrow(run, schema)


def _filter(grams: DataFrame, n_keys: int) -> np.ndarray:
    """Words of 64 bits: len(PROBES) bits are set for each gram. Between KEY_BITS and twice as many
    bits for a key, FILTER_BITS in all at most; with more keys it lets more through, and misses none.
    """
    bits = 1 << 12
    while bits < min(KEY_BITS * n_keys, FILTER_BITS):
        bits *= 2
    shift, factors = 64 - bits.bit_length() + 1, PROBES

    def run(batches):
        for batch in batches:
            gram = np.asarray(batch.column(0)).view(np.uint64)
            place = np.unique(np.concatenate([(gram * np.uint64(f)) >> np.uint64(shift) for f in factors]))
            if len(place):
                word, bit = place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63))
                first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                found = np.bitwise_or.reduceat(bit, first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word[first].view(np.int64)), pa.array(found.view(np.int64))], names=["word", "bits"]
                )

    set_bits = grams.select("_gram").mapInArrow(run, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros(bits // 64, np.uint64)
    found = set_bits.toArrow()  # one row for each word at most
    out[np.asarray(found["word"])] = np.asarray(found["bits"]).view(np.uint64)
    return out


def _by_substrings(df: DataFrame, listed: DataFrame, n_values: int, on: list[str], texts: Sequence[str]) -> DataFrame:
    size = "case " + " ".join(f"when length(value) >= {n} then {n}" for n in GRAMS) + " end"
    used = sorted(r[0] for r in listed.select(F.expr(size)).distinct().collect())
    if not used:
        return df.withColumn(KNOWN, F.lit(None).cast("array<struct<seq:int,value:string,pii_type:string>>"))
    entry = [*on, "seq", "value", "pii_type"]
    cut = _grams(listed, ["value"], entry, used, own=True)
    shared = cut.select("value", "_gram").distinct().groupBy("_gram").agg(F.count(F.lit(1)).alias("n"))
    filed = cut.join(shared, "_gram").groupBy(*entry).agg(F.min(F.struct("n", "_gram"))["_gram"].alias("_gram"))
    filed, _ = stage(filed, "known-filed")

    keyed = df.withColumns({name: F.xxhash64(F.lit(i), *on, *texts) for i, name in enumerate(ROW)})
    words = df.sparkSession.sparkContext.broadcast(_filter(filed, n_values))
    near, n_near = stage(_grams(keyed, texts, [*ROW, *on], used, own=False, words=words), "known-near")
    words.unpersist()
    hits = salted_join(near, filed, [*on, "_gram"], spread=ROW, n_left=n_near)
    per_row, n_rows = stage(hits.groupBy(*ROW).agg(_in_order()), "known-rows")
    n_bytes = per_row.agg(F.sum(F.expr(f"aggregate({KNOWN}, 64L, (n, k) -> n + octet_length(k.value) + 64)"))).first()[0] or 0
    per_row, small = broadcast_if_small(per_row, n_rows, n_bytes)
    told = keyed.join(per_row, ROW, "left").drop(*ROW)
    return told if small else stage(told, "known-texts")[0]


def as_values(known: DataFrame, scope: str = "scope") -> DataFrame:
    """Known values as input of an allocation, to give them tokens before any text is seen."""
    return known.select(F.col(scope).alias("scope"), "pii_type", "value")
