"""Equi-joins that survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskline.sources.staging import stage

# A key with this many rows or more is spread, one part for each so many rows.
HOT_ROWS = 1_000_000
# Largest table handed to a broadcast, counted in rows and in bytes of text.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024


# Groups of keys that are counted before single keys are.
KEY_GROUPS = 1 << 16


def hot_keys(df: DataFrame, on: Sequence[str], hot_rows: int | None = None) -> DataFrame | None:
    """Every key with `hot_rows` rows or more, and in how many parts it is dealt; None if there is none.

    Keys are counted in KEY_GROUPS groups first, which shuffles a number for each group and
    task. Single keys are counted only in groups that are large enough to hold a hot one.
    """
    limit = HOT_ROWS if hot_rows is None else hot_rows
    group = F.pmod(F.xxhash64(*on), F.lit(KEY_GROUPS)).cast("int")
    counted = df.groupBy(group.alias("_group")).agg(F.count(F.lit(1)).alias("_n"))
    large = [r["_group"] for r in counted.where(F.col("_n") >= limit).select("_group").collect()]  # KEY_GROUPS at most
    if not large:
        return None
    hot = (
        df.where(group.isin(large))
        .groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") >= limit)
        .select(*on, (F.ceil(F.col("_n") / limit) + 1).cast("int").alias("_parts"))
    )
    hot, n_hot = stage(hot, "hot-keys")
    return hot if n_hot else None


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    *,
    n_left: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Join a skewed `left` with `right` on `on`.

    Rows of a hot key are dealt by a hash of the `spread` columns into parts of
    about `hot_rows` rows, and the right rows of that key are repeated for each
    part. Any number of keys of any width may be hot; whether their table is
    broadcast is left to Spark. Without hot keys, and with a left side known to be smaller
    than one, the sides are joined directly.
    """
    limit = HOT_ROWS if hot_rows is None else hot_rows
    on = list(on)
    hot = None if n_left is not None and n_left < limit else hot_keys(left, on, limit)
    if hot is None:
        return left.join(right, on, how)
    salt = F.pmod(F.xxhash64(*spread), F.coalesce("_parts", F.lit(1))).cast("int")
    salted = left.join(hot, on, "left").withColumn("_salt", salt)
    repeated = right.join(hot, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    )
    return salted.drop("_parts").join(repeated.drop("_parts"), [*on, "_salt"], how).drop("_salt")


# Bits of a filter for each key, and at most: their table has a 64th of so many rows.
KEY_BITS, FILTER_BITS = 8, 1 << 23


def likely(big: DataFrame, keys: DataFrame, on: Sequence[str], n_keys: int) -> DataFrame:
    """The rows of `big` whose `on` may be among `keys`: all that are, and about one in KEY_BITS others.

    One bit per key hash, in a broadcast table of words of 64 bits whose size `n_keys`
    bounds. With more keys than FILTER_BITS allow, `big` comes back whole. Nothing of `big`
    is shuffled.
    """
    bits = 1 << 12
    while bits < KEY_BITS * n_keys:
        bits *= 2
    if bits > FILTER_BITS:
        return big
    place = F.pmod(F.xxhash64(*on), F.lit(bits))
    words = (
        keys.select(place.alias("_at"))
        .groupBy(F.shiftright("_at", 6).alias("_word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("_at") % 64).cast("int"))).alias("_bits"))
    )
    at = big.withColumn("_at", place).withColumn("_word", F.shiftright("_at", 6))
    hit = F.call_function("shiftrightunsigned", F.col("_bits"), (F.col("_at") % 64).cast("int")) % 2 != 0
    return at.join(F.broadcast(words), "_word").where(hit).select(*big.columns)


def broadcast_if_small(df: DataFrame, n_rows: int, n_bytes: int = 0) -> tuple[DataFrame, bool]:
    """Broadcast a table whose measured size is within bounds."""
    small = n_rows <= BROADCAST_ROWS and n_bytes <= BROADCAST_BYTES
    return (F.broadcast(df), True) if small else (df, False)
