"""Compliance reports over findings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskline.sources.staging import stage


def report(findings: DataFrame, *, key: Sequence[str] = ("doc_id",), preview: bool = False) -> DataFrame:
    """Where something was found and by whom. Raw values only on request."""
    columns = [
        *key,
        F.col("entity").alias("entity_type"),
        "start",
        "end",
        F.round("score", 2).alias("score"),
        "detector",
    ]
    if preview:
        columns.append(F.col("value").alias("value_preview"))
    return findings.select(*columns)


def summary(findings: DataFrame) -> DataFrame:
    """Findings per entity, most frequent first."""
    return (
        findings.groupBy(F.col("entity").alias("entity_type"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "entity_type")
    )


def total(findings: DataFrame) -> DataFrame:
    return findings.agg(F.count(F.lit(1)).alias("n"))


def rejected(candidates: DataFrame) -> DataFrame:
    """Look-alikes per detector: right shape, wrong check digit."""
    return (
        candidates.where(~F.col("valid"))
        .groupBy("detector")
        .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("value").alias("n_values"))
    )


# Groups of findings whose digests are added up before any finding is joined.
DIFF_BUCKETS = 4_096


def _unlike(before: DataFrame, after: DataFrame, on: Sequence[str]) -> DataFrame:
    """The buckets (of a hash of `on`) whose findings and scores are not the same in both reports."""
    low = F.lit((1 << 32) - 1)

    def side(findings: DataFrame, sign: int) -> DataFrame:
        digests = [F.xxhash64(F.lit(i), *on, "score").alias(f"_{i}") for i in (0, 1)]
        return findings.select(_bucket(on).alias("_bucket"), *digests, F.lit(sign).alias("_sign"))

    both = side(before, 1).union(side(after, -1))
    sums = [F.sum("_sign").alias("n")] + [F.sum(F.col("_sign") * F.col(f"_{i}").bitwiseAND(low)).alias(f"s{i}") for i in (0, 1)]
    xors = [F.bit_xor(f"_{i}").alias(f"x{i}") for i in (0, 1)]
    return both.groupBy("_bucket").agg(*sums, *xors).where("n <> 0 or s0 <> 0 or s1 <> 0 or x0 <> 0 or x1 <> 0").select("_bucket")


def _bucket(on: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*on), F.lit(DIFF_BUCKETS)).cast("int")


def diff(before: DataFrame, after: DataFrame, *, key: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Findings that came, went or changed score between two runs.

    Both runs are first compared by digests in DIFF_BUCKETS buckets; findings are grouped
    and joined only in the buckets that differ.
    """
    on = [*key, "entity", "start", "end"]
    unlike, _ = stage(_unlike(before, after, on), "unlike")

    def side(findings: DataFrame, name: str) -> DataFrame:
        changed = findings.withColumn("_bucket", _bucket(on)).join(F.broadcast(unlike), "_bucket")  # DIFF_BUCKETS rows at most
        return changed.groupBy(*on).agg(F.max("score").alias(name))

    change = (
        F.when(F.col("score_before").isNull(), "added")
        .when(F.col("score_after").isNull(), "removed")
        .otherwise("rescored")
    )
    return (
        side(before, "score_before")
        .join(side(after, "score_after"), on, "full_outer")
        .where(~F.col("score_before").eqNullSafe(F.col("score_after")))
        .select(*on, change.alias("change"), "score_before", "score_after")
    )


def dropped_overlaps(found: DataFrame, kept: DataFrame, *, key: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Findings that overlap resolution dropped.

    Both sides are dealt by their keys: findings are many more than the size of the texts' table makes Spark expect.
    """
    on = [*key, "start", "end", "detector"]
    return found.join(kept.select(*on).hint("shuffle_merge"), on, "left_anti")
