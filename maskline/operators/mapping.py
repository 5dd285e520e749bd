"""The token mapping: scope, pii_type, ordinal, token, value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from maskline.sources.staging import stage

MAPPING_SCHEMA = "scope string, pii_type string, ordinal bigint, token string, value string"
MAPPING_COLUMNS = ["scope", "pii_type", "ordinal", "token", "value"]
VALUE_KEY = ["scope", "pii_type", "value"]

DIGEST_CHARS = 3
# A scope and type with at most this many new values is numbered by one task. What is counted are groups of them.
SMALL_GROUP, COUNTED_GROUPS = 100_000, 1 << 16


def token_text(pii_type: Column, ordinal: Column) -> Column:
    return F.format_string("[%s_%03d]", pii_type, ordinal)


def parse_tokens(tokens: DataFrame, column: str = "token") -> DataFrame:
    """(scope, pii_type, ordinal) of well-formed token strings.

    Numbers beyond a bigint, which an allocation cannot reach (it would fail, not wrap),
    and spellings an allocation never produces are no obstacle and left out.
    """
    body = r"^\[([A-Z_]+)_(\d+)\]$"
    return (
        tokens.where(F.rlike(column, F.lit(body)))
        .select(
            "scope",
            F.regexp_extract(column, body, 1).alias("pii_type"),
            F.regexp_extract(column, body, 2).try_cast("bigint").alias("ordinal"),
            F.col(column).alias("token"),
        )
        .where(F.col("token") == token_text(F.col("pii_type"), F.col("ordinal")))
        .drop("token")
    )


def _small_groups(values: DataFrame, group: list[str]) -> bool:
    """Whether no group is large. Only a count for each of COUNTED_GROUPS and task is shuffled."""
    dealt = F.pmod(F.xxhash64(*group), F.lit(COUNTED_GROUPS)).cast("int")
    counted = values.groupBy(dealt.alias("_group")).agg(F.count(F.lit(1)).alias("n"))
    return (counted.agg(F.max("n")).first()[0] or 0) <= SMALL_GROUP


def allocate(
    values: DataFrame,
    mapping: DataFrame | None = None,
    *,
    reserved: DataFrame | None = None,
    high: DataFrame | None = None,
    secret: str = "",
    digest_chars: int = DIGEST_CHARS,
) -> DataFrame:
    """Entries for the values `mapping` does not hold yet.

    Within a scope and type, ordinals follow the SHA-256 of secret and value.
    That order depends on nothing but the values: a recomputed task, another
    number of partitions or a replay yields the same tokens, and the numbers
    give away nothing about the alphabetical order. The first `digest_chars`
    of the digest only say how the numbering is spread: 16**digest_chars
    independent buckets per scope and type, stitched together by their sizes. Where every
    scope and type is small (a mapping for each document), one bucket each is enough.

    `reserved` lists ordinals the texts already mention; numbering starts above. `high`
    holds the highest ordinal of each scope and type, where that is known without reading
    the whole mapping; `mapping` then only needs the entries of `values`.
    """
    group = ["scope", "pii_type"]
    bucketed = [*group, "_bucket"]
    new = values.where(F.col("value") != "").select(*VALUE_KEY).distinct()
    if mapping is not None:
        new = new.join(mapping.select(*VALUE_KEY), VALUE_KEY, "left_anti")
    digest = F.sha2(F.concat(F.lit(secret), F.col("value")), 256)
    order = [F.col("_digest"), F.col("value")]
    new = new.withColumn("_digest", digest)

    taken = None
    if high is not None:
        taken = high.select(*group, "ordinal")
    elif mapping is not None:
        taken = mapping.select(*group, "ordinal")
    if reserved is not None:
        taken = reserved.select(*group, "ordinal") if taken is None else taken.unionByName(
            reserved.select(*group, "ordinal")
        )
    if taken is not None:
        taken = taken.groupBy(*group).agg(F.max("ordinal").alias("_taken"))

    if digest_chars > 0:
        # both the numbers and the sizes of the buckets need the values: what found them runs once
        new, _ = stage(new.drop("_digest"), "new-values")
        new = new.withColumn("_digest", digest)
        if _small_groups(new, group):
            # nulls meet no bucket's start below
            new, digest_chars = new.dropna(subset=group), 0
    if digest_chars == 0:
        numbered = new.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
        if taken is not None:
            numbered = numbered.join(taken, group, "left")
        offset = F.lit(0)
    else:
        # the values travel without their digests, which are longer and known again where they arrive
        dealt = new.drop("_digest").withColumn("_bucket", F.substring(digest, 1, digest_chars))
        new = dealt.repartition(*bucketed).withColumn("_digest", digest)
        numbered = new.withColumn(
            "_n", F.row_number().over(Window.partitionBy(*bucketed).orderBy(*order))
        )
        before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        starts = (
            dealt.groupBy(*bucketed)
            .agg(F.count(F.lit(1)).alias("_size"))
            .withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
            .drop("_size")
        )
        if taken is not None:
            starts = starts.join(taken, group, "left")
        numbered = numbered.join(starts, bucketed)
        offset = F.col("_before")
    if taken is not None:
        offset = offset + F.coalesce(F.col("_taken"), F.lit(0))
    ordinal = (F.col("_n") + offset).cast("bigint")
    return numbered.select(
        *group,
        ordinal.alias("ordinal"),
        token_text(F.col("pii_type"), ordinal).alias("token"),
        "value",
    )


def extend(mapping: DataFrame | None, values: DataFrame, **options) -> DataFrame:
    """The mapping with entries for new values; known values keep their tokens."""
    new = allocate(values, mapping, **options)
    return new if mapping is None else mapping.select(*MAPPING_COLUMNS).unionByName(new)


def mapping_size(mapping: DataFrame) -> DataFrame:
    return mapping.groupBy("scope", "pii_type").agg(F.count(F.lit(1)).alias("n"))


def inconsistencies(pairs: DataFrame) -> DataFrame:
    """Values with several tokens and tokens with several values; empty when all is well."""
    by_value = (
        pairs.groupBy("scope", "pii_type", "value")
        .agg(F.countDistinct("token").alias("n"))
        .where("n > 1")
        .select("scope", F.lit("value").alias("side"), F.col("value").alias("item"), "n")
    )
    by_token = (
        pairs.select("scope", "token", "pii_type", "value")
        .distinct()
        .groupBy("scope", "token")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("scope", F.lit("token").alias("side"), F.col("token").alias("item"), "n")
    )
    return by_value.unionByName(by_token)
