"""Keeping the token mapping. It holds raw values: store it apart from the texts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskline.operators.mapping import MAPPING_COLUMNS, MAPPING_SCHEMA

# Entries of one type that a JSON object holds at most; larger mappings come in parts.
JSON_PART = 10_000
VAULT_BUCKETS = 256
WRITE_SALTS = 16

ENTRIES = "struct<entries:array<struct<token:string,type:string,value:string>>>"


def export_json(mapping: DataFrame, part_size: int = JSON_PART) -> DataFrame:
    """(scope, part, mapping_json); a scope with few entries is a single object."""
    entry = F.struct("pii_type", "ordinal", "token", "value")
    return (
        mapping.withColumn("part", F.floor((F.col("ordinal") - 1) / part_size))
        .groupBy("scope", "part")
        .agg(F.array_sort(F.collect_list(entry)).alias("sorted"))
        .select(
            "scope",
            "part",
            F.expr(
                "to_json(named_struct('entries', transform(sorted, "
                "e -> named_struct('token', e.token, 'type', e.pii_type, 'value', e.value))))"
            ).alias("mapping_json"),
        )
    )


def import_json(exported: DataFrame) -> DataFrame:
    """The mapping behind `export_json` rows (all parts), or any (scope, mapping_json).

    Null, text that is no such JSON, an object without `entries`, an entry without token,
    type or value, a token not of its type's form, and a token listed twice are errors, not
    an empty or partial mapping. That a token has one value across parts is checked where
    it is used, by `restore`.
    """

    def refused(why: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"{why} in the mapping of scope "), F.coalesce("scope", F.lit("null"))))

    kind = "array<struct<token:string,type:string,value:string>>"
    entries = F.col("m.entries")
    whole = F.forall(
        entries,
        lambda e: F.coalesce(
            e["token"].isNotNull() & e["value"].isNotNull() & (e["type"] != "")
            & (F.regexp_extract(e["token"], r"^\[([A-Z_]+)_\d+\]$", 1) == e["type"]),
            F.lit(False),
        ),
    )
    once = F.size(F.array_distinct(F.transform(entries, lambda e: e["token"]))) == F.size(entries)
    checked = (
        F.when(entries.isNull(), refused("no entries").cast(kind))
        .when(~whole, refused("malformed entry").cast(kind))
        .when(~once, refused("repeated token").cast(kind))
        .otherwise(entries)
    )
    return (
        exported.select("scope", F.from_json("mapping_json", ENTRIES, {"mode": "FAILFAST"}).alias("m"))
        .select("scope", checked.alias("entries"))
        .select("scope", F.inline("entries"))
        .select(
            "scope",
            F.col("type").alias("pii_type"),
            F.regexp_extract("token", r"_(\d+)\]$", 1).cast("bigint").alias("ordinal"),
            "token",
            "value",
        )
    )


def _bucket(scope: Column) -> Column:
    return F.pmod(F.xxhash64(scope), F.lit(VAULT_BUCKETS)).cast("int")


def save_to_vault(mapping: DataFrame, path: str) -> None:
    """Append entries under a bucket of their scope, so that one case reads one folder.

    A scope with very many entries is spread over several writers.
    """
    spread = F.pmod(F.xxhash64("pii_type", "value"), F.lit(WRITE_SALTS))
    (
        mapping.select(*MAPPING_COLUMNS)
        .withColumn("bucket", _bucket(F.col("scope")))
        .repartition("bucket", spread)
        .write.mode("append")
        .partitionBy("bucket")
        .parquet(path)
    )


def load_from_vault(spark: SparkSession, path: str, scopes: Iterable[str] | None = None) -> DataFrame:
    """The mapping of the given scopes; reads only their buckets."""
    vault = spark.read.schema(MAPPING_SCHEMA + ", bucket int").parquet(path)
    if scopes is not None:
        wanted = [F.lit(s) for s in scopes]
        vault = vault.where(F.col("scope").isin(*wanted) & F.col("bucket").isin(*map(_bucket, wanted)))
    return vault.select(*MAPPING_COLUMNS)
