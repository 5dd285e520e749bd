"""URL filter rules by hashed host suffixes and path prefixes (operator 3), in DataFrame functions only.

A URL is expanded into expressions: each host suffix of as many labels as some rule has,
with each beginning of the path as long as some rule's path. Expressions meet the rules
in an equi-join on a short prefix of their SHA-256, then the full digest is compared, and
the longest rule wins. The expansion of a URL is bounded by the shapes of the rules, not
by the URL, so a hostile host of a thousand labels costs no more than another. The join
leaves the choice of broadcast or shuffle to Spark, which knows the rules' size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_DIGITS = 8
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """From the first :// to the next /, ?, # or the end, A-Z lower-cased; empty for null and without ://."""
    rest = F.substr(url, F.instr(url, "://") + 3)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _UPPER.lower())
    return F.coalesce(F.when(F.instr(url, "://") > 0, host), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty for null and without ://."""
    rest = F.substr(url, F.instr(url, "://") + 3)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.when(F.instr(url, "://") > 0, path), F.lit(""))


def judge(
    pages: DataFrame, rules: DataFrame, *, key: str = "page_id", url: str = "url", otherwise: str = "allow"
) -> DataFrame:
    """Key, host, path, rule and verdict of every row.

    `rules` has host, path and verdict (allow or block). A rule fits its host and all
    subdomains if the path begins with the rule's. The longest rule (host and path
    together) wins, among equals the one with the longer host, then a blocking one, then
    the first by name. URLs no rule fits have a null rule and the verdict `otherwise`.
    Rules with a null part or an empty host fit nothing. Rows are kept one to one,
    repeated and null keys too; other columns are not carried.
    """
    clean = rules.where("host <> '' and path is not null and verdict is not null").select(
        F.translate("host", _UPPER, _UPPER.lower()).alias("rule_host"), F.col("path").alias("rule_path"), "verdict"
    )
    clean = clean.withColumn("rule", F.concat("rule_host", "rule_path")).distinct()
    # As many numbers as the longest rule has labels and characters.
    shape = clean.agg(
        F.sort_array(F.collect_set(F.size(F.split("rule_host", r"\.")))).alias("labels"),
        F.sort_array(F.collect_set(F.length("rule_path"))).alias("lengths"),
    ).first()
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("key"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
    )
    labels = F.split("host", r"\.")
    counts = F.array(*[F.lit(n) for n in shape["labels"]]).cast("array<int>")
    lengths = F.array(*[F.lit(n) for n in shape["lengths"]]).cast("array<int>")
    suffixes = F.transform(
        F.filter(counts, lambda n: (n <= F.size(labels)) & (F.col("host") != "")),
        lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."),
    )
    heads = F.transform(
        F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring("path", F.lit(1), n)
    )
    expressions = F.flatten(F.transform(suffixes, lambda s: F.transform(heads, lambda p: F.concat(s, p))))
    expanded = rows.select("*", F.explode_outer(expressions).alias("expression")).withColumn(
        "digest", F.sha2(F.encode("expression", "UTF-8"), 256)
    )
    hashed = clean.withColumn("rule_digest", F.sha2(F.encode("rule", "UTF-8"), 256)).withColumn(
        "short", F.substring("rule_digest", 1, PREFIX_DIGITS)
    )
    met = expanded.withColumn("short", F.substring("digest", 1, PREFIX_DIGITS)).join(hashed, "short", "left")
    rank = F.struct(
        F.length("rule").alias("length"),
        F.length("rule_host").alias("host_length"),
        (F.col("verdict") == "block").alias("blocks"),
        F.col("rule"),
        F.col("verdict"),
    )
    best = met.groupBy("row", "key", "host", "path").agg(
        F.max(F.when(F.col("digest") == F.col("rule_digest"), rank)).alias("best")
    )
    return best.select(
        F.col("key").alias(key),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"),
    )
