import os

import pytest
from pyspark.sql import functions as F

from maskline.operators import mapping as M
from maskline.sources import mapping_store as V
from maskline.sources.staging import stage, staging


@pytest.fixture
def many(spark):
    n = 1500
    return (
        spark.range(n)
        .select(F.lit("corpus").alias("scope"), F.lit("EMAIL").alias("pii_type"), F.concat("id", F.lit("@x.pl")).alias("value"))
        .unionByName(
            spark.range(40).select(
                F.concat(F.lit("s"), F.col("id") % 3).alias("scope"), F.lit("PL_PESEL").alias("pii_type"),
                F.col("id").cast("string").alias("value"),
            )
        )
    )


def as_set(mapping):
    return {tuple(r) for r in mapping.select(*M.MAPPING_COLUMNS).collect()}


def test_numbers_do_not_depend_on_the_physical_layout(many):
    expected = as_set(M.allocate(many, digest_chars=0))
    for parts, chars in ((1, 1), (7, 2), (64, 3)):
        assert as_set(M.allocate(many.repartition(parts), digest_chars=chars)) == expected


def test_dense_one_to_one_and_wide_numbers(many):
    rows = M.allocate(many.unionByName(many)).where("pii_type = 'EMAIL'").collect()
    assert sorted(r["ordinal"] for r in rows) == list(range(1, 1501))
    tokens = {r["token"] for r in rows}
    assert len(tokens) == 1500 and "[EMAIL_001]" in tokens and "[EMAIL_1000]" in tokens


def test_secret_changes_the_order(many):
    assert as_set(M.allocate(many, secret="k")) != as_set(M.allocate(many))


def test_known_values_keep_their_tokens(many, spark):
    first = M.allocate(many.where("value like '1%'"))
    grown = M.extend(first, many)
    assert as_set(first) <= as_set(grown)
    assert as_set(M.extend(grown, many)) == as_set(grown)
    assert M.inconsistencies(grown).count() == 0
    emails = grown.where("pii_type = 'EMAIL'")
    assert emails.agg(F.max("ordinal")).first()[0] == emails.count() == 1500


def test_reserved_tokens_are_not_handed_out(many, spark):
    seen = spark.createDataFrame(
        [("corpus", "[EMAIL_007]"), ("corpus", "[EMAIL_0008]"), ("corpus", "[EMAIL_99999999999999999999]")],
        "scope string, token string",
    )
    reserved = M.parse_tokens(seen)
    assert [r["ordinal"] for r in reserved.collect()] == [7]
    got = M.allocate(many, reserved=reserved).where("pii_type = 'EMAIL'").agg(F.min("ordinal")).first()[0]
    assert got == 8


def test_inconsistencies_are_seen(spark):
    bad = spark.createDataFrame(
        [("c", "EMAIL", "t1", "a"), ("c", "EMAIL", "t2", "a"), ("c", "EMAIL", "t2", "b")],
        "scope string, pii_type string, token string, value string",
    )
    assert {(r["side"], r["item"]) for r in M.inconsistencies(bad).collect()} == {("value", "a"), ("token", "t2")}


def test_staged_tables_go_with_their_block(spark):
    df = spark.range(3)
    outer, _ = stage(df, "outer")
    with pytest.raises(RuntimeError), staging(spark):
        inner, _ = stage(df, "inner")
        assert inner.count() == 3
        raise RuntimeError
    path = inner.inputFiles()[0].removeprefix("file://").removeprefix("file:")
    assert not os.path.exists(path) and outer.count() == 3


def test_json_round_trip_in_parts(many):
    mapping = M.allocate(many)
    exported = V.export_json(mapping, part_size=400)
    assert exported.where("scope = 'corpus'").count() == 4
    assert as_set(V.import_json(exported)) == as_set(mapping)


def test_vault_reads_only_the_buckets_it_needs(many, spark, tmp_path):
    mapping = M.allocate(many)
    V.save_to_vault(mapping, str(tmp_path / "vault"))
    assert as_set(V.load_from_vault(spark, str(tmp_path / "vault"))) == as_set(mapping)
    one = V.load_from_vault(spark, str(tmp_path / "vault"), ["s1"])
    assert as_set(one) == as_set(mapping.where("scope = 's1'"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
