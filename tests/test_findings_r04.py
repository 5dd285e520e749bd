"""Findings of round 4: filters that ran in the few pieces of a table, JSON that was parsed several times."""

import gzip

import pytest
from pyspark.sql import functions as F

from maskline.operators.tokenize import restore, tokenize


def test_texts_are_made_once_behind_the_shuffle(spark, tmp_path):
    """A filter on notes made of a table in one piece runs in all parts, and does not make the notes again."""
    from registry import inputs as I

    orders = spark.createDataFrame([(i, i % 7, "1-URGENT") for i in range(20)], "o_orderkey bigint, o_custkey bigint, o_orderpriority string")
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    for made, column in ((I.notes(spark, str(tmp_path)), "text"), (I.loose_calls(spark, str(tmp_path)), "payload")):
        plan = made.where(F.col(column).rlike("x1y2")).groupBy(F.length(column)).count()._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("x1y2") < plan.index("Repartition") and plan.count("Dowód osobisty") == 1
    assert I.notes(spark, str(tmp_path)).count() == 20 and I.notes(spark, str(tmp_path)).columns == ["doc_id", "lang", "text"]


def test_json_is_searched_as_its_strings_say(spark):
    """Escapes hide what a JSON text holds, and malformed JSON is an error without anything to find, too."""
    from maskline.catalog import detectors

    rows = detectors(["pl"])
    texts = ['{"a": "jan\\u0040example.pl"}', '{"a": "\\u0034\\u0034051401359"}', '["x", {"b": "nothing"}]', '{"jan@example.pl": 44051401359}']
    calls = spark.createDataFrame(list(enumerate(texts)), "id int, payload string")
    options = dict(key=["id"], free_text=[], json=["payload"], lang=F.lit("pl"))
    result = tokenize(calls, rows, **options)
    got = {r["id"]: r["payload"] for r in result.table.collect()}
    assert got == {0: '{"a": "[EMAIL_001]"}', 1: '{"a": "[PL_PESEL_001]"}', 2: texts[2], 3: texts[3]}
    back = {r["id"]: r["payload"] for r in restore(result.table, result.mapping, key=["id"], json=["payload"]).collect()}
    assert back == {0: '{"a": "jan@example.pl"}', 1: '{"a": "44051401359"}', 2: texts[2], 3: texts[3]}
    escaped = spark.createDataFrame([(0, '{"a": "\\u005bEMAIL_001]"}')], "id int, payload string")
    assert restore(escaped, result.mapping, key=["id"], json=["payload"]).first()["payload"] == '{"a": "jan@example.pl"}'
    with pytest.raises(Exception, match="malformed JSON"):
        tokenize(spark.createDataFrame([(0, '{"a": "nothing"')], "id int, payload string"), rows, **options)


def test_a_folder_is_listed_by_tasks_as_spark_lists_it(spark, tmp_path):
    """The driver holds no list of the files; those that count, and what they say, are Spark's."""
    from maskline.sources import documents as IO

    held = {"a.txt": b"1", "deep/er/b": "ł\r\n".encode(), "_hidden": b"2", ".dot": b"3", "_x=1": b"4", "deep/_sub/c": b"5", "_y=2/d": b"6",
            "e._COPYING_": b"7", "empty": b"", "z.txt.gz": gzip.compress(b"8"), "plus+%41 .txt": b"9", "_metadata": b"10"}
    for name, data in held.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(data)
    got = IO.read_folder(spark, str(tmp_path / "in"))
    assert "FileScan text" not in got._jdf.queryExecution().toString()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, IO._read_by_spark(spark, str(tmp_path / "in")).collect()))
    assert len(got.collect()) == 6
    assert IO.read_folder(spark, str(tmp_path / "in" / "a.txt")).count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        IO.read_folder(spark, str(tmp_path / "nowhere")).count()
    (tmp_path / "bare").mkdir()
    assert IO.read_folder(spark, str(tmp_path / "bare"), lang="pl").collect() == []


def test_token_consistency_joins_spans_and_mapping_once(spark, tmp_path):
    from registry import queries

    orders = spark.createDataFrame([(i, i % 7) for i in range(1, 41)], "o_orderkey bigint, o_custkey bigint")
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    result = queries.token_consistency(spark, str(tmp_path))
    assert "Join" not in result._jdf.queryExecution().toString()
    told = {r["pii_type"]: r for r in result.collect()}
    assert tuple(told["EMAIL"])[1:] == (7, 7, 40, 0)
