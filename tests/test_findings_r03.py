"""Faults found in round 3: work done twice, tables as folders, broadcasts of findings."""

import random

import pytest
from pyspark.sql import functions as F

from maskline import catalog as C
from maskline.functions import spans as S
from maskline.operators import audit as A
from maskline.operators import detect as D
from maskline.operators import known as K
from maskline.operators import lookup as L
from maskline.operators import mapping as M
from maskline.operators.tokenize import restore, round_trip_differences, tokenize
from registry import inputs as I
from registry import queries as Q


def test_dropped_overlaps_are_never_broadcast(spark, docs):
    found = docs("CID 12345678901, 123456789", "klient1@example.pl")
    rows = C.detectors(["pl"], include_opt_in=True)
    dropped = A.dropped_overlaps(D.detect(found, rows), D.detect(found, rows, resolve=True))
    dropped.collect()
    plan = dropped._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_dropped_overlaps_keep_rows_of_null_keys(spark):
    schema = "doc_id bigint, start int, end int, detector string"
    found = spark.createDataFrame([(1, 0, 5, "a"), (1, 0, 3, "b"), (None, 0, 5, "a"), (1, 0, 3, "b")], schema)
    kept = spark.createDataFrame([(1, 0, 5, "a"), (None, 0, 5, "a")], schema)
    assert sorted(map(str, A.dropped_overlaps(found, kept).select("doc_id", "detector").collect())) == sorted(
        map(str, found.select("doc_id", "detector").where("detector = 'b' or doc_id is null").collect())
    )


def test_streams_read_a_table_that_is_a_folder(spark, tmp_path):
    rows = [(i, f"write to a{i}@example.org", "en") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    df.repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    assert Q.stream_detect(spark, str(tmp_path)).count() == 4
    assert Q.stream_tokenize(spark, str(tmp_path)).where("text like '%[EMAIL_%'").count() == 4
    back = {r.doc_id: r.text for r in Q.stream_restore(spark, str(tmp_path)).collect()}
    assert back == {i: text for i, text, _ in rows}


def test_allocation_computes_its_values_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    schema = "scope string, pii_type string, value string"
    values = spark.createDataFrame([("corpus", "EMAIL", f"v{i}") for i in range(50)], schema).mapInArrow(counted, schema)
    assert M.allocate(values).agg(F.max("ordinal")).first()[0] == 50
    assert seen.value == 50


def _one_by_one(monkeypatch, *args, **options):
    with monkeypatch.context() as m:
        m.setattr(S, "TOGETHER", frozenset())
        return D.look_alikes(*args, **options).collect()


@pytest.mark.parametrize("langs", [["pl"], ["pl", "en"]])
def test_patterns_searched_together_find_what_each_finds_alone(spark, docs, monkeypatch, langs):
    rng = random.Random(3)
    bits = ["+48", "48", "123", "600 111 222", "123-456-78-90-123", "1234-5678-9012-3456-7890", "1234 5678 9012 3456", "PL", "ABC 123456",
            "AB1234567", "00-950", "12345678901", "123456789", "1234567890", "12345678901234", " ", " ", "-", "-", ", ", "ą", "_", "x",
            "4000000000999983", "PL61109010140000071219812874", S.MARK, S.SEPARATOR, "٣", "😀", "a@b.pl", "@"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 30))) for _ in range(400)]
    table = docs(*texts, "123 456 789 012 345 678 " * 50, "", None)
    rows = C.detectors(langs, include_opt_in=True)
    together = D.look_alikes(table, rows).collect()
    alone = _one_by_one(monkeypatch, table, rows)
    assert len(together) > 500 and sorted(together) == sorted(alone)


def test_words_before_are_read_alike_with_and_without_uneven_white_space(spark, docs):
    far = "pesel " + "a " * 60
    texts = ["PESEL  a\tb\nc d 44051401359", "PESEL a b c d 44051401359", "PESEL a b c d e 44051401359", "pesel" + " " * 300 + "44051401359",
             "pesel " + "ą" * 200 + " 44051401359", far + "44051401359"]
    rows = [d for d in C.detectors(["pl"]) if d.name == "pl_pesel"]
    scores = {r.doc_id: round(r.score, 2) for r in D.detect(docs(*texts), rows).collect()}
    assert scores == {0: 1.0, 1: 1.0, 2: 0.85, 3: 1.0, 4: 1.0, 5: 0.85}


def test_longest_task_does_not_grow_with_the_notes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "PART_ROWS", {"orders": 100})
    orders = spark.range(4_000).select(F.col("id").alias("o_orderkey"), (F.col("id") % 90).alias("o_custkey"))
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    notes = I.notes(spark, str(tmp_path))
    sizes = [r["n"] for r in notes.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 4_000 and max(sizes) < 200


def test_long_lists_send_few_substrings_however_long_they_are(spark, monkeypatch):
    values = [f"Anna {i}ska" for i in range(3000)] + ["x", "Żó", "abc\U0001f600defghijklmnopqrstuvwxyz", "\U0001f600"]
    texts = [f"Pisze {values[i]}, a {values[3 * i]}ok i klient numer {i}. " + "bez danych " * 20 for i in range(300)]
    texts += ["x", "", None, "ó Żó", "-abc\U0001f600defghijklmnopqrstuvwxyz", "abc\U0001f600defghijklmnopqrstuvwxy"]
    known = spark.createDataFrame([(v, "PERSON", i) for i, v in enumerate(values)], "value string, pii_type string, seq int")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    staged = {}

    def spied(df, label, *size, stage=K.stage):
        out = stage(df, label, *size)
        staged[label] = out[1]
        return out

    for module in (L, K):  # more values than a filter has bits for
        monkeypatch.setattr(module, "FILTER_BITS", 1 << 14, raising=False)
    monkeypatch.setattr(K, "stage", spied)
    told = {r.doc_id: [k.value for k in r[K.KNOWN] or []] for r in K.attach_known(docs, known, [], spread=["doc_id"]).collect()}
    for i, text in enumerate(texts):
        assert {v for v in values if v in (text or "")} <= set(told[i]) and len(told[i]) < 100
    # 6 or 7 of 100 places of a text begin what a filter of 5 bits for a value lets through, not all
    assert staged["known-near"] < 0.2 * sum(len(t or "") for t in texts)


def test_joins_without_hot_keys_are_not_salted(spark):
    left = spark.range(300).select("id", (F.col("id") % 30).alias("k"))
    right = spark.range(20).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    joined = L.salted_join(left, right, ["k"], ["id"], hot_rows=50)
    assert "_salt" not in joined._jdf.queryExecution().analyzed().toString()
    assert joined.count() == 200
    assert "_salt" in L.salted_join(left, right, ["k"], ["id"], hot_rows=5)._jdf.queryExecution().analyzed().toString()


def test_an_equal_round_trip_restores_once(spark, docs):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = docs("PESEL 44051401359", "jan@example.pl", "bez danych")
    result = tokenize(source, C.detectors(["pl"]))
    restored = restore(result.table, result.mapping, columns=["text"]).mapInArrow(counted, source.schema)
    wrong = round_trip_differences(source, restored, ["doc_id"], ["text"])
    assert wrong.columns == ["doc_id"] and wrong.count() == 0
    assert seen.value == 3


def test_small_groups_are_numbered_alike_without_buckets(spark, monkeypatch):
    rows = [(f"{s}", t, f"v{i}") for s in range(40) for t in ("EMAIL", "PERSON") for i in range(s % 7 + 1)] + [(None, "EMAIL", "v")]
    values = spark.createDataFrame(rows, "scope string, pii_type string, value string")
    taken = M.allocate(values.where("value < 'v2'"))
    for options in ({}, {"mapping": taken}):
        few = M.allocate(values, **options)
        assert "_bucket" not in few._jdf.queryExecution().analyzed().toString()
        with monkeypatch.context() as m:
            m.setattr(M, "SMALL_GROUP", 0)
            many = M.allocate(values, **options)
            assert "_bucket" in many._jdf.queryExecution().analyzed().toString()
            assert set(few.collect()) == set(many.collect()) and few.count() > 0


def test_texts_meet_their_lists_once(spark, monkeypatch):
    monkeypatch.setattr(L, "BROADCAST_ROWS", 0)
    known = spark.createDataFrame([(c, f"Anna {c}ska", "PERSON", 1) for c in range(5)], "c int, value string, pii_type string, seq int")
    docs = spark.createDataFrame([(c, c, f"Anna {c}ska") for c in (1, 2, 9)], "c int, doc_id int, text string")
    listed = K.attach_known(docs, known, ["c"], spread=["doc_id"])
    assert "Join" not in listed._jdf.queryExecution().optimizedPlan().toString()
    assert {r.doc_id: len(r[K.KNOWN] or []) for r in listed.collect()} == {1: 1, 2: 1, 9: 0}


def test_two_overlapping_spans_are_settled_as_before(spark):
    # score, then length, then the left one, then the order of the catalog
    kind = "start int, end int, rank int, detector string, score double"
    cases = [
        ([(0, 5, 1, "a", 0.4), (3, 9, 0, "b", 0.4)], 1), ([(0, 5, 1, "a", 0.5), (3, 9, 0, "b", 0.4)], 0),
        ([(0, 5, 1, "a", 0.4), (3, 8, 0, "b", 0.4)], 0), ([(0, 5, 1, "a", 0.4), (0, 5, 0, "b", 0.4)], 1),
    ]
    df = spark.createDataFrame([(i, spans) for i, (spans, _) in enumerate(cases)], f"i int, spans array<struct<{kind.replace(' ', ':')}>>".replace(",:", ","))
    out = {r.i: [tuple(x) for x in r.s] for r in df.select("i", F.expr(S.untangle("spans")).alias("s")).collect()}
    assert out == {i: [spans[won]] for i, (spans, won) in enumerate(cases)}


def test_values_are_numbered_once_and_travel_without_digests(spark, docs, monkeypatch):
    result = tokenize(docs("PESEL 44051401359", "jan@example.pl"), C.detectors(["pl"]))
    plans = [x._jdf.queryExecution().optimizedPlan().toString() for x in (result.table, result.mapping)]
    assert not any("sha2" in p or "Window" in p for p in plans)
    monkeypatch.setattr(M, "SMALL_GROUP", 0)
    values = spark.createDataFrame([("s", "EMAIL", f"v{i}") for i in range(9)], "scope string, pii_type string, value string")
    numbered = M.allocate(values)
    lines = numbered._jdf.queryExecution().sparkPlan().toString().splitlines()
    below = [line for i, line in enumerate(lines) if any("RepartitionByExpression" in x or "Exchange" in x for x in lines[:i])]
    assert below and not any("_digest" in line for line in below)
    assert sorted(r.ordinal for r in numbered.collect()) == list(range(1, 10))
