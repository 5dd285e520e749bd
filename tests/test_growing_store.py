"""The growing token mapping, bit filters, safe restore, comparisons by digest."""

import random
import re

import pytest
from pyspark.sql import functions as F

from maskline import catalog as C
from maskline.operators import audit as A
from maskline.operators import detect as D
from maskline.operators import known as K
from maskline.operators import retrieve as R
from maskline.operators.lookup import likely
from maskline.operators.mapping import MAPPING_SCHEMA
from maskline.operators.tokenize import restore, round_trip_differences, tokenize
from maskline.plans import jobs as P
from maskline.sources import mapping_store as V
from maskline.sources import token_store as S
from maskline.streaming import jobs as G

ROWS = C.detectors(["pl"])


def messages(spark, batch, n=20):
    texts = [(batch * n + i, "pl", f"od a{batch}x{i}@example.pl do stale{i % 5}@example.pl") for i in range(n)]
    return spark.createDataFrame(texts, "doc_id bigint, lang string, text string")


def test_likely_keeps_every_key_and_few_others(spark):
    big = spark.range(200_000).select(F.col("id").cast("string").alias("v"), F.lit("s").alias("scope"))
    keys = spark.range(0, 200_000, 400).select(F.col("id").cast("string").alias("v"), F.lit("s").alias("scope"))
    some = likely(big, keys, ["scope", "v"], 500)
    assert some.join(keys, ["scope", "v"]).count() == 500
    assert some.count() < 45_000
    assert likely(big, keys, ["scope", "v"], 10**9) is big


def test_store_grows_compacts_and_replays(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "COMPACT_AFTER", 4)
    monkeypatch.setattr(S, "LEAST_BUCKETS", 64)
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    for batch in range(7):
        G.tokenize_batch(messages(spark, batch), batch, ROWS, store, out)
    kept = S.TokenStore(spark, store)
    commits = kept.commits()
    assert [c.kind for c in commits] == ["base", "delta", "delta", "delta"]
    held = {(r["token"], r["value"]) for r in kept.entries().collect()}
    assert len(held) == len({t for t, _ in held}) == 7 * 20 + 5

    written = {r["doc_id"]: r["text"] for r in spark.read.parquet(out).collect()}
    G.tokenize_batch(messages(spark, 6), 6, ROWS, store, out)  # a replay
    assert {r["doc_id"]: r["text"] for r in spark.read.parquet(out).collect()} == written
    assert S.TokenStore(spark, store).commits() == commits

    wanted = spark.createDataFrame([("corpus", "EMAIL", "a0x3@example.pl")], "scope string, pii_type string, value string")
    one = kept.holding(wanted, 1)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)
    opened = {r[0] for r in one.select(F.input_file_name()).distinct().collect()}
    assert len([f for f in opened if "/base-" in f]) <= 1
    assert one.where("value = 'a0x3@example.pl'").count() == 1

    back = restore(spark.read.parquet(out).drop("batch_id"), kept)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {
        r["doc_id"]: r["text"] for b in range(7) for r in messages(spark, b).collect()
    }
    kept.compact()
    assert [c.kind for c in kept.commits()] == ["base"]
    assert {(r["token"], r["value"]) for r in kept.entries().collect()} == held
    high = kept.high_water(wanted).collect()
    assert [(r["pii_type"], r["ordinal"]) for r in high] == [("EMAIL", 145)]


def test_second_writer_of_a_store_fails(spark, tmp_path):
    store = str(tmp_path / "store")
    a, b = S.TokenStore(spark, store), S.TokenStore(spark, store)
    first = spark.createDataFrame([("corpus", "EMAIL", 1, "[EMAIL_001]", "x@y.pl")], MAPPING_SCHEMA)
    other = spark.createDataFrame([("corpus", "EMAIL", 1, "[EMAIL_001]", "q@y.pl")], MAPPING_SCHEMA)
    _, version_a = a.extend(0, "a")
    _, version_b = b.extend(0, "b")
    a.commit(first, version_a, writer="a", batch=0)
    with pytest.raises(S.StoreConflict):
        b.commit(other, version_b, writer="b", batch=0)
    with pytest.raises(S.StoreConflict, match="EMAIL_001"):
        b.append(other, writer="b", batch=1)
    a.append(first, writer="a", batch=0)  # the same batch again
    assert [tuple(r) for r in a.entries().collect()] == [("corpus", "EMAIL", 1, "[EMAIL_001]", "x@y.pl")]
    with pytest.raises(S.StoreConflict):
        S.TokenStore(spark, store).commit(other, version_a, writer="c", batch=0)


def test_empty_store(spark, tmp_path, docs):
    kept = S.TokenStore(spark, str(tmp_path / "none"))
    assert kept.entries().count() == 0
    kept.compact()
    assert tokenize(docs("jan@example.pl"), ROWS, mapping=kept).table.first()["text"] == "[EMAIL_001]"
    assert restore(docs("[EMAIL_001]"), kept, columns=["text"]).first()["text"] == "[EMAIL_001]"


def test_token_with_two_values_is_not_restored(spark, docs):
    two = [("corpus", "EMAIL", 1, "[EMAIL_001]", "q@y.pl"), ("corpus", "EMAIL", 1, "[EMAIL_001]", "x@y.pl")]
    with pytest.raises(Exception, match="two values"):
        restore(docs("do [EMAIL_001]"), spark.createDataFrame(two, MAPPING_SCHEMA), columns=["text"]).collect()
    same = spark.createDataFrame([two[0], two[0]], MAPPING_SCHEMA)
    assert restore(docs("do [EMAIL_001]"), same, columns=["text"]).first()["text"] == "do q@y.pl"


@pytest.mark.parametrize(
    "text",
    [
        None, "{}", "null", '{"entry":[]}', '{"entries":[{"token":"x","type":"EMAIL","value":"v"}]}',
        '{"entries":[{"token":"[EMAIL_001]","type":"EMAIL"}]}', '{"entries":[{"token":"[EMAIL_001]","type":"X","value":"v"}]}',
        '{"entries":[{"token":"[EMAIL_001]","type":"EMAIL","value":"a"},{"token":"[EMAIL_001]","type":"EMAIL","value":"b"}]}',
    ],
)
def test_wrong_mappings_are_errors(spark, text):
    with pytest.raises(Exception, match="in the mapping of scope|MALFORMED_RECORD"):
        V.import_json(spark.createDataFrame([("s", text)], "scope string, mapping_json string")).collect()


def test_round_trip_with_null_and_repeated_keys(spark):
    rows = [(None, "a"), (None, None), (1, "b"), (1, "b"), (2, "c")]
    make = lambda rows: spark.createDataFrame(rows, "doc_id bigint, text string")
    assert round_trip_differences(make(rows), make(rows[::-1]), ["doc_id"], ["text"]).count() == 0
    fewer = round_trip_differences(make(rows), make(rows[:3] + rows[4:]), ["doc_id"], ["text"])
    assert [r["doc_id"] for r in fewer.collect()] == [1]
    other = round_trip_differences(make(rows), make([(None, "a"), (None, ""), (1, "b"), (1, "b"), (2, "C"), (3, "x")]), ["doc_id"], ["text"])
    assert sorted(r["doc_id"] or 0 for r in other.collect()) == [0, 2, 3]


def test_case_scopes_differ(spark):
    pairs = [("a/b", "c"), ("a", "b/c"), ("a", None), (None, "a"), ("\\0", "a"), ("a\\", "b"), ("a", "\\b"), ("a\\/b", "c"), (None, None)]
    cases = spark.createDataFrame(pairs, "case_id string, doc_id string")
    assert len({r[0] for r in cases.select(P.case_scope()).collect()}) == len(pairs)
    assert spark.createDataFrame([(1, 2)], "case_id int, doc_id int").select(P.case_scope()).first()[0] == "1/2"


def in_list_order(text, values):
    """Spans of the values, each searched in what the earlier ones left."""
    spans = []
    for value in values:
        at = text.find(value)
        while at >= 0:
            spans.append((at, value))
            text = text[:at] + "\ue000" * len(value) + text[at + len(value) :]
            at = text.find(value, at + len(value))
    return [v for _, v in sorted(spans)]


def test_long_lists_of_known_values(spark):
    rng = random.Random(7)
    parts = ["an", "na", "Jan", "Kowal", "ski", "żółć", "𝄞", " ", "-", "b", "Ewa Nowak", "x" * 20]
    values = list(dict.fromkeys("".join(rng.choices(parts, k=rng.randint(1, 5))) for _ in range(600)))[:300]
    rows = [(i, i % 3, "".join(rng.choices(parts, k=12))) for i in range(90)] + [(90, None, "Jan"), (91, 1, None), (92, 2, "")]
    docs = spark.createDataFrame(rows, "doc_id int, c int, text string")
    listed = [(c, v, "PERSON", n) for c in range(2) for n, v in enumerate(values if c else values[::-1])]
    known = spark.createDataFrame(listed, "c int, value string, pii_type string, seq int")
    told = K.attach_known(docs, known, ["c"], spread=["doc_id"])
    assert told.agg(F.max(F.size(K.KNOWN))).first()[0] < len(values)
    done = tokenize(told, [], known=K.KNOWN, lang=F.lit("pl"))
    named = {r["token"]: r["value"] for r in done.mapping.collect()}
    lists = {0: values[::-1], 1: values}
    for r in done.table.collect():
        source = rows[r["doc_id"]][2]
        expected = in_list_order(source, lists.get(r["c"], [])) if source else []
        assert [named[t] for t in re.findall(r"\[PERSON_\d+\]", r["text"] or "")] == expected
        assert source is None or re.sub(r"\[PERSON_\d+\]", lambda m: named[m[0]], r["text"]) == source
    one_list = known.where("c = 1").drop("c")
    both = tokenize(K.attach_known(docs, one_list, [], spread=["doc_id"]), [], known=K.KNOWN, lang=F.lit("pl")).table
    assert both.where("text like '%[PERSON%'").count() > 60


def test_diff_joins_differing_buckets_only(spark, docs):
    source = docs(*[f"a{i}@example.pl i b{i}@example.pl" for i in range(50)])
    before = D.detect(source, ROWS)
    assert A.diff(before, before).count() == 0
    after = before.where("value <> 'a7@example.pl'").withColumn(
        "score", F.when(F.col("value") == "b9@example.pl", 0.9).otherwise(F.col("score"))
    )
    assert sorted((r["doc_id"], r["change"]) for r in A.diff(before, after).collect()) == [(7, "removed"), (9, "rescored")]


def test_copies_are_searched_once(spark, docs):
    source = docs(*["jan@example.pl", "nic", "PESEL 44051401359", "jan@example.pl"] * 20, None)
    assert sorted(D.detect_distinct(source, ROWS).collect()) == sorted(D.detect(source, ROWS).collect())
    with pytest.raises(Exception, match="no detectors"):
        D.detect_distinct(source, C.detectors(["en"]), lang=F.lit("xx")).collect()


def test_many_queries_are_ranked_in_blocks(spark, monkeypatch):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(40)]
    texts = [(i, " ".join(rng.choices(words, k=8))) for i in range(120)]
    asked = spark.createDataFrame(texts[:60], "query_id int, text string")
    docs = spark.createDataFrame(texts, "doc_id int, text string")
    whole = R.top_k(R.cosine_scores(asked, docs), 3, queries=asked, docs=docs).collect()
    monkeypatch.setattr(R, "BROADCAST_BYTES", 8_000)
    few = R.leading_scores(asked, docs, 3)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(query_id" not in plan
    assert set(R.top_k(few, 3, queries=asked, docs=docs).collect()) == set(whole)


def test_a_foreign_message_does_not_end_a_detect_stream(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, "xx", "jan@example.pl"), (2, "pl", "ewa@example.pl")], "doc_id bigint, lang string, text string").write.parquet(source)
    stream = spark.readStream.schema("doc_id bigint, lang string, text string").parquet(source)
    G.detect_stream(stream, ROWS, out, str(tmp_path / "c"), min_score=0.3).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_addresses_of_any_script_go_whole(spark, docs):
    source = docs("do józef.żak@example.pl, user@exämple.pl i a@b.c; x@y.żó.")
    found = D.detect(source, C.detectors()).where("detector = 'email'").orderBy("start")
    assert [r["value"] for r in found.collect()] == ["józef.żak@example.pl", "user@exämple.pl", "x@y.żó"]


def test_rows_without_typed_cells_or_names_are_not_shuffled(spark):
    rows = [(i, "pl", f"nic {i}", "Ewa" if i % 10 == 0 else None) for i in range(40)]
    people = spark.createDataFrame(rows, "id int, lang string, notes string, name string")
    done = tokenize(people, ROWS, key=["id"], free_text=["notes"], typed={"name": "PERSON"})
    plan = done.table._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan
    got = {r["id"]: (r["notes"], r["name"]) for r in done.table.collect()}
    assert got == {i: (n, "[PERSON_001]" if name else None) for i, _, n, name in rows}
    known = spark.createDataFrame([("nic 7", "PERSON", 1)], "value string, pii_type string, seq int")
    listed = K.attach_known(people, known, [], spread=["id"], texts=["notes"])
    texts = {r["id"]: r["notes"] for r in tokenize(listed, ROWS, key=["id"], free_text=["notes"], known=K.KNOWN).table.collect()}
    assert texts[7] == "[PERSON_001]" and texts[8] == "nic 8"


def test_fate_of_other_entities(spark, docs):
    source = docs("PESEL 44051401359, jan@example.pl, ewa@example.pl, ABC123456")
    fates = {"EMAIL_ADDRESS": lambda v: F.concat(F.lit("~"), F.substring(v, 1, 1)), "PL_ID_CARD": "keep"}
    done = tokenize(source, ROWS, entities=["PL_PESEL"], others=fates)
    assert done.table.first()["text"] == "PESEL [PL_PESEL_001], ~j, ~e, ABC123456"
    with pytest.raises(ValueError, match="EMAIL_ADDRESS"):
        tokenize(source, ROWS, entities=["PL_PESEL"], others={"EMAIL_ADDRESS": "error"})
    with pytest.raises(ValueError, match="NOBODY"):
        tokenize(source, ROWS, entities=["PL_PESEL"], others={"NOBODY": "keep"})
    with pytest.raises(ValueError, match="must be"):
        tokenize(source, ROWS, entities=["PL_PESEL"], others={"EMAIL_ADDRESS": "burn"})


def test_patterns_of_empty_texts_are_refused(spark):
    with pytest.raises(ValueError, match="empty text"):
        C.custom_detector("x", "a*", pii_type="X", score=0.5)
