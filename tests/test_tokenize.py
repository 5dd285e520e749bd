import json

import pytest
from pyspark.sql import functions as F

from maskline import catalog as C
from maskline.operators import mapping as M
from maskline.operators.known import KNOWN, attach_known
from maskline.operators.tokenize import restore, round_trip_differences, tokenize
from maskline.plans import jobs as P
from maskline.sources import documents as IO

ROWS = C.detectors(["pl"], include_opt_in=True)
FILE = (
    "Karta klienta\nPESEL: 02070803628\nDowód: ABC123456\nE-mail: anna.nowak@example.pl\nTelefon: +48 600 123 456\n"
    "NIP: 526-000-12-46\nREGON: 123456785\nKRS: 0000123456\nKonto: PL61109010140000071219812874\nUwaga: 44051401358"
)


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_round_trip_and_edges(docs):
    source = docs(
        "PESEL 44051401359, NIP 526-000-12-46, jan@example.pl, tel +48 600 123 456.",
        FILE, "", None, "nic", "😀 jan@example.pl ż44051401359", "stary [EMAIL_001] i [NIE_9]",
        "długi " + "ąx " * 5000 + "jan@example.pl " * 200,
    )
    out = tokenize(source, ROWS)
    got = texts(out.table)
    assert "44051401359" not in got[0] and "jan@example.pl" not in got[0]
    assert "44051401358" in got[1] and "0000123456" not in got[1]
    assert got[2] == "" and got[3] is None and got[4] == "nic"
    assert got[7].count("[EMAIL_") == 200
    tokens = {r["value"]: r["token"] for r in out.mapping.collect()}
    assert got[6] == f"stary {tokens['[EMAIL_001]']} i {tokens['[NIE_9]']}"
    assert tokens["[EMAIL_001]"].startswith("[LITERAL_")
    assert got[5] == f"😀 {tokens['jan@example.pl']} ż44051401359"
    assert round_trip_differences(source, restore(out.table, out.mapping), ["doc_id"], ["text"]).count() == 0


def test_second_run_allocates_nothing(docs):
    source = docs(FILE)
    mapping = tokenize(source, ROWS).mapping
    again = tokenize(source, ROWS, mapping=mapping)
    assert again.new.count() == 0 and again.mapping.count() == mapping.count() == 8


def test_same_tokens_for_any_number_of_partitions(docs):
    source = docs(*[f"osoba{i % 50}@example.pl i 4405140135{i % 10}" for i in range(300)])
    expected = texts(tokenize(source.repartition(1), ROWS).table)
    for n in (7, 64):
        assert texts(tokenize(source.repartition(n), ROWS).table) == expected


def test_lookup_only(docs):
    mapping = tokenize(docs("jan@example.pl"), ROWS).mapping
    got = texts(tokenize(docs("jan@example.pl i obcy@example.pl"), ROWS, mapping=mapping, allocate=False).table)
    assert got[0] == "[EMAIL_001] i [EMAIL_000]"
    with pytest.raises(ValueError, match="needs a mapping"):
        tokenize(docs("x"), ROWS, allocate=False)


def test_whitelist(docs):
    def got(text, entity, **options):
        return texts(tokenize(docs(text), ROWS, entities=[entity], **options).table)[0]

    text = "jan@example.pl 44051401359"
    assert got(text, "PL_PESEL", others="keep") == "jan@example.pl [PL_PESEL_001]"
    assert got(text, "PL_PESEL") == "<EMAIL_ADDRESS> [PL_PESEL_001]"
    assert got("5260001246", "PL_KRS") == "<PL_NIP>" and got("5260001246", "PL_KRS", others="keep") == "[PL_KRS_001]"
    with pytest.raises(ValueError, match="EMAIL_ADDRESS"):
        got(text, "PL_PESEL", others="error")
    with pytest.raises(ValueError, match="no detector finds"):
        tokenize(docs("x"), ROWS, entities=["US_SSN"])


def test_restore_in_any_order_and_unknown_tokens(docs, spark):
    mapping = spark.createDataFrame(
        [("corpus", "EMAIL", 1, "[EMAIL_001]", "a$1\\b@x.pl"), ("corpus", "EMAIL", 2, "[EMAIL_002]", "[EMAIL_001]")],
        M.MAPPING_SCHEMA,
    )
    got = texts(restore(docs("[EMAIL_002][EMAIL_001] [EMAIL_003] [x"), mapping, columns=["text"]))
    assert got[0] == "[EMAIL_001]a$1\\b@x.pl [EMAIL_003] [x"


def test_mixed_table(spark):
    table = spark.createDataFrame(
        [("1", "Jan Kowalski", "44051401359", 5, "kontakt anna@example.pl"),
         ("2", "Anna Nowak", "", 6, "Jan, PESEL 44051401359"), ("3", None, "zły", 7, None)],
        "id string, name string, pesel string, n int, notes string",
    )
    out = tokenize(
        table, ROWS, key=["id"], free_text=["notes", "absent"], lang=F.lit("pl"),
        typed={"name": "PERSON", "pesel": "PL_PESEL", "n": "PERSON", "missing": "EMAIL"},
    )
    got = {r["id"]: r for r in out.table.collect()}
    assert out.table.columns == table.columns
    assert got["2"]["notes"] == f"Jan, PESEL {got['1']['pesel']}"
    assert got["2"]["pesel"] == "" and got["3"]["name"] is None and got["3"]["n"] == 7
    assert got["3"]["pesel"].startswith("[PL_PESEL_")
    assert {tuple(r) for r in restore(out.table, out.mapping, key=["id"]).collect()} == {tuple(r) for r in table.collect()}


def test_nested_payload(spark):
    schema = (
        "struct<to:string,n:int,ok:boolean,inner:struct<`a.b`:string,list:array<array<string>>>,"
        "tags:map<string,string>,people:array<struct<mail:string,age:int>>>"
    )
    value = (
        '{"to":"jan@example.pl","n":5260001246,"ok":true,"inner":{"a.b":"PESEL 44051401359","list":[["x",null],'
        '["jan@example.pl"],null]},"tags":{"k@example.pl":"anna@example.pl"},"people":[{"mail":"jan@example.pl","age":3},null]}'
    ).replace("5260001246", "7")
    calls = spark.createDataFrame([(1, value), (2, '{"to":null}'), (3, None)], "id int, raw string").select(
        "id", F.from_json("raw", schema).alias("p")
    )
    out = tokenize(calls, ROWS, key=["id"], free_text=["p"], lang=F.lit("pl"))
    assert out.table.schema["p"].dataType.simpleString() == calls.schema["p"].dataType.simpleString()
    p = {r["id"]: r["p"] for r in out.table.collect()}[1]
    jan = p["to"]
    assert jan.startswith("[EMAIL_") and p["people"][0]["mail"] == jan and p["people"][1] is None
    assert p["inner"]["a.b"] == "PESEL [PL_PESEL_001]" and p["inner"]["list"] == [["x", None], [jan], None]
    assert list(p["tags"]) == ["k@example.pl"] and p["tags"]["k@example.pl"].startswith("[EMAIL_") and p["n"] == 7
    back = restore(out.table, out.mapping, key=["id"])
    assert {r["id"]: r["p"] for r in back.collect()} == {r["id"]: r["p"] for r in calls.collect()}


PAYLOADS = (
    '{"do": "jan@example.pl", "jan@example.pl" : 44051401359, "x": [1, 2.50, {"y": "PESEL 44051401359\\n\\"ok\\""}], "e": ""}',
    '["Micha\\u0142 jan@example.pl", null, true, "bez \\\\ danych \ue001"]',
    '"jan@example.pl"',
    "17",
    " {} ",
    None,
)


def test_payloads_of_any_shape(spark):
    calls = spark.createDataFrame(list(enumerate(PAYLOADS)), "id int, payload string")
    out = tokenize(calls, ROWS, key=["id"], free_text=[], json=["payload"], lang=F.lit("pl"))
    got = {r["id"]: r["payload"] for r in out.table.collect()}
    assert got[0].startswith('{"do": "[EMAIL_001]", "jan@example.pl" : 44051401359, "x": [1, 2.50, {"y": "PESEL [PL_PESEL_001]\\n')
    assert json.loads(got[0])["x"][2]["y"] == 'PESEL [PL_PESEL_001]\n"ok"' and got[2] == '"[EMAIL_001]"'
    assert json.loads(got[1]) == ["Michał [EMAIL_001]", None, True, "bez \\ danych \ue001"]
    assert [got[i] for i in (3, 4, 5)] == list(PAYLOADS[3:])
    back = {r["id"]: r["payload"] for r in restore(out.table, out.mapping, key=["id"], json=["payload"]).collect()}
    assert {i: p and json.loads(p) for i, p in back.items()} == {i: p and json.loads(p) for i, p in enumerate(PAYLOADS)}
    assert back[0] == PAYLOADS[0]


def test_variant_payloads(spark):
    calls = spark.createDataFrame(list(enumerate(PAYLOADS)), "id int, raw string").select("id", F.parse_json("raw").alias("p"))
    out = tokenize(calls, ROWS, key=["id"], free_text=["p"], lang=F.lit("pl"))
    read = lambda df: {r["id"]: r["p"] and json.loads(r["p"]) for r in df.select("id", F.to_json("p").alias("p")).collect()}
    got = read(out.table)
    assert got[0]["do"] == "[EMAIL_001]" and got[0]["jan@example.pl"] == 44051401359 and got[4] == {}
    assert out.table.schema["p"].dataType.simpleString() == "variant"
    assert read(restore(out.table, out.mapping, key=["id"])) == read(calls)


@pytest.mark.parametrize("bad", ['{"a": "jan@example.pl"', "{'a': 1}", "jan@example.pl", '{"a": 1} jan@example.pl', "1, 2", ""])
def test_malformed_payload_is_an_error(spark, bad):
    calls = spark.createDataFrame([(1, bad)], "id int, payload string")
    with pytest.raises(Exception, match="malformed JSON"):
        tokenize(calls, ROWS, key=["id"], free_text=[], json=["payload"], lang=F.lit("pl")).table.collect()


def test_read_payloads_of_any_shape(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n\n[2]\n')
    assert sorted(r["payload"] for r in IO.read_payloads(spark, str(tmp_path)).collect()) == ["[2]", '{"a": 1}']
    (tmp_path / "b.jsonl").write_text('{"a": \n')
    with pytest.raises(Exception, match="malformed JSON"):
        IO.read_payloads(spark, str(tmp_path)).collect()


def test_custom_detector(docs):
    row = C.custom_detector(
        "customer_id", r"(?<![\p{L}\p{N}_])CID-\d{5}(?![\p{L}\p{N}_])", pii_type="PERSON", score=0.85
    )
    source = docs("Klient CID-12345 (PESEL 44051401359) i CID-67890.")
    out = tokenize(source, [*ROWS, row])
    assert out.mapping.count() == 3 and "[PERSON_002]" in texts(out.table)[0]
    assert texts(restore(out.table, out.mapping))[0] == texts(source)[0]


def python_replace(text, names):
    for i, name in enumerate(names):
        text = text.replace(name, f"<{i}>")
    return text


def test_known_values_replace_in_list_order(docs, spark):
    names = ["Jan Kowalski", "Jan", "a\\Eb", "Kowal", "nikt"]
    source = docs("Jan Kowalski i Jan; Janusz Kowal a\\Eb.", "jan.Jan.x@example.pl", None).withColumn("c", F.lit(1))
    known = spark.createDataFrame([(1, n, "PERSON", i) for i, n in enumerate(names)], "c int, value string, pii_type string, seq int")
    out = tokenize(attach_known(source, known, ["c"], spread=["doc_id"]), [], known=KNOWN)
    tokens = {r["value"]: r["token"] for r in out.mapping.collect()}
    assert set(tokens) == set(names) - {"nikt"}
    got = texts(out.table)
    for i in (0, 1):
        want = python_replace(texts(source)[i], names)
        for k, n in enumerate(names):
            want = want.replace(f"<{k}>", tokens.get(n, ""))
        assert got[i] == want
    both = texts(tokenize(attach_known(source, known, ["c"], spread=["doc_id"]), ROWS, known=KNOWN).table)
    assert both[1].startswith("jan.[PERSON_") and "example" not in both[1]


def test_subject_access(spark, tmp_path):
    cases = spark.createDataFrame(
        [(1, 1, "pl", "Klient: Anna Nowak (PESEL 02070803628). Email: anna.nowak@example.pl."),
         (1, 2, "pl", "Anna Nowak pisze. Bartosz Wiśniewski (bartosz@example.com) i PESEL 44051401359."),
         (1, 3, "pl", "Faktura dla anna.nowak@example.pl, NIP 5260001246, kopia bartosz@example.com.")],
        "case_id int, doc_id int, lang string, text string",
    )
    subject = spark.createDataFrame(
        [(1, "Anna Nowak", "PERSON"), (1, "anna.nowak@example.pl", "EMAIL"), (1, "02070803628", "PL_PESEL")],
        "case_id int, value string, pii_type string",
    )
    names = spark.createDataFrame([(1, "Bartosz Wiśniewski", 1)], "case_id int, name string, seq int")
    vault = str(tmp_path / "vault")
    out = P.deliver_to_subjects(cases, subject, names, C.detectors(["pl"]), vault=vault)
    got = texts(out.table)
    assert got[1] == texts(cases)[1]
    assert got[2] == "Anna Nowak pisze. [PERSON_001] ([EMAIL_001]) i PESEL [PL_PESEL_001]."
    assert "anna.nowak@example.pl" in got[3] and "bartosz" not in got[3] and "[PL_NIP_001]" in got[3]
    assert spark.read.parquet(vault).count() == out.mapping.count() == 8  # 2 + 3 + 3
    assert P.subject_access_artifacts(cases, out.table).count() == 6


def test_customer_files(docs):
    job = P.customer_files(docs(FILE))
    assert job.differences.count() == 0 and job.mapping.count() == 8
    assert {r["detector"]: r["n"] for r in job.refused.collect()}["pl_pesel"] == 1


def test_unchanged_texts_are_not_shuffled(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang", "text")
    plan = tokenize(frame, C.detectors(["en", "de"]), unknown_lang="skip").table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union")


def test_folder_of_texts(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "a b.txt").write_text("jedna\nlinia jan@example.pl", encoding="utf-8")
    (tmp_path / "in" / "sub" / "c.txt").write_text("ż", encoding="utf-8")
    read = IO.read_folder(spark, str(tmp_path / "in"), "pl")
    assert texts(read) == {"a b.txt": "jedna\nlinia jan@example.pl", "sub/c.txt": "ż"}
    job = P.batch(read, ROWS)
    assert job.differences.count() == 0
    IO.write_documents(job.documents, str(tmp_path / "out"))
    assert texts(IO.read_table(spark, str(tmp_path / "out")))["a b.txt"] == "jedna\nlinia [EMAIL_001]"


def test_paths_for_large_corpora_give_the_same_result(docs, monkeypatch):
    """Salted look-ups and bucketed numbering, forced on a small corpus with a hot value."""
    from maskline.operators import lookup

    source = docs(*[f"hot@example.pl i osoba{i % 37}@example.pl, 44051401359" for i in range(200)])
    plain = tokenize(source, ROWS)
    expected, entries = texts(plain.table), set(plain.mapping.collect())
    monkeypatch.setattr(lookup, "HOT_ROWS", 50)
    large = tokenize(source, ROWS)
    assert "_salt" in large.table._jdf.queryExecution().analyzed().toString()
    assert texts(large.table) == expected and set(large.mapping.collect()) == entries
    assert texts(restore(large.table, large.mapping)) == texts(source)


def test_known_values_without_a_broadcast(docs, spark, monkeypatch):
    from maskline.operators import lookup

    source = docs(*[f"Jan i Ewa {i}" for i in range(100)]).withColumn("c", F.when(F.col("doc_id") < 80, 1).otherwise(2))
    known = spark.createDataFrame(
        [(1, "Jan", "PERSON", 1), (2, "Ewa", "PERSON", 1)], "c int, value string, pii_type string, seq int"
    )

    def run():
        listed = attach_known(source, known, ["c"], spread=["doc_id"])
        return texts(tokenize(listed, [], known=KNOWN).table)

    small = run()
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(lookup, "HOT_ROWS", 50)
    assert run() == small and small[0] == "[PERSON_001] i Ewa 0".replace("001", small[0][8:11])


def test_null_and_repeated_keys(spark):
    rows = [(None, "pl", "jan@example.pl"), (1, "pl", "x jan@example.pl"), (1, "pl", "text eva@example.pl"), (1, "pl", "text eva@example.pl")]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    done = tokenize(docs, C.detectors(), lang="lang")
    texts = [r["text"] for r in done.table.collect()]
    assert len(texts) == 4 and not any("@" in t for t in texts)
    assert sum(t.startswith("text [EMAIL_") for t in texts) == 2
    back = restore(done.table, done.mapping, columns=["text"])
    assert sorted(r["text"] for r in back.collect()) == sorted(r[2] for r in rows)


def test_null_scope_is_an_error(spark):
    docs = spark.createDataFrame([(1, "pl", None, "jan@example.pl")], "doc_id bigint, lang string, s string, text string")
    with pytest.raises(Exception, match="null scope"):
        tokenize(docs, C.detectors(), scope=F.col("s")).table.collect()


def test_long_literal_is_not_given_away_again(docs):
    done = tokenize(
        docs("[EMAIL_999999999999999] [EMAIL_1000000000000000] jan@example.pl"), C.detectors(), literals="keep"
    )
    assert done.mapping.collect()[0]["token"] == "[EMAIL_1000000000000001]"
    assert done.table.collect()[0]["text"].endswith("[EMAIL_1000000000000000] [EMAIL_1000000000000001]")


def test_tokens_in_later_texts_come_back_as_they_were(docs):
    first = tokenize(docs("jan@example.pl"), ROWS)
    later = docs("[EMAIL_001] ewa@example.pl [EMAIL_99999999999999999999] [LITERAL_001]")
    done = tokenize(later, ROWS, mapping=first.mapping)
    assert "[EMAIL_001]" not in texts(done.table)[0] and "@" not in texts(done.table)[0]
    assert texts(restore(done.table, done.mapping)) == texts(later)


def test_threshold(docs):
    got = texts(tokenize(docs("ABC123456 44051401359, dowód ABC123456"), ROWS, min_score=0.75).table)[0]
    assert got == "ABC123456 [PL_PESEL_001], dowód [PL_ID_CARD_001]"


def test_known_values_after_detection(docs, spark):
    source = docs("jan pisze z jan@example.pl").withColumn("c", F.lit(1))
    known = spark.createDataFrame([(1, "z jan", "PERSON", 1), (1, "jan", "PERSON", 2)], "c int, value string, pii_type string, seq int")
    listed = attach_known(source, known, ["c"], spread=["doc_id"])
    assert texts(tokenize(listed, ROWS, known=KNOWN, known_first=False).table)[0] == "[PERSON_001] pisze z [EMAIL_001]"
