import math
import re
from collections import Counter

from pyspark.sql import functions as F

from maskline import catalog as C
from maskline.operators import retrieve as R
from maskline.operators.lookup import hot_keys, salted_join
from maskline.operators.tokenize import restore
from maskline.plans import jobs as P
from maskline.streaming import jobs as G


def test_salted_join_equals_plain_join(spark):
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"))
    right = spark.createDataFrame([("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(40)], "k string, v int")
    assert [r["k"] for r in hot_keys(left, ["k"], 500).collect()] == ["hot"]
    for how in ("inner", "left"):
        plain = Counter(map(tuple, left.join(right, "k", how).select("id", "k", "v").collect()))
        salted = salted_join(left, right, ["k"], ["id"], how, hot_rows=500).select("id", "k", "v")
        assert Counter(map(tuple, salted.collect())) == plain


QUESTIONS = [(1, "Jakie zgłoszenia złożył klient z PESEL 44051401359?"), (2, "zzz"), (3, "a a b")]
TICKETS = [
    (1, "Klient Jan (PESEL 44051401359) pyta o przelew."), (2, "Anna (anna@example.pl) prosi o zmianę."),
    (3, "Faktura dla NIP 526-000-12-46."), (4, "Jan chce potwierdzenia, że PESEL 44051401359 jest dobry."), (5, "a b b"),
]


def bag(text):
    return Counter(w.lower() for w in re.findall(r"\w+", text))


def cosine(a, b):
    dot = sum(a[w] * b[w] for w in a)
    return dot / math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values())) if dot else 0.0


def test_retrieval_matches_brute_force(spark):
    asked = spark.createDataFrame(QUESTIONS, "query_id int, text string")
    docs = spark.createDataFrame(TICKETS, "doc_id int, text string")
    assert {(r[0], r[1]): r[2] for r in R.bag_of_words(docs).collect()} == {
        (i, w): n for i, t in TICKETS for w, n in bag(t).items()
    }
    hits = R.top_k(R.cosine_scores(asked, docs), 2, queries=asked, docs=docs).collect()
    for q, text in QUESTIONS:
        ranked = sorted(((-cosine(bag(text), bag(t)), d) for d, t in TICKETS))[:2]
        mine = sorted((r["rank"], r["doc_id"], r["score"]) for r in hits if r["query_id"] == q)
        assert [m[1] for m in mine] == [d for _, d in ranked]
        assert all(abs(m[2] + s) < 1e-12 for m, (s, _) in zip(mine, ranked))


def test_leading_scores_are_all_that_ranking_needs(spark):
    texts = [(i, f"a b {'c ' * (i % 7)} {'d' if i % 3 else 'e'}") for i in range(400)] + [(400, None), (401, "")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(5)
    asked = spark.createDataFrame([(1, "a c"), (2, "d"), (3, "x"), (4, None)], "query_id int, text string")
    for k in (1, 5):
        few = R.leading_scores(asked, docs, k)
        assert few.count() <= 5 * 3 * k
        want = R.top_k(R.cosine_scores(asked, docs), k, queries=asked, docs=docs)
        assert set(R.top_k(few, k, queries=asked, docs=docs).collect()) == set(want.collect())


def test_retrieval_with_redaction(spark):
    asked = spark.createDataFrame(QUESTIONS[:1], "query_id int, text string").withColumn("lang", F.lit("pl"))
    docs = spark.createDataFrame(TICKETS, "doc_id int, text string").withColumn("lang", F.lit("pl"))
    job = P.retrieval(docs, asked, C.detectors(["pl"]))
    assert {r["doc_id"] for r in job.hits.collect()} == {1, 4}
    prompt = job.prompts.first()["prompt"]
    assert "44051401359" not in prompt and prompt.count("[PL_PESEL_001]") == 3
    replies = spark.createDataFrame([(1, "Chodzi o [PL_PESEL_001].")], "query_id int, text string")
    assert P.answers(replies, job.mapping).first()["text"] == "Chodzi o 44051401359."


def test_streams_grow_the_mapping_and_replay_safely(spark, tmp_path):
    rows = C.detectors(["pl"])
    source = tmp_path / "in"
    store, out = str(tmp_path / "mapping"), str(tmp_path / "out")
    sent = {}

    def send(*items):
        sent.update(items)
        spark.createDataFrame([(i, "pl", t) for i, t in items], "doc_id bigint, lang string, text string").coalesce(1).write.mode("append").parquet(str(source))

    def stream():
        return spark.readStream.schema("doc_id bigint, lang string, text string").option("maxFilesPerTrigger", 1).parquet(str(source))

    def run():
        G.tokenize_stream(stream(), rows, store, out, str(tmp_path / "c1")).awaitTermination()
        return {r["doc_id"]: r["text"] for r in spark.read.parquet(out).collect()}

    send((1, "jan@example.pl"), (2, "anna@example.pl"))
    first = run()
    send((3, "jan@example.pl i nowy@example.pl"))
    second = run()
    assert second[3].startswith(first[1] + " i ") and second[3].endswith("[EMAIL_003]")
    before = {tuple(r) for r in G.stored_mapping(spark, store).collect()}
    batch = spark.read.parquet(str(source)).where("doc_id = 3")
    G.tokenize_batch(batch, 1, rows, store, out)
    assert {tuple(r) for r in G.stored_mapping(spark, store).collect()} == before
    back = str(tmp_path / "back")
    replies = spark.readStream.schema("doc_id bigint, lang string, text string").parquet(out)
    G.restore_stream(replies, store, back, str(tmp_path / "c2")).awaitTermination()
    assert {r["doc_id"]: r["text"] for r in spark.read.parquet(back).collect()} == sent
    assert restore(spark.read.parquet(out), G.stored_mapping(spark, store)).count() == 3
    found = str(tmp_path / "found")
    G.detect_stream(stream(), rows, found, str(tmp_path / "c3")).awaitTermination()
    assert spark.read.parquet(found).count() == 4
