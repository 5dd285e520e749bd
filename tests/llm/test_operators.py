"""Each operator against brute force on small fixtures, and its edge cases."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskline.llm import (
    bpe,
    decontaminate,
    extract,
    language,
    queries,
    secrets,
    superminhash,
    tokencounts,
    toxicity,
    urlfilter,
    vptree,
)
from maskline.llm.groups import components
from maskline.llm.queries import byte_bpe

SCHEMA = "doc_id bigint, text string, score int, label string"  # extra columns with clashing names
WORDS = [f"w{i}" for i in range(400)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def grouped(rows, k, num, den):
    """Expected component of each row, by comparing all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and den * common >= num * (len(sets[i]) + len(sets[j]) - common):
                a, b = comp[i], comp[j]
                comp = [b if c == a else c for c in comp]
    least = {}
    for (key, _), c in zip(rows, comp):
        least[c] = min(least.get(c, math.inf), math.inf if key is None else key)
    return [None if least[c] == math.inf else least[c] for c in comp]


def near_copies(seed, n, length, edits):
    r = np.random.default_rng(seed)
    base = [WORDS[i] for i in r.integers(0, len(WORDS), length)]
    out = []
    for _ in range(n):
        copy = list(base)
        for at in r.integers(0, length, edits):
            copy[at] = f"e{r.integers(0, 10**9)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("block", [8, 3])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(superminhash, "BLOCK", block)
    texts = near_copies(1, 30, 120, 3) + near_copies(2, 10, 60, 1) + ["A b", "a  B\n", "", None, " \t", "tie tie tie tie tie"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[0]), (700, "x " * 30_000), (99, "tie tie tie tie tie")]
    found = superminhash.near_duplicates(frame(spark, rows), words=3, num=85, den=100).collect()
    expected = Counter(
        (k, len(shingles(t, 3)), c) for (k, t), c in zip(rows, grouped(rows, 3, 85, 100))
    )
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == expected
    kept = superminhash.keep_one(frame(spark, rows), words=3, num=85, den=100)
    assert kept.columns == ["doc_id", "text", "score", "label"]
    groups = {}
    for (k, t), c in zip(rows, grouped(rows, 3, 85, 100)):
        groups.setdefault((c, None) if shingles(t, 3) else (k, t), set()).add(k)
    assert kept.count() == len(groups)


def test_rows_without_words_all_stay(spark):
    rows = [(None, None), (None, None), (1, ""), (1, ""), (2, " \n"), (3, "a b"), (3, "a b"), (4, "a b")]
    kept = superminhash.keep_one(frame(spark, rows)).collect()
    assert sorted(str((r["doc_id"], r["text"])) for r in kept) == sorted(str(r) for r in rows[:6])


def test_alike_texts_below_the_threshold_make_no_rows_of_pairs(spark, monkeypatch):
    """A group of texts that are alike, few of them linked: rows staged grow with the group, not its pairs."""
    made = {}
    real = superminhash.staged

    def counted(df, label):
        out = real(df, label)
        made[label] = max(made.get(label, 0), out.count())
        return out

    monkeypatch.setattr(superminhash, "staged", counted)
    n = 150
    texts = near_copies(3, n, 150, 14)
    found = superminhash.near_duplicates(frame(spark, list(enumerate(texts))), words=3, num=85, den=100)
    got = {r["doc_id"]: r["component_id"] for r in found.collect()}
    assert got == dict(enumerate(grouped(list(enumerate(texts)), 3, 85, 100)))
    assert made["pairs"] <= superminhash.PIVOTS * n
    assert made["block-links"] <= n * superminhash.BANDS


def test_empty_near_duplicates(spark):
    assert superminhash.near_duplicates(frame(spark, [])).count() == 0
    assert superminhash.keep_one(frame(spark, [])).count() == 0


def test_superminhash_estimates_overlap():
    r = np.random.default_rng(0)
    a = r.integers(0, 2**63, 2000, dtype=np.uint64)
    b = np.concatenate([a[:1500], r.integers(0, 2**63, 500, dtype=np.uint64)])
    values = superminhash.signatures(np.concatenate([a, b, a[:1]]), np.array([2000, 2000, 1]), 150)
    assert abs((values[0] == values[1]).mean() - 0.6) < 0.15
    assert len(set(values[2] >> np.uint64(32))) == 150  # one element fills every slot, one per step


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60) if i != 30] + [(5, 5)], "a bigint, b bigint")
    found = {r["node"]: r["label"] for r in components(links.repartition(7)).collect()}
    assert found == {i: 0 if i <= 30 else 31 for i in range(61)}


def test_secrets():
    key = "q7Zp0LxV9sT2bN4mK8wR1cY6"
    hexed = "0123456789abcdef" * 3
    text = f'é password = "hunter2hunter2" AKIA{"A1" * 8} {hexed} token: secret: abcdefghij authorization Basic {key} x'
    base = secrets.base_spans(text)
    assert [(k, text[a:b]) for a, b, k in base] == [
        ("assign", 'password = "hunter2hunter2'),
        ("access", "AKIA" + "A1" * 8),
        ("hex", hexed),
    ]
    assert [text[a:b] for a, b, _ in secrets.novel_spans(text, base)] == [key]
    # said before, far from a sensitive word, or made of words: not new
    assert secrets.novel_spans(f"{key} authorization Basic {key}", []) == []
    assert secrets.novel_spans("authorization " + "word " * 30 + key, []) == []
    assert secrets.novel_spans("token get_response_handler_version2_context", []) == []


def test_secret_scan_keeps_rows(spark):
    rows = [(1, None), (1, ""), (None, "api_key=12345678"), (2, "x" * 200_000 + " token=abcdefgh")]
    found = secrets.scan(frame(spark, rows))
    spans = sorted((r["doc_id"] or 0, [tuple(s) for s in r["spans"]]) for r in found.collect())
    assert spans == [(0, [(0, 16, "assign")]), (1, []), (1, []), (2, [(200_001, 200_015, "assign")])]
    clean = secrets.redact(frame(spark, rows))
    assert clean.columns == ["doc_id", "text", "score", "label"]
    assert sorted(str(r["text"])[-10:] for r in clean.collect()) == ["", "None", "[SECRET]", "x [SECRET]"]


def test_url_filter(spark):
    rules = spark.createDataFrame(
        [("Example.com", "/a/", "block"), ("com", "/", "allow"), ("x.example.com", "/a/", "allow"), ("net", None, "block"), ("org", "/ab", "block")],
        "host string, path string, verdict string",
    )
    urls = {
        1: ("https://EXAMPLE.com/a/b?q#f", "example.com", "/a/b", "example.com/a/", "block"),
        2: ("http://y.x.example.com/a/", "y.x.example.com", "/a/", "x.example.com/a/", "allow"),
        3: ("http://notexample.com", "notexample.com", "", None, "allow"),
        4: (None, "", "", None, "allow"),
        5: ("no scheme/a/", "", "", None, "allow"),
        6: ("ftp://h.org/abc" + "/x" * 5000, "h.org", "/abc" + "/x" * 5000, "org/ab", "block"),
        7: ("a://" + "l." * 3000 + "net?/x", "l." * 3000 + "net", "", None, "allow"),
    }
    rows = [(k, v[0], "clash") for k, v in urls.items()] + [(1, urls[1][0], "clash")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    found = urlfilter.judge(pages, rules).collect()
    assert len(found) == 8
    for r in found:
        assert tuple(r)[1:] == urls[r["page_id"]][1:]
    assert urlfilter.judge(pages.limit(0), rules).count() == 0
    assert urlfilter.judge(pages, rules.limit(0), otherwise="block").where("verdict = 'block'").count() == 8


def best_segments(weights):
    """Maximal segments by their definition: recursively the best one, then both sides."""
    if not len(weights) or max(weights) <= 0:
        return []
    spans = [(round(sum(weights[a:b]), 9), -(b - a), a, b) for a in range(len(weights)) for b in range(a + 1, len(weights) + 1)]
    total, _, a, b = max(spans)
    return best_segments(weights[:a]) + [(a, b, total)] + [(x + b, y + b, s) for x, y, s in best_segments(weights[b:])] if total > 0 else []


def test_segments():
    r = np.random.default_rng(3)
    for _ in range(60):
        w = np.round(r.normal(-0.2, 1, 14), 2)
        assert [(a, b, round(s, 6)) for a, b, s in toxicity.segments(w)] == [(a, b, round(s, 6)) for a, b, s in best_segments(list(w))]


def test_toxicity(spark):
    r = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(300):
        text = [WORDS[j] for j in r.integers(0, 300, 60)]
        if i % 3 == 0:
            text[20:23] = ["vile", "awful", "scum"]
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 3 == 0)))
    docs = frame(spark, rows + [(500, None), (501, ""), (None, "vile awful scum"), (0, rows[0][1])])
    marks = spark.createDataFrame([*labels[:200], (None, 1), (5, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, marks)
    found = toxicity.score(docs, model).collect()
    assert len(found) == 304 and all(0 <= x["score"] <= 1 for x in found)
    tested = [x for x in found if x["doc_id"] is not None and 200 <= x["doc_id"] < 300]
    assert sum(x["predicted"] == (x["doc_id"] % 3 == 0) for x in tested) >= 98
    passage = next(x for x in found if x["doc_id"] == 0)["passages"][0]
    assert "vile awful scum" in rows[0][1][passage["start"] : passage["end"]]
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(not x["predicted"] for x in found)
    nothing = toxicity.fit(docs, marks.limit(0))
    assert {x["score"] for x in toxicity.score(docs, nothing).collect()} == {0.0}


@pytest.mark.parametrize("factor, least", [(1.0, 1.0), (0.9, 0.9)])
def test_nearest(spark, factor, least):
    r = np.random.default_rng(7)
    x = np.round(r.normal(size=(600, 8)), 2).astype(np.float32)
    x[10] = x[11]
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    odd = [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [None] * 8), (904, [1.0]), (None, [1.0] * 8), (5, rows[5][1])]
    table = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>")
    found = vptree.nearest(table, F.col("vec_id") % 20 == 0, k=7, factor=factor, shard_rows=250, query_rows=10).collect()
    wide, hits = x.astype(np.float64), 0
    got = {}
    for row in sorted(found, key=lambda f: (f["query_id"], f["rank"])):
        got.setdefault(row["query_id"], []).append(row["vec_id"])
        assert abs(row["score"] - wide[row["query_id"]] @ wide[row["vec_id"]]) < 1e-9
    for q in range(0, 600, 20):
        score = (wide * wide[q]).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(600), -score)) if i != q][:7]
        hits += len(set(order) & set(got[q]))
        if factor == 1.0:
            assert got[q] == order
    assert hits >= least * 30 * 7
    assert vptree.nearest(table.limit(0), F.lit(True)).count() == 0


def exact_order(x, ids, q, k):
    """Ids of the k best of row q by (score, id), by brute force."""
    wide = x.astype(np.float64)
    score = (wide * wide[q]).sum(axis=1)
    return [int(ids[i]) for i in np.lexsort((ids, -score)) if i != q][:k]


def answers(found):
    got = {}
    for row in sorted(found, key=lambda f: (f["query_id"], f["rank"])):
        got.setdefault(row["query_id"], []).append(row["vec_id"])
    return got


def test_nearest_sends_queries_in_rounds(spark):
    """Query blocks are never repeated for each shard, neither through the driver nor by a shuffle."""
    r = np.random.default_rng(3)
    x = np.round(r.normal(size=(900, 8)), 1).astype(np.float32)
    table = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id bigint, embedding array<float>")
    found = vptree.nearest(table, F.col("vec_id") % 10 == 0, k=5, shard_rows=100, query_rows=20, round_bytes=2_000)
    assert "Join" not in found._jdf.queryExecution().toString()
    assert answers(found.collect()) == {q: exact_order(x, np.arange(900), q, 5) for q in range(0, 900, 10)}


@pytest.mark.parametrize("scale", [20, 1000])
def test_nearest_with_a_long_vector(spark, scale):
    r = np.random.default_rng(17)
    x = r.normal(size=(1500, 16)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[:300] *= r.uniform(0.1, 2, (300, 1)).astype(np.float32)
    x[77] *= scale
    table = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id bigint, embedding array<float>")
    got = answers(vptree.nearest(table, F.col("vec_id") % 50 == 0, k=10).collect())
    assert got == {q: exact_order(x, np.arange(1500), q, 10) for q in range(0, 1500, 50)}


def test_decontamination(spark):
    r = np.random.default_rng(9)
    def prose(n):
        return [f"v{i}" for i in r.integers(0, 10**6, n)]
    items = {i: prose(n) for i, n in enumerate((6, 20, 20, 45, 3))}
    changed = list(items[3])
    changed[0] = "other"
    rows = [
        (1, " ".join(prose(50) + items[1] + prose(30))),
        (2, " ".join(prose(40)).upper()),
        (3, (" ".join(items[0]) + "!").upper()),
        (4, " ".join(prose(10) + changed + prose(5))),
        (5, " ".join(items[1][:12] + prose(8))),
        (6, " ".join(prose(4) + items[4] + prose(4))),
        (7, None), (8, ""), (None, " ".join(items[2])), (1, "again"),
    ]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()] + [(9, None), (10, "")], "item_id bigint, text string")
    docs = frame(spark, rows)
    found = {(x["doc_id"], x["item_id"]): x for x in decontaminate.find_leaks(docs, bench).collect()}
    assert set(found) == {(1, 1), (3, 0), (4, 3), (6, 4), (None, 2)}
    assert found[1, 1]["start"] == 50 and found[1, 1]["similarity"] == 1.0
    assert abs(found[4, 3]["similarity"] - 40 / 42) < 1e-9
    kept = decontaminate.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted(x["doc_id"] for x in kept.collect()) == [1, 2, 5, 7, 8]
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0


def test_language(spark):
    r = np.random.default_rng(11)
    alphabets = {"aa": "abcde fghij", "bb": "klmno pqrst", "cc": "àéîõü abxyz"}
    rows = []
    for i in range(240):
        name = list(alphabets)[i % 3]
        rows.append((i, name, "".join(r.choice(list(alphabets[name]), 80))))
    docs = spark.createDataFrame([*rows, (900, None, "abc"), (901, "aa", None), (902, "aa", "123 !"), (903, None, "abcde" * 60_000)], "doc_id bigint, lang string, text string")
    model = language.fit(docs.where("doc_id < 150 or doc_id >= 900"))
    found = {x["doc_id"]: x for x in language.predict(docs, model).collect()}
    assert all(found[i]["lang_pred"] == name for i, name, _ in rows if i >= 150)
    assert found[901]["lang_pred"] == found[902]["lang_pred"] == "und" and found[903]["lang_pred"] == "aa"
    nothing = language.fit(docs.limit(0))
    assert {x["lang_pred"] for x in language.predict(docs, nothing).collect()} == {"und"}


TEXTS = [
    None, "", "a", "a <|endoftext|> b  c\n\n x", "日本語 “quoted” don't 12½  x \x1c y\u0301", "'S 's\r\n\t ", "x" * 40_000,
    "two  spaces   three\n \n", "<|endoftext|><|endoftext|>", "\u2028\u00a0 nb", "ÀÉ ñandú 1234567 http://x.y/z?a=b&c",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_bpe())


def test_bpe_is_the_librarys(spark, library):
    rows = [(i // 2, t) for i, t in enumerate(TEXTS)] + [(None, "null key")]
    encoded = bpe.encode(frame(spark, rows), byte_bpe(), decoded=True)
    expected = Counter()
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        expected[key, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), back] += 1
    found = encoded.select("doc_id", "n_tokens", F.sha2("ids", 256), "decoded").collect()
    assert Counter(map(tuple, found)) == expected
    again = bpe.decode(bpe.encode(frame(spark, rows), byte_bpe()), byte_bpe())
    assert Counter(x["decoded"] for x in again.collect()) == Counter(t or "" for _, t in rows)
    assert bpe.encode(frame(spark, []), byte_bpe()).count() == 0
    assert bpe.encode(frame(spark, [(1, "a b")]), byte_bpe()).select(bpe.unpacked(F.col("ids"))).first()[0] == [64, 275]


def test_edited_counts(spark, library):
    r = np.random.default_rng(13)
    alphabet = list("ab  \n\t'1.é") + ["<|endoftext|>", "'s", " the", "日"]
    counts = tokencounts.WordCounts(bpe.codec(open(byte_bpe(), encoding="utf-8").read()))
    for _ in range(60):
        text = "".join(r.choice(alphabet, r.integers(0, 900)))
        tree = tokencounts.CountTree(text, counts)
        for _ in range(4):
            a, b = sorted(r.integers(0, len(tree.text) + 1, 2).tolist())
            b = min(b, a + 20)
            tree.replace(a, b, "".join(r.choice(alphabet, r.integers(0, 6))))
            assert tree.n_tokens == len(library.encode(tree.text, add_special_tokens=False).ids)
    long = tokencounts.CountTree("word " * 20_000, counts)
    long.replace(50_000, 50_004, "other")
    assert long.encoded < 300
    rows = [(1, "mail me", [(0, 4, "call")]), (1, None, None), (None, "abc", [(1, 2, None)])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, edits array<struct<start:int,end:int,new:string>>")
    found = sorted((x["doc_id"] or 0, x["n_tokens"], x["n_edits"]) for x in tokencounts.count_edited(docs, byte_bpe()).collect())
    n = [len(library.encode(t).ids) for t in ("call me", "ac")]
    assert found == [(0, n[1], 1), (1, 0, 0), (1, n[0], 1)]


def test_kept_trees(spark, library, tmp_path):
    """Three rounds of edits on written trees: counts of full encoding, texts of plain slicing, little encoded."""
    r = np.random.default_rng(8)
    texts = {i: " ".join(r.choice(["mail", "don't", "12", "é,", "\n\n", "<|endoftext|>"], n)) for i, n in enumerate((0, 1, 70, 900, 9_000))}
    texts |= {5: None, 6: "x" * 30_000}
    rows = [*texts.items(), (3, texts[3]), (None, "no key")]
    docs = spark.createDataFrame([(*x, "clash") for x in rows], "doc_id bigint, text string, tokens string")
    path = str(tmp_path / "trees")
    tokencounts.build(docs, byte_bpe()).write.parquet(f"{path}0")
    now = {k: t or "" for k, t in rows}
    for turn in range(3):
        changes, whole = {}, dict(now)
        for k, t in now.items():
            if k in (1, None):
                continue
            places = sorted(r.integers(0, len(t) + 1, 6).tolist())
            changes[k] = [(a, min(b, a + 9), str(r.choice(["", "new word", " ", "'s", None]) or "")) for a, b in zip(places[::2], places[1::2])]
            for a, b, new in reversed(changes[k]):
                whole[k] = whole[k][:a] + new + whole[k][b:]
        wanted = spark.createDataFrame(list(changes.items()), "doc_id bigint, edits array<struct<start:int,end:int,new:string>>")
        trees = spark.read.parquet(f"{path}{turn}").join(wanted, "doc_id", "left")
        tokencounts.edit(trees, byte_bpe()).write.parquet(f"{path}{turn + 1}")
        found = spark.read.parquet(f"{path}{turn + 1}").collect()
        assert len(found) == len(rows)
        for x in found:
            k = x["doc_id"]
            assert x["text"] == whole[k] and x["n_tokens"] == len(library.encode(whole[k], add_special_tokens=False).ids)
            assert x["n_tokens_before"] == len(library.encode(now[k], add_special_tokens=False).ids)
            assert x["n_edits"] == len(changes.get(k, ())) and (x["n_edits"] or x["n_encoded"] == 0)
            assert k not in (3, 4) or x["n_encoded"] < 400
        now = whole
    first = spark.read.parquet(f"{path}0")
    by_rule = tokencounts.edit(first, byte_bpe(), edits=lambda t: [(0, 2, "")] if len(t) > 1 else [])
    cut = {k: (t or "")[2:] if len(t or "") > 1 else t or "" for k, t in rows}
    for x in by_rule.collect():
        t = cut[x["doc_id"]]
        assert x["text"] == t and x["n_tokens"] == len(library.encode(t, add_special_tokens=False).ids)
    bad = first.withColumn("edits", F.expr("array(named_struct('start', 0, 'end', 10000000, 'new', ''))"))
    with pytest.raises(Exception, match="outside the text"):
        tokencounts.edit(bad, byte_bpe()).count()
    empty = tokencounts.build(docs.limit(0), byte_bpe())
    assert tokencounts.edit(empty, byte_bpe(), edits=queries.redacted).count() == 0


PAGE = """<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body class="nav-open"><header>H</header>
<nav><a>menu</a></nav><div class="ad top">buy</div><article><h1>One &amp; two</h1><p>First <b>bold</b>ly  set<br>line
<p>Second<!-- c --> &eacute;<div class="comments"><p>reader says</p></div><form>f</form><aside>s</aside></article>
<footer>foot</footer></body></html>"""


def test_extract(spark):
    shared = "<div>shared words that stand on every single page of this host</div>"
    bare = [f"<div>{w} unique text number {i}</div>{shared}" for i, w in enumerate(("alpha", "beta"))]
    rows = [(1, "http://h/1", PAGE), (1, "http://h/1", PAGE), (2, None, None), (3, "", ""), (4, "http://h/4", bare[0]),
            (5, "http://h/5", bare[1]), (5, "http://h/5", bare[1]), (6, "http://other/", bare[0]), (7, "http://h/7", "plain < text")]
    pages = spark.createDataFrame([(*x, "clash") for x in rows], "page_id bigint, url string, html string, text string")
    found = Counter(tuple(x) for x in extract.main_text(pages).collect())
    first = "One & two First boldly set line Second é"
    everywhere = "shared words that stand on every single page of this host"
    expected = Counter(
        (k, u, t, len(t))
        for k, u, t in [
            (1, "http://h/1", first), (1, "http://h/1", first), (2, None, ""), (3, "", ""),
            (4, "http://h/4", "alpha unique text number 0"), (5, "http://h/5", "beta unique text number 1"),
            (5, "http://h/5", "beta unique text number 1"), (6, "http://other/", f"alpha unique text number 0 {everywhere}"),
            (7, "http://h/7", "plain < text"),
        ]
    )
    assert found == expected
    assert extract.main_text(pages.limit(0)).count() == 0


def test_extract_keeps_copied_articles(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", PAGE) for i in range(3)], "page_id bigint, url string, html string")
    assert {x["text"] for x in extract.main_text(pages).collect()} == {"One & two First boldly set line Second é"}
