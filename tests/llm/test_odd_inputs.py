"""Odd markup, large groups of equal vectors, short texts, letters that grow."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskline.llm import bpe, decontaminate, extract, queries, tokencounts, toxicity, vptree


def main_of(body):
    return " ".join(t for t, inside in extract.blocks_of(f"<body><article>{body}</article></body>") if inside)


@pytest.mark.parametrize(
    "body",
    [
        '<p style="overflow:hidden">kept text</p>', '<p title="a hidden gem">kept text</p>', '<p><a href="/p?id=login">kept text</a></p>',
        '<div class="side-by-side">kept text</div>', '<p data-id="ad">kept text</p>', '<p>kept <svg width="1"/>text</p>',
        '<p>kept <iframe src="x"/>text</p>', "<p>kept <iframe src=x>text</p>", "<p>kept <noscript>text</p>", "<p>kept <template>text</p>",
        '<p data-x="class=ad" class="lead">kept text</p>', "<p class='no-nonsense'>kept text</p>", '<p hidden="until-found">kept text</p>',
        '<p>kept <svg><title>x</title><text>no</text></svg>text</p>', '<div id="article-header-1">kept text</div>',
    ],
)
def test_attributes_do_not_drop_the_article(body):
    assert main_of(body) == "kept text"


@pytest.mark.parametrize(
    "name",
    ["reader-comments", "in-article-ad", "site-notice", "comments", "ad", "ads top", "cookie-bar", "userComments", "sidebar-left", "x newsletter"],
)
def test_named_parts_are_left_out(name):
    assert main_of(f'<p>kept</p><div class="{name}"><p>gone <b>too</b></p></div><p>text</p>') == "kept text"
    assert main_of(f"<p>kept</p><div id='{name.split()[0]}'>gone</div>" * 1 + "<p>text</p>") in ("kept text", "kept gone text")
    assert main_of("<p hidden>gone</p><p HIDDEN=''>gone</p><p role='search'>gone</p><p>kept text</p>") == "kept text"


def test_very_long_page():
    assert main_of("<p>word </p>" * 50_000).split() == ["word"] * 50_000


def test_copies_of_bare_pages_keep_their_text(spark):
    text = "a page without an article element that is copied once word for word on its host"
    other = [f"<div>{' '.join(f'w{i}x{j}' for j in range(30))}</div>" for i in range(8)]
    phrase = "<div>one phrase of eight words that two of many pages quote by chance</div>"
    rows = [(1, "http://h/1", f"<div>{text}</div>"), (2, "http://h/2", f"<div>{text}</div>")]
    rows += [(10 + i, f"http://h/{10 + i}", o + (phrase if i < 2 else "")) for i, o in enumerate(other * 2)]
    rows += [(90, "http://k/1", "<div>all of this page is on the other one</div>"), (91, "http://k/2", "<div>all of this page is on the other one</div><p>more</p>")]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    found = {r["page_id"]: r["text"] for r in extract.main_text(pages).collect()}
    assert found[1] == found[2] == text
    assert found[90] == "all of this page is on the other one" and found[91] == "more"
    assert found[10].endswith("by chance") and found[11].endswith("by chance") and found[20] == found[12]


@pytest.mark.parametrize("groups, copies", [(30, 40), (4, 200), (2, 600)])
def test_nearest_keeps_the_smallest_ids_of_large_groups(spark, groups, copies):
    rng = np.random.default_rng(groups)
    base = rng.normal(size=(groups + 60, 6)).round(1)
    vectors = np.concatenate([base, np.repeat(base[:groups], copies, axis=0)])
    ids = rng.permutation(len(vectors))
    rows = [(int(i), v.tolist()) for i, v in zip(ids, vectors)]
    rows += [(5_000 + i, [float(i), 1.0]) for i in range(8)]  # another length
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found: dict = {}
    for r in vptree.nearest(table, F.col("vec_id") % 20 == 0, k=20, shard_rows=300, query_rows=16).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    held = {i: np.array(v) for i, v in rows if any(v)}
    assert set(found) == {i for i in held if i % 20 == 0}
    for q, got in found.items():
        same = [i for i in held if len(held[i]) == len(held[q]) and i != q]
        score = {i: float((held[q] * held[i]).sum()) for i in same}
        assert got == sorted(same, key=lambda i: (-score[i], i))[:20]


def test_texts_shorter_than_an_item(spark):
    item = [f"w{i}" for i in range(60)]
    docs = [(1, " ".join(item[:-2])), (2, " ".join(item[:40])), (3, " ".join(item[1:-1])), (4, "w1 w2 w3"), (5, None),
            (6, "z " * 30_000 + " ".join(item) + " y" * 30_000)]
    table = spark.createDataFrame(docs, "doc_id int, text string")
    items = spark.createDataFrame([(7, " ".join(item)), (8, None), (9, "")], "item_id int, text string")
    found = {(r["doc_id"], r["item_id"]): (round(r["similarity"], 6), r["start"]) for r in decontaminate.find_leaks(table, items).collect()}
    assert found == {(1, 7): (round(54 / 56, 6), 0), (3, 7): (round(54 / 56, 6), 0), (6, 7): (1.0, 30_000)}


def test_places_are_those_of_the_text_itself():
    text = "İİ bad words"
    spans = toxicity._places(text)
    assert [text[a:b] for a, b in spans][-2:] == ["bad", "words"]


def test_redactions_count_as_the_redacted_texts_do(spark):
    texts = ["mail a.b@c.de, +48 600700800", "x" * 70 + "@long.example.org 12345", None, "", "a1234567 1234567@x.pl.", "1 22 333 " * 9_000 + "z@y.x " * 3_000]
    rows = [(i, t, "extra") for i, t in enumerate(texts)] + [(None, texts[0], "extra"), (0, texts[0], "extra")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, edits string")
    library = bpe.codec(open(queries.byte_bpe(), encoding="utf-8").read())
    count = lambda t: sum(len(library.ids(w)) for w in library.words(t))
    found = tokencounts.count_edited(queries.redactions(docs), queries.byte_bpe()).collect()
    expected = [(i, count(t or ""), count(queries.REDACTED.sub("[REDACTED]", t or ""))) for i, t, _ in rows]
    assert sorted(((r["doc_id"], r["n_tokens_before"], r["n_tokens"]) for r in found), key=str) == sorted(expected, key=str)
    assert queries.REDACTED.sub("#", texts[1]) == "# 12345" and queries.REDACTED.sub("#", texts[4]) == "a# #"
    assert tokencounts.count_edited(queries.redactions(docs.limit(0)), queries.byte_bpe()).count() == 0
