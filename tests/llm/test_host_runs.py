"""Runs that a host's pages share: article blocks are compared too, and near copies stay."""

import math
import random
from collections import Counter

import pytest

from maskline.llm import extract

NOTICE = "Read all of our reports and letters every single morning of the week"


def article(*paragraphs):
    return "<nav>menu</nav><article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article>"


def own(i, n=20):
    return " ".join(f"w{i}x{j}" for j in range(n))


def texts_of(spark, rows):
    pages = spark.createDataFrame(rows, "page_id int, url string, html string").repartition(5)
    return {r["page_id"]: r["text"] for r in extract.main_text(pages).collect()}


def test_a_notice_in_the_articles_of_a_host_is_left_out(spark):
    rows = [(i, f"http://h/{i}", article(own(i), NOTICE, own(100 + i))) for i in range(8)]
    rows += [(50, "http://h/50", article(own(50), f"He said: {NOTICE}")), (51, "http://h/51", article(NOTICE))]
    rows += [(60 + i, f"http://few/{i}", article(own(60 + i), NOTICE)) for i in range(4)]
    found = texts_of(spark, rows)
    assert all(found[i] == f"{own(i)} {own(100 + i)}" for i in range(8))
    # a block goes whole or not at all, no page loses all its text, and four pages of a host say nothing
    assert found[50] == f"{own(50)} He said: {NOTICE}" and found[51] == NOTICE
    assert all(found[60 + i] == f"{own(60 + i)} {NOTICE}" for i in range(4))


def test_near_copies_of_an_article_keep_their_text(spark):
    base = [own(i) for i in range(200, 208)]
    near = [[*base[: i % 8], own(300 + i), *base[i % 8 + 1 :], NOTICE] for i in range(12)]
    rows = [(i, f"http://h/{i}", article(*near[i])) for i in range(12)]
    rows += [(20 + i, f"http://h/{20 + i}", article(own(20 + i), own(40 + i), NOTICE)) for i in range(6)]
    rows += [(30, "http://h/30", article(own(30), own(31), base[0]))]
    rows += [(100 + i, f"http://only/{i}", article(*near[i])) for i in range(12)]
    found = texts_of(spark, rows)
    for i in range(12):
        assert found[i] == " ".join(near[i][:-1])  # the notice is on the other pages too
        assert found[100 + i] == " ".join(near[i])  # where all pages are copies nothing tells it apart
    assert all(found[20 + i] == f"{own(20 + i)} {own(40 + i)}" for i in range(6))
    assert found[30] == f"{own(30)} {own(31)} {base[0]}"


def plain(rows):
    """The same rules over token tuples, host by host."""
    kept = {}
    for k, u, h in rows:
        host = u.split("://")[1].split("/")[0] if u else ""
        blocks = extract.blocks_of(h)
        inside = [t for t, x in blocks if x]
        kept[k] = (host, bool(inside), tuple(inside or [t for t, _ in blocks]))

    def runs(blocks):
        t = " ".join(blocks).split()
        return [tuple(t[i : i + 8]) for i in range(len(t) - 7)]

    def marks(blocks, shared):
        out = [False] * len(" ".join(blocks).split())
        for i, r in enumerate(runs(blocks)):
            if r in shared:
                out[i : i + 8] = [True] * 8
        return out

    def over(pages, least, share):
        n = Counter(r for b in pages for r in set(runs(b)))
        return {r for r, x in n.items() if x >= max(least, math.ceil(len(pages) * share))}

    shared = {}
    for scope in {(h, a) for h, a, _ in kept.values()}:
        pages = {b for h, a, b in kept.values() if (h, a) == scope}
        if scope[1]:
            wide = over(pages, 2, 0.2)
            single = {b for b in pages if 2 * sum(marks(b, wide)) <= len(marks(b, wide))}
            shared[scope] = over(pages, 5, 0.5) & over(single, 5, 0.5)
        else:
            shared[scope] = over(pages, 2, 0.2)
    out = {}
    for k, (h, a, blocks) in kept.items():
        gone, left = marks(blocks, shared[h, a]), []
        for b in blocks:
            here, gone = gone[: len(b.split())], gone[len(b.split()) :]
            t = b.split() if a and not all(here) else [x for x, g in zip(b.split(), here) if not g]
            left += [" ".join(t)] if t else []
        out[k] = " ".join(left or blocks)
    return out


@pytest.mark.parametrize("setting", ["", "shuffled", "listed", "flushed"])
def test_like_a_plain_comparison(spark, monkeypatch, setting):
    if setting == "shuffled":
        monkeypatch.setattr(extract, "broadcast_if_small", lambda df, *_: (df, False))
    if setting == "listed":
        monkeypatch.setattr(extract, "KNOWN_COPIES", -1)
    if setting == "flushed":
        monkeypatch.setattr(extract, "HELD", 50)
    rng, rows = random.Random(7), []
    for host in range(40):
        notices = [own(f"n{host}n{k}", rng.choice([5, 8, 9, 14])) for k in range(2)]
        base = [own(f"b{host}b{k}", rng.choice([6, 12, 20])) for k in range(5)]
        common, near, bare = rng.choice([0.3, 0.6, 0.9]), rng.choice([0, 0, 0.4, 0.8]), rng.choice([0, 0.3, 1])
        mine = []
        for i in range(rng.choice([1, 2, 3, 4, 5, 6, 9, 15, 25])):
            blocks = [x for x in base if rng.random() < 0.9] if rng.random() < near else []
            blocks += [own(f"h{host}p{i}k{k}", rng.randint(1, 25)) for k in range(rng.randint(0, 3))]
            for x in notices:
                if rng.random() < common:
                    blocks.insert(rng.randint(0, len(blocks)), x if rng.random() < 0.8 else f"so {x}")
            html = "".join(f"<p>{b}</p>" for b in blocks)
            mine.append(html if rng.random() < bare else f"<article>{html}</article>")
        mine += rng.choices(mine, k=rng.choice([0, 0, 3, 12]))
        rows += [(len(rows) + i, f"http://host{host}/{i}" if host else None, h) for i, h in enumerate(mine)]
    expected = plain(rows)
    assert sum(expected[k] != " ".join(t for t, _ in extract.blocks_of(h)) for k, _, h in rows) > 50
    assert texts_of(spark, rows) == expected


def test_runs_hash_alike_only_where_tokens_are(monkeypatch):
    rng = random.Random(11)
    texts = [" ".join(rng.choices(["a", "b", "ab", "ż", "b a"[:1], "\U0001f600" * 3, "x" * 40], k=k)) for k in (0, 7, 8, 9, 400)]
    whole = [extract._runs([t]) for t in texts]
    monkeypatch.setattr(extract, "PIECE", 20)
    extract._usual_powers.cache_clear()
    of: dict = {}
    for text, found in zip(texts, whole):
        t = text.split()
        assert len(found) == max(0, len(t) - 7) and (extract._runs([text]) == found).all()
        for i, h in enumerate(found.tolist()):
            assert of.setdefault(tuple(t[i : i + 8]), h) == h
    assert len(set(of.values())) == len(of) and extract.NEAR_COPY not in of.values()
    extract._usual_powers.cache_clear()
