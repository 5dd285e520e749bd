"""Toxicity scores and benchmark leaks of whole tables against plain versions."""

import math
import re
import string
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from maskline.llm import decontaminate, queries, toxicity

SF = "/root/testdata/sf0.001"


def table(name, columns, folder=SF):
    return duckdb.sql(f"SELECT {columns} FROM '{folder}/{name}.parquet' ORDER BY ALL").fetchall()


# Benchmark leaks

def words(text):
    kept = "".join(c.lower() if c.isascii() else c for c in text or "" if c not in string.punctuation)
    return re.split(r"[\x20\x09-\x0d]+", kept.strip("\x20\x09\x0a\x0b\x0c\x0d")) if kept.strip("\x20\x09\x0a\x0b\x0c\x0d") else []


def bag(split):
    return Counter(tuple(split[i : i + 5]) for i in range(len(split) - 4)) if len(split) >= 5 else Counter([tuple(split)])


def leaks(docs, items):
    """(key, item, similarity, start) of the best window; windows that share no shingle are passed over."""
    out = set()
    for item, text in items:
        own = words(text)
        if not own:
            continue
        target = bag(own)
        for key, doc in docs:
            split = words(doc)
            if not split or (len(own) >= 5 and not target.keys() & bag(split).keys()):
                continue
            best = (0.0, 0)
            for a in range(max(1, len(split) - len(own) + 1)):
                window = bag(split[a : a + len(own)])
                common = sum((window & target).values())
                best = max(best, (common / sum((window | target).values()), -a))
            if best[0] >= 0.8:
                out.add((key, item, round(best[0], 9), -best[1]))
    return out


def test_leaks_query(spark):
    docs, items = table("documents", "doc_id, text"), table("benchmark", "item_id, text")
    expected = leaks(docs, items)
    found = {(r.doc_id, r.item_id, round(r.similarity, 9), r.start) for r in queries.op6_decontaminate(spark, SF).collect()}
    assert expected and found == expected


def test_leaks_of_very_long_texts(spark):
    r = np.random.default_rng(3)
    split = [f"x{i}" for i in r.integers(0, 5_000, 200_000)]
    item = [f"y{i}" for i in range(40)]
    text = " ".join(split[:150_000] + item + split[150_000:])
    schema = "doc_id bigint, text string, item_id string, similarity double"
    docs = spark.createDataFrame([(1, text, "clash", 2.0), (2, " ".join(split), "clash", 2.0)], schema)
    items = spark.createDataFrame([(7, " ".join(item), 1)], "item_id int, text string, doc_id int")
    assert [tuple(x) for x in decontaminate.find_leaks(docs, items).collect()] == [(1, 7, 1.0, 150_000)]


# Toxicity

def best_segments(weights):
    """Scores of the maximal segments: the best stretch, then the best ones left and right of it."""
    out, todo = [], [(0, len(weights))]
    total = np.concatenate([[0.0], np.cumsum(weights)])
    while todo:
        a, b = todo.pop()
        if a >= b:
            continue
        low = np.minimum.accumulate(total[a:b])
        end = int(np.argmax(total[a + 1 : b + 1] - low))
        if total[a + 1 + end] - low[end] <= 0:
            continue
        start = a + int(np.flatnonzero(total[a : a + end + 1] == low[end])[-1])
        out.append(float(total[a + 1 + end] - low[end]))
        todo += [(a, start), (a + 1 + end, b)]
    return out


def root(f, low, high):
    """Where a falling function meets zero."""
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if f(middle) > 0 else (low, middle)
    return (low + high) / 2


def scores(docs, labels):
    """Score of every (key, text), learnt from the labels of the keys that are not held out."""
    tokens = [[zlib.crc32(t.encode()) % 2**18 for t in re.findall(r"[^\W_]+", (text or "").lower())] for _, text in docs]
    label = defaultdict(int)
    for key, toxic in labels:
        if key is not None and toxic in (0, 1) and zlib.crc32(str(key).encode()) % 5 != 0:
            label[key] = max(label[key], toxic)
    learn = [(label[key], t) for (key, _), t in zip(docs, tokens) if key in label]
    holding, seen = (Counter(), Counter()), Counter()
    for mark, t in learn:
        holding[mark].update(set(t))
        if mark == 0:
            seen.update(t)
    # log-odds with a Dirichlet prior in proportion to the background
    both = holding[0] + holding[1]
    n, n_buckets = sum(both.values()), 2**18
    prior = {b: 0.5 + toxicity.PRIOR * both[b] / n for b in both}
    mass = [sum(h.values()) + 0.5 * n_buckets + toxicity.PRIOR for h in holding]

    def weight(b):
        own = [h[b] + prior.get(b, 0.5) for h in holding]
        delta = math.log(own[1] / (mass[1] - own[1])) - math.log(own[0] / (mass[0] - own[0]))
        size = max(abs(delta) - toxicity.NOISE * math.sqrt(1 / own[0] + 1 / own[1]), 0)
        return math.copysign(size, delta) - toxicity.DRIFT

    every = {b: weight(b) for b in {b for t in tokens for b in t}}
    clean = sum(seen.values())
    rate = root(lambda x: 1 - math.fsum(c / clean * math.exp(x * every[b]) for b, c in seen.items()), 1e-6, 64.0)
    single = {b: float(np.float32(w)) for b, w in every.items()}
    found = {id(t): best_segments(np.array([single[b] for b in t])) for t in tokens}
    tops = [(len(t), max(found[id(t)], default=0.0)) for mark, t in learn if mark == 0 and t]
    size = len(tops) / math.fsum(k * math.exp(-rate * top) for k, top in tops)

    def evidence(t):
        level = math.log(size * max(len(t), 1))
        bits = sorted((rate * s - level for s in found[id(t)]), reverse=True)
        return bits[0] + sum(b for b in bits[1:] if b > 0) if bits else -level

    low, high, cells = toxicity.GRID
    middle = low + (np.arange(cells) + 0.5) * (high - low) / cells
    histogram = np.zeros((2, cells))
    for mark, t in learn:
        histogram[mark, min(cells - 1, max(0, int((evidence(t) - low) / (high - low) * cells)))] += 1
    n, positive = histogram.sum(axis=0), histogram[1]
    share = lambda slope, offset: 1 / (1 + np.exp(-np.clip(slope * middle + offset, -500, 500)))
    at = lambda slope: root(lambda o: (positive - n * share(slope, o)).sum(), -200.0, 200.0)
    slope = root(lambda s: (middle * (positive - n * share(s, at(s)))).sum() - 0.1 * s, -5.0, 20.0)
    offset = at(slope)
    return [1 / (1 + math.exp(-max(-500, min(500, slope * evidence(t) + offset)))) for t in tokens]


@pytest.mark.parametrize("folder", [SF, "/root/testdata/sf0.01"])
def test_toxicity_query(spark, folder):
    docs = table("documents", "doc_id, text", folder)
    expected = scores(docs, table("labels", "doc_id, toxic", folder))
    found = {r.doc_id: r for r in queries.op4_toxicity(spark, folder).collect()}
    assert len(found) == len(docs)
    for (key, _), score in zip(docs, expected):
        assert found[key].score == pytest.approx(score, abs=1e-4)
        assert found[key].predicted == (found[key].score >= 0.5)
        assert found[key].held_out == (zlib.crc32(str(key).encode()) % 5 == 0)


def test_toxicity_of_no_rows_and_very_long_texts(spark):
    ids = spark.range(4_000).withColumnRenamed("id", "doc_id")
    labels = ids.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")
    docs = ids.selectExpr("doc_id", "if(doc_id % 2 = 1, 'vile words here', 'kind words there') as text", "9d as score")
    model = toxicity.fit(docs, labels)
    long = spark.createDataFrame([(1, "kind there " * 150_000), (2, "kind there " * 150_000 + "vile here " * 200)], "doc_id bigint, text string")
    found = {r.doc_id: r for r in toxicity.score(long, model).collect()}
    assert found[1].predicted == 0 and not found[1].passages
    assert found[2].score > found[1].score and found[2].passages[0].start == 11 * 150_000
    assert toxicity.score(long.limit(0), model).count() == 0
    nothing = toxicity.fit(docs.limit(0), labels)
    assert {r.score for r in toxicity.score(docs, nothing).collect()} == {0.0}
