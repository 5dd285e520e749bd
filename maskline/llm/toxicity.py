"""Toxicity by maximum-scoring segments of token log-odds (operator 4).

* Token weights: log-odds between labelled classes of the number of texts that hold the
  token, with an informative Dirichlet prior (Monroe et al. 2008), taken back by two standard errors towards zero, less a
  small cost per token, so that a random text drifts downwards.
* Passages: every maximal segment of the weight sequence (Ruzzo and Tompa 1999), found
  in one pass over runs of equal sign.
* Calibration: in clean texts the best segment of n tokens follows an extreme-value
  law, P(S >= x) = 1 - exp(-K n exp(-lambda x)) (Karlin and Altschul 1990). lambda
  solves sum p exp(lambda s) = 1 over the clean classes' tokens, K is its
  maximum-likelihood value over all clean training texts. Passages above the noise
  add up, and a logistic curve over that evidence gives the score.

The labelled rows used for fitting are bounded by SAMPLE_ROWS (a documented bound; the
rows with the least hash of their key are taken), so they are broadcast to the texts.
The model has BUCKETS weights, whatever the vocabulary. Every text is scored whole.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskline.llm.common import keep_rows, map_rows, rows_of, ship, staged

SAMPLE_ROWS = 100_000
BUCKETS = 1 << 18
PRIOR = 2_000.0  # tokens' worth of background prior in all, spread as the background is
FLOOR = 0.5  # prior counts every token has beside
DRIFT = 0.2  # cost of a token
NOISE = 2.0  # standard errors taken back
SIGNIFICANT = 0.01  # largest expected number of chance passages a reported one may have
GRID = (-30.0, 120.0, 600)  # range and cells of the evidence histogram

_TOKEN = re.compile(r"[^\W_]+")


class _Buckets(dict):
    LIMIT = 1_000_000

    def __missing__(self, token: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[token] = zlib.crc32(token.encode("utf-8", "surrogatepass")) % BUCKETS
        return value


def _tokens(text: str | None, table: _Buckets) -> np.ndarray:
    found = _TOKEN.findall(text.lower()) if text else []
    return np.fromiter(map(table.__getitem__, found), np.int64, len(found))


@dataclass(frozen=True)
class Model:
    """Weights by token bucket, the extreme-value law of clean texts, and the logistic curve."""

    weights: np.ndarray
    rate: float  # lambda
    size: float  # K
    slope: float
    offset: float
    base: float  # share of label 1, the score where nothing could be learnt


def segments(weights: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), left to right; scores are above 0."""
    if not len(weights) or weights.max() <= 0:
        return []
    up = weights > 0
    starts = np.flatnonzero(up & ~np.concatenate([[False], up[:-1]]))
    ends = np.flatnonzero(up & ~np.concatenate([up[1:], [False]])) + 1
    total = np.concatenate([[0.0], np.cumsum(weights)])
    found: list[tuple[int, int, float, float, int]] = []  # start, end, left sum, right sum, next to the left with less
    for a, b in zip(starts.tolist(), ends.tolist()):
        left, right = float(total[a]), float(total[b])
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                found.append((a, b, left, right, j))
                break
            a, left = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, right - left) for a, b, left, right, _ in found]


def evidence(scores: list[float], n: int, rate: float, size: float) -> float:
    """Nats above chance of a text's best passage, and of the further ones above chance."""
    level = float(np.log(max(size * max(n, 1), 1e-300)))
    bits = sorted((rate * s - level for s in scores), reverse=True)
    return bits[0] + sum(b for b in bits[1:] if b > 0) if bits else -level


def _rate(weights: np.ndarray, share: np.ndarray) -> float:
    """The positive root of sum share * exp(rate * weight) = 1; 1 where there is none."""
    if weights.max(initial=0) <= 0 or (share * weights).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    grown = lambda x: float((share * np.exp(np.minimum(x * weights, 700))).sum()) - 1
    while grown(high) < 0 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if grown(middle) > 0 else (middle, high)
    return high


def log_odds(counts: np.ndarray) -> np.ndarray:
    """Weights from counts[label, bucket]."""
    both = counts.sum(axis=0)
    prior = FLOOR + PRIOR * both / max(both.sum(), 1)
    with_prior = counts + prior
    rest = with_prior.sum(axis=1, keepdims=True) - with_prior
    odds = np.log(with_prior / rest)
    delta = odds[1] - odds[0]
    error = np.sqrt((1 / with_prior).sum(axis=0))
    return np.sign(delta) * np.maximum(np.abs(delta) - NOISE * error, 0) - DRIFT


def _logistic(cells: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(label 1) over the evidence, from a histogram; lightly penalized."""
    x, slope, offset = cells, 0.1, 0.0
    positive, n = counts[1], counts.sum(axis=0)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -500, 500)))
        w = n * p * (1 - p) + 1e-9
        gradient = np.array([(x * (positive - n * p)).sum() - 0.1 * slope, (positive - n * p).sum()])
        hessian = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        change = np.linalg.solve(hessian, gradient)
        limit = max(1.0, float(np.abs(change).max()) / 2.0)
        slope, offset = slope + change[0] / limit, offset + change[1] / limit
        if np.abs(change).max() < 1e-8:
            break
    return float(slope), float(offset)


def _cell(value: float) -> int:
    low, high, n = GRID
    return int(min(n - 1, max(0, (value - low) / (high - low) * n)))


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Learn from `labels` (key, label 0/1) and the texts they name.

    Null keys and null labels are left out; of contradicting labels the higher counts.
    Two passes over the labelled texts; the passages' scores are staged. What reaches the driver is bounded by BUCKETS
    and GRID.
    """
    spark = docs.sparkSession
    ship(spark)
    chosen = (
        labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(key).alias("key"))
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("key"), "key")
        .limit(SAMPLE_ROWS)
    )
    sample = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key")
    sample = sample.select("label", "text")

    def count(batches):
        table, seen, holding = _Buckets(), np.zeros((2, BUCKETS), np.int64), np.zeros((2, BUCKETS), np.int64)
        for marks, texts in rows_of(batches):
            for mark, t in zip(marks, texts):
                own, times = np.unique(_tokens(t, table), return_counts=True)
                seen[mark][own] += times
                holding[mark][own] += 1
        for mark in (0, 1):
            at = np.flatnonzero(seen[mark])
            for i in range(0, len(at), 50_000):
                part = at[i : i + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(part), mark, np.int32)),
                        pa.array(part.astype(np.int32)),
                        pa.array(seen[mark][part]),
                        pa.array(holding[mark][part]),
                    ],
                    names=["label", "bucket", "n", "texts"],
                )

    counted = (
        sample.mapInArrow(count, "label int, bucket int, n bigint, texts bigint")
        .groupBy("label", "bucket")
        .agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))
        .toArrow()
    )
    counts, holding = np.zeros((2, BUCKETS)), np.zeros((2, BUCKETS))
    at = counted["label"].to_numpy(), counted["bucket"].to_numpy()
    counts[at], holding[at] = counted["n"].to_numpy(), counted["texts"].to_numpy()
    weights = log_odds(holding)
    clean = counts[0] / max(counts[0].sum(), 1)
    rate = _rate(weights, clean)
    shared = spark.sparkContext.broadcast(weights.astype(np.float32))

    def best(marks, texts):
        table, tops, sizes, rest = _Buckets(), [], [], []
        for t in texts:
            found = _tokens(t, table)
            scores = [s for *_, s in segments(shared.value[found].astype(np.float64))]
            sizes.append(len(found))
            rest.append(scores)
            tops.append(max(scores, default=0.0))
        return marks, sizes, tops, rest

    passages = staged(map_rows(sample, best, "label int, n bigint, top double, scores array<double>"), "passages")
    law = (
        passages.where("label = 0 and n > 0")
        .agg(F.count(F.lit(1)).alias("texts"), F.sum(F.col("n") * F.exp(-F.lit(rate) * F.col("top"))).alias("mass"))
        .first()
    )
    size = law["texts"] / law["mass"] if law["texts"] and law["mass"] else 1.0

    def cells(marks, sizes, rest):
        return marks, [_cell(evidence(s, n, rate, size)) for s, n in zip(rest, sizes)]

    histogram = np.zeros((2, GRID[2]))
    placed = map_rows(
        passages.select("label", "n", "scores"),
        cells,
        "label int, cell int",
        "scores",
    )
    for row in placed.groupBy("label", "cell").count().collect():
        histogram[row["label"], row["cell"]] = row["count"]
    per_label = histogram.sum(axis=1)
    base = float(per_label[1] / per_label.sum()) if per_label.sum() else 0.0
    middle = GRID[0] + (np.arange(GRID[2]) + 0.5) * (GRID[1] - GRID[0]) / GRID[2]
    slope, offset = _logistic(middle, histogram) if per_label.min() > 0 else (0.0, 0.0)
    return Model(weights.astype(np.float32), rate, float(size), slope, offset, base)


def _passages(text: str | None, model: Model, table: _Buckets) -> tuple[int, list[tuple[int, int, float]]]:
    """Number of tokens, and all maximal segments."""
    found = _tokens(text, table)
    return len(found), segments(model.weights[found].astype(np.float64))


def _score(passages: tuple[int, list[tuple[int, int, float]]], model: Model) -> float:
    n, own = passages
    if model.slope == 0.0:
        return model.base
    x = model.slope * evidence([s for *_, s in own], n, model.rate, model.size) + model.offset
    return float(1 / (1 + np.exp(-np.clip(x, -500, 500))))


def score(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, score (0 to 1), predicted (0/1) and passages of every row.

    A passage is start and end (code points, end exclusive), score (nats) and expect, the
    number of passages as good that chance puts into a clean text of that length; those of
    SIGNIFICANT or less are listed, left to right. Null and empty texts have no evidence.
    Where the labels did not hold both classes, every score is the share of label 1.
    Rows are kept one to one, repeated and null keys too; other columns are not carried.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_type = rows.schema["key"].dataType.simpleString()
    table = _Buckets()

    def run(keys, texts):
        m, scores, listed = shared.value, [], []
        for t in texts:
            n, own = _passages(t, m, table)
            scores.append(_score((n, own), m))
            good = [(a, b, s, m.size * n * float(np.exp(-m.rate * s))) for a, b, s in own]
            good = [g for g in good if g[3] <= SIGNIFICANT]
            if good:
                at = _places(t)
                good = [{"start": at[a][0], "end": at[b - 1][1], "score": s, "expect": e} for a, b, s, e in good]
            listed.append(good)
        return keys, scores, [int(s >= 0.5) for s in scores], listed

    passage = "array<struct<start: int, end: int, score: double, expect: double>>"
    out = map_rows(rows, run, f"key {key_type}, score double, predicted int, passages {passage}")
    return out.withColumnRenamed("key", key)


def _places(text: str) -> list[tuple[int, int]]:
    """Start and end in the text of the tokens of its lower-cased form, which may be longer."""
    low = text.lower()
    spans = [x.span() for x in _TOKEN.finditer(low)]
    if len(low) == len(text):
        return spans
    origin = [i for i, c in enumerate(text) for _ in c.lower()]
    if len(origin) != len(low):  # a letter that changes with its neighbours
        return spans
    return [(origin[a], origin[b - 1] + 1) for a, b in spans]


def drop_toxic(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The rows, with all columns, whose text scores below one half."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    table = _Buckets()

    def decide(texts):
        return [_score(_passages(t, shared.value, table), shared.value) < 0.5 for t in texts]

    return keep_rows(docs, decide, text)


def held_out(key: Column, modulus: int, remainder: int) -> Column:
    """Whether a row is kept for testing: crc32 of the key's text; null keys are not."""
    return F.coalesce(F.pmod(F.crc32(F.encode(key.cast("string"), "UTF-8")), F.lit(modulus)) == remainder, F.lit(False))
