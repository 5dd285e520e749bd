"""Choose toxicity's PRIOR, NOISE and DRIFT by cross-validation (run by hand, not a test).

    python tests/llm/choose_toxicity.py /root/testdata/sf0.1 [another directory ...]

Only labelled rows outside the held-out remainder are read. Texts fall into five folds by
their first words, so that copies share a fold. Prints the settings by mean log loss.
"""

from __future__ import annotations

import itertools
import multiprocessing
import sys
import zlib

import duckdb
import numpy as np

from maskline.llm import toxicity as T

FOLDS = 5
PRIORS = (500.0, 2_000.0, 8_000.0)
NOISES = (1.0, 2.0, 3.0)
DRIFTS = (0.1, 0.2, 0.4)

tables: list[tuple[list[np.ndarray], list[int], list[int]]] = []


def rows(folder: str) -> list[tuple[int, str]]:
    found = duckdb.sql(
        f"SELECT d.doc_id, l.toxic, d.text FROM '{folder}/labels.parquet' l JOIN '{folder}/documents.parquet' d "
        "USING (doc_id) WHERE l.toxic IS NOT NULL AND d.text IS NOT NULL ORDER BY d.doc_id"
    ).fetchall()
    return [(label, text) for key, label, text in found if zlib.crc32(str(key).encode()) % 5 != 0]


def evidence(tokens: list[np.ndarray], weights: np.ndarray, rate: float, size: float) -> list[int]:
    scores = ([s for *_, s in T.segments(weights[t])] for t in tokens)
    return [T._cell(T.evidence(s, len(t), rate, size)) for s, t in zip(scores, tokens)]


def losses(tokens, labels, folds, setting) -> tuple[float, int]:
    """Summed log loss and errors over the folds, each judged by a model of the others."""
    T.PRIOR, T.NOISE, T.DRIFT = setting
    loss, errors = 0.0, 0
    middle = T.GRID[0] + (np.arange(T.GRID[2]) + 0.5) * (T.GRID[1] - T.GRID[0]) / T.GRID[2]
    for fold in range(FOLDS):
        seen, holding = np.zeros((2, T.BUCKETS)), np.zeros((2, T.BUCKETS))
        learn = [i for i in range(len(tokens)) if folds[i] != fold]
        judge = [i for i in range(len(tokens)) if folds[i] == fold]
        for i in learn:
            own, times = np.unique(tokens[i], return_counts=True)
            seen[labels[i]][own] += times
            holding[labels[i]][own] += 1
        weights = T.log_odds(holding).astype(np.float32).astype(np.float64)
        rate = T._rate(weights, seen[0] / max(seen[0].sum(), 1))
        clean = [tokens[i] for i in learn if labels[i] == 0 and len(tokens[i])]
        tops = [max((s for *_, s in T.segments(weights[t])), default=0.0) for t in clean]
        size = len(clean) / sum(len(t) * np.exp(-rate * s) for t, s in zip(clean, tops))
        histogram = np.zeros((2, T.GRID[2]))
        for i, cell in zip(learn, evidence([tokens[i] for i in learn], weights, rate, size)):
            histogram[labels[i], cell] += 1
        slope, offset = T._logistic(middle, histogram)
        own = np.array([labels[i] for i in judge])
        at = middle[evidence([tokens[i] for i in judge], weights, rate, size)]
        p = 1 / (1 + np.exp(-np.clip(slope * at + offset, -500, 500)))
        errors += int(((p >= 0.5) != own).sum())
        loss -= float(np.log(np.clip(np.where(own == 1, p, 1 - p), 1e-6, 1)).sum())
    return loss, errors


def judged(setting) -> tuple[float, list[int], tuple]:
    each = [losses(*table, setting) for table in tables]
    return float(np.mean([x / len(t[0]) for (x, _), t in zip(each, tables)])), [e for _, e in each], setting


def main(folders: list[str]) -> None:
    for folder in folders:
        table = T._Buckets()
        own = rows(folder)
        tokens = [T._tokens(text, table) for _, text in own]
        folds = [zlib.crc32(" ".join(text.lower().split()[:8]).encode()) % FOLDS for _, text in own]
        tables.append((tokens, [label for label, _ in own], folds))
        print(folder, len(own), "rows,", sum(label for label, _ in own), "toxic")
    with multiprocessing.get_context("fork").Pool(8) as pool:
        found = pool.map(judged, itertools.product(PRIORS, NOISES, DRIFTS), chunksize=1)
    for mean, errors, (mass, noise, drift) in sorted(found):
        print(f"log loss {mean:.4f}  errors {errors}  prior {mass:g}  noise {noise:g}  drift {drift:g}")


if __name__ == "__main__":
    main(sys.argv[1:])
