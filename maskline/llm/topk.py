"""Exact largest inner products of integer vectors by columnar branch-and-bound (operator 12).

Candidates are dealt to shards of a fixed size and kept column by column (vertical layout),
the heaviest dimensions first. A block of queries adds up its scores a few dimensions at a
time. What the rest of the dimensions can still add is at most the product of the remaining
norms of query and candidate (Cauchy-Schwarz); a candidate that stays below the query's
k-th score even so is dropped. Once few are left, the survivors are compacted into lists of
(query, candidate), which only the remaining columns are read for.

Every query first searches its own shard. The k-th score found there goes with it to all
other shards, where it bounds the search from the start and keeps their answers short.
All sums are exact: in doubles while they stay below 2^53, else in Python's integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from maskline.llm.centroids import finite, integers
from maskline.llm.common import ship, staged

SHARD_ROWS = 8_192
QUERY_ROWS = 256
DIM_BLOCK = 16
# Survivors are compacted once they are this share of a query block's pairs or fewer.
COMPACT = 0.125
_NONE = -np.inf


class Shard:
    """Candidates in vertical layout: one row per dimension, ids ascending."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        ranks = np.argsort(ids, kind="stable")
        self.ids = ids[ranks]
        self.largest = int(np.abs(vectors).max(initial=0))
        wide = vectors[ranks].astype(np.float64)
        self.order = np.argsort(-(wide * wide).sum(axis=0), kind="stable")
        self.columns = np.ascontiguousarray(wide[:, self.order].T)
        self.exact = vectors[ranks]
        self.left = remaining(self.columns.T)


def remaining(rows: np.ndarray) -> np.ndarray:
    """For each block of dimensions the norm of what comes after it, rounded up."""
    squares = np.add.accumulate((rows * rows)[:, ::-1], axis=1)[:, ::-1]
    ends = range(DIM_BLOCK, rows.shape[1], DIM_BLOCK)
    return np.array([np.sqrt(squares[:, e]) * (1 + 1e-9) + 1e-6 for e in ends]).reshape(-1, len(rows))


def search(shard: Shard, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int):
    """(query row, candidate row, score) of the k best per query that reach its floor, best first.

    Of equal scores the smaller ids come first; a query's own id is no candidate.
    """
    n, dims = len(shard.ids), queries.shape[1]
    none = np.empty(0, np.int64)
    if not n or not len(queries):
        return none, none, none
    own = shard.ids[None, :] == query_ids[:, None]
    if shard.largest * int(np.abs(queries).max(initial=0)) * max(dims, 1) >= 1 << 53:
        scores = queries.astype(object) @ shard.exact.astype(object).T
        q, c = np.nonzero(~own)
        return _best(q, c, scores[q, c], k)

    wide = queries[:, shard.order].astype(np.float64)
    query_left = remaining(wide)
    part = np.zeros((len(wide), n))
    q, c, floors = None, None, floors.copy()
    for b, at in enumerate(range(0, dims, DIM_BLOCK)):
        block = range(at, min(at + DIM_BLOCK, dims))
        if q is None:
            part += wide[:, at : block.stop] @ shard.columns[at : block.stop]
            if b == 0:
                part[own] = _NONE
                floors = np.maximum(floors, _reached(shard, wide, part, k))
            if block.stop < dims:
                alive = part + query_left[b][:, None] * shard.left[b][None, :] >= floors[:, None]
                if np.count_nonzero(alive) <= COMPACT * alive.size:
                    q, c = np.nonzero(alive)
                    part = part[q, c]
        else:
            for d in block:
                part += wide[q, d] * shard.columns[d][c]
            if block.stop < dims:
                alive = part + query_left[b][q] * shard.left[b][c] >= floors[q]
                q, c, part = q[alive], c[alive], part[alive]
    if q is None:
        q, c = np.nonzero((part >= floors[:, None]) & ~own)
        part = part[q, c]
    else:
        alive = part >= floors[q]
        q, c, part = q[alive], c[alive], part[alive]
    return _best(q, c, part, k)


def _reached(shard: Shard, wide: np.ndarray, part: np.ndarray, k: int) -> np.ndarray:
    """A score that k candidates of each query reach: those that lead after the first block."""
    n = part.shape[1]
    if n <= k:
        return np.full(len(wide), _NONE)
    lead = np.argpartition(-part, k - 1, axis=1)[:, :k]
    scores = np.einsum("qd,dqk->qk", wide, shard.columns[:, lead])
    scores[np.take_along_axis(part, lead, axis=1) == _NONE] = _NONE
    return scores.min(axis=1)


def _best(q: np.ndarray, c: np.ndarray, score: np.ndarray, k: int):
    """The k best of each query's pairs; `c` orders as the ids do."""
    ranks = np.lexsort((c, -score, q)) if score.dtype != object else np.array(
        sorted(range(len(q)), key=lambda i: (q[i], -score[i], c[i])), np.int64
    )
    q, c, score = q[ranks], c[ranks], score[ranks]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[keep], c[keep], score[keep]


def _answers(k: int):
    """Answers of rows sorted by (dim, shard, asks): a shard's candidates come before its queries."""

    def run(batches):
        at, parts, shard = None, [], None
        for batch in batches:
            keys = np.column_stack([np.asarray(batch.column(i)).astype(np.int64) for i in range(3)])
            starts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for lo, hi in zip(starts, starts[1:]):
                if lo == hi:
                    continue
                dim, number, asks = keys[lo].tolist()
                ids = np.asarray(batch.column(3).slice(lo, hi - lo))
                vectors = np.asarray(batch.column(4).slice(lo, hi - lo).flatten()).reshape(hi - lo, dim)
                if at != (dim, number):
                    at, parts, shard = (dim, number), [], None
                if not asks:
                    parts.append((ids, vectors))
                    continue
                if shard is None:
                    if not parts:
                        continue
                    shard = Shard(np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts]))
                    parts = []
                floors = np.asarray(batch.column(5).slice(lo, hi - lo).fill_null(_NONE))
                for i in range(0, hi - lo, QUERY_ROWS):
                    some = slice(i, i + QUERY_ROWS)
                    q, c, score = search(shard, ids[some], vectors[some], floors[some], k)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[some][q], pa.int64()),
                            pa.array(shard.ids[c], pa.int64()),
                            pa.array([int(x) for x in score], pa.int64()),
                        ],
                        names=["query_id", "id", "score"],
                    )

    return run


def largest_products(
    table: DataFrame,
    queries: Column,
    *,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """The k rows with the largest inner product of floor(256 * x) for each row that meets `queries`.

    Columns query_id, rank (from 1), `key`, score (bigint). Ties go to the smaller key; all
    candidates come if there are fewer than k. Rows with a null key or a vector that is null
    or holds null or non-finite components take no part; zero and empty vectors do. Vectors
    of different lengths have no product. Of rows that share a key the one with the least
    vector counts. An empty table gives an empty result. Other columns are not carried.
    """
    ship(table.sparkSession)
    rows = (
        table.where(F.col(key).isNotNull() & finite(vector))
        .select(F.col(key).cast("bigint").alias("id"), integers(vector).alias("vector"), F.coalesce(queries, F.lit(False)).alias("query"))
        .groupBy("id")
        .agg(F.min(F.struct("vector", "query")).alias("row"))
        .select(F.size("row.vector").alias("dim"), "id", "row.vector", "row.query")
    )
    rows = staged(rows, "integers")
    n_shards = max(1, -(-rows.count() // shard_rows))
    own = F.pmod(F.xxhash64("id"), F.lit(n_shards)).cast("int")
    held = rows.select("dim", own.alias("shard"), F.lit(0).alias("asks"), "id", "vector", F.lit(None).cast("double").alias("floor"))
    asked = rows.where("query").select("dim", own.alias("own"), "id", "vector")

    def answered(sent: DataFrame) -> DataFrame:
        sent = sent.select("dim", "shard", F.lit(1).alias("asks"), "id", "vector", "floor")
        dealt = held.union(sent).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "asks")
        return dealt.mapInArrow(_answers(k), "query_id bigint, id bigint, score bigint")

    near = staged(answered(asked.select("*", F.col("own").alias("shard"), F.lit(None).cast("double").alias("floor"))), "own-shard")
    floors = near.groupBy(F.col("query_id").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    bounded = asked.join(floors, "id", "left").withColumn("floor", F.when(F.col("n") >= k, F.col("least").cast("double")))
    others = bounded.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))).where("shard <> own")
    ranked = near.union(answered(others)).withColumn(
        "rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id")).cast("int")
    )
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")
