"""Clustering of integer vectors by scalar lookup tables (operator 11).

Every round tabulates, for each dimension, the squared difference between each integer
value that occurs there and each centroid; a vector's distances are gathers from those
tables, summed over the dimensions. Tables are made for a slice of rows at a time, so
their size is bounded by the slice, however many values occur in the whole table.

Vectors stay where they are: a round reads the staged integers, each task adds up its own
rows per centroid, and only k times dims sums meet. The centroids (k times dims integers)
are all that the driver sees.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskline.llm.common import ship, staged

SLICE_ROWS = 8_192
# Integers below this keep sums of squares inside 64 bits; larger ones are handled by Python's.
SMALL = 1 << 27
LOW_BITS = 32


def finite(vector: str) -> Column:
    """True for vectors that are not null and hold finite numbers only; never null."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def integers(vector: str) -> Column:
    """floor(256 * x) of every component, x as double; what a long cannot hold is an error."""

    def one(x: Column) -> Column:
        scaled = x.cast("double") * 256
        wrong = F.raise_error(F.lit("component beyond the range of a long")).cast("bigint")
        return F.when(F.abs(scaled) >= float(2**62), wrong).otherwise(F.floor(scaled))

    return F.transform(vector, one)


def _exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as they are if 64 bits suffice, else as arrays of Python integers."""
    if all(np.abs(a).max(initial=0) < SMALL for a in arrays) and arrays[0].shape[1] < 1_000:
        return list(arrays)
    return [a.astype(object) for a in arrays]


def nearest(values: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (of equals the smaller number) of each row, and the squared distance."""
    values, centroids = _exact(values, centroids)
    total = np.zeros((len(values), len(centroids)), values.dtype)
    for d in range(values.shape[1]):
        seen, place = np.unique(values[:, d], return_inverse=True)
        table = seen[:, None] - centroids[None, :, d]
        total += (table * table)[place]
    best = total.argmin(axis=1)
    return best, np.take_along_axis(total, best[:, None], axis=1)[:, 0]


def _slices(batches, dims: int):
    """(other columns, integer matrix) of parts of at most SLICE_ROWS rows; the vector comes last."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            yield part, np.asarray(part.column(part.num_columns - 1).flatten()).reshape(-1, dims)


def _sums(centroids: np.ndarray):
    """Per task and centroid: rows and component sums, each sum cut into a high and a low half."""

    def run(batches):
        k, dims = centroids.shape
        count = np.zeros(k, np.int64)
        total = np.zeros((k, dims), object)
        for _, values in _slices(batches, dims):
            best, _ = nearest(values, centroids)
            count += np.bincount(best, minlength=k)
            ranks = np.argsort(best, kind="stable")
            own, starts = np.unique(best[ranks], return_index=True)
            # a slice's sums fit 64 bits below 2^49 for each component
            grouped = values[ranks] if np.abs(values).max(initial=0) < 1 << 49 else values[ranks].astype(object)
            if len(own):
                total[own] += np.add.reduceat(grouped, starts, axis=0)
        own = np.flatnonzero(count)
        whole = [[int(x) for x in row] for row in total[own]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(own, pa.int32()),
                pa.array(count[own], pa.int64()),
                pa.array([[x >> LOW_BITS for x in row] for row in whole], pa.list_(pa.int64())),
                pa.array([[x & (1 << LOW_BITS) - 1 for x in row] for row in whole], pa.list_(pa.int64())),
            ],
            names=["cluster", "n", "high", "low"],
        )

    return run


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor(sum / count) of their vectors; empty ones stay."""
    parts = vectors.select("vector").mapInArrow(
        _sums(centroids), "cluster int, n bigint, high array<bigint>, low array<bigint>"
    )
    cells = (
        parts.select("cluster", "n", F.posexplode(F.arrays_zip("high", "low")).alias("dim", "half"))
        .groupBy("cluster", "dim")
        .agg(F.sum("n").alias("n"), F.sum("half.high").alias("high"), F.sum("half.low").alias("low"))
    )
    moved = centroids.copy()
    for row in cells.collect():  # k times dims rows at most
        moved[row["cluster"], row["dim"]] = ((row["high"] << LOW_BITS) + row["low"]) // row["n"]
    return moved


def cluster(
    table: DataFrame,
    *,
    k: int = 40,
    rounds: int = 5,
    dims: int = 64,
    seed: str = "2",
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Lloyd's rounds over floor(256 * x) of every vector with exactly `dims` finite components.

    The first centroids are the k vectors with the least hexadecimal SHA-256 of
    `seed:key`, in that order; rows with a null key come last, equal hashes are ordered by
    vector. Each round moves every centroid to its vectors' componentwise floor(sum / count);
    an empty one stays. Then vectors are assigned once more.

    One row per kept row: the key, cluster, distance (squared), cluster_inertia and inertia
    (distance summed over the cluster and over all), centroid (its final integers). Null,
    short, long and non-finite vectors take no part; rows with a null or repeated key are
    rows like any other. With fewer than k vectors there are as many centroids as vectors;
    an empty table gives an empty result. Other columns are not carried. A component or a
    distance that a long cannot hold is an error.
    """
    spark = table.sparkSession
    ship(spark)
    kind = table.schema[key].dataType.simpleString()
    vectors = staged(
        table.where(finite(vector) & (F.size(vector) == dims)).select(F.col(key).alias("key"), integers(vector).alias("vector")),
        "integers",
    )
    lot = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    first = vectors.select("vector", lot.alias("lot")).orderBy(F.asc_nulls_last("lot"), "vector").limit(k).collect()
    schema = f"`{key}` {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
    if not first:
        return spark.createDataFrame([], schema)
    centroids = np.array([row["vector"] for row in first], np.int64)
    for _ in range(rounds):
        centroids = _moved(vectors, centroids)
    final = centroids

    def assign(batches):
        for part, values in _slices(batches, dims):
            best, distance = nearest(values, final)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(best, pa.int32()), pa.array(distance, pa.int64())], names=["key", "cluster", "distance"]
            )

    assigned = staged(vectors.mapInArrow(assign, f"key {kind}, cluster int, distance bigint"), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()  # k rows at most
    whole = sum(row["s"] for row in sums)
    about = spark.createDataFrame(
        [(row["cluster"], row["s"], whole, final[row["cluster"]].tolist()) for row in sums],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>",
    )
    return assigned.join(F.broadcast(about), "cluster").select(
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )
