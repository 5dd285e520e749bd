"""Intermediate tables in the folder all executors share.

A staged table cuts the lineage: what was read once from the big texts is
neither recomputed by later steps nor lost with an executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_local_dir: str | None = None
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; a temporary folder only where one machine runs everything."""
    global _local_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="maskline-")
    return _local_dir


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/maskline/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def stage(df: DataFrame, label: str, size: Column | None = None) -> tuple[DataFrame, int]:
    """Write `df` once and read it back; `size` is summed on the way (default: rows)."""
    spark = df.sparkSession
    path = new_path(spark, label)
    seen = Observation()
    df.observe(seen, F.coalesce(F.sum(F.lit(1) if size is None else size), F.lit(0)).alias("n")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), int(seen.get["n"])


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Whatever is staged in this block is deleted at its end, also when it fails.

    Results must be written out inside the block: staged spans and mappings hold raw values.
    """
    before = len(_written)
    try:
        yield
    finally:
        drop_staged(spark, before)


def drop_staged(spark: SparkSession, keep: int = 0) -> None:
    """Delete the tables this process staged, but for the first `keep`. Results that still read them become invalid."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    while len(_written) > keep:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)
