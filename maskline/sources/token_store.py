"""A token mapping that grows batch by batch, read in proportion to what is asked for.

Every batch adds one small folder of entries (a delta). After COMPACT_AFTER deltas they are
merged into a base that is kept in buckets by value (for tokenizing), in buckets by token
(for restoring), and as the highest ordinal of each scope and type. A reader names the
values or tokens it wants; only their buckets of the base are opened, and what is opened
meets a bit filter of the wanted keys before it goes anywhere.

A folder counts once its commit exists: a file named by the next version, which can be
created once only. A second writer that allocated from the same state fails there, so no
token ever stands for two values; entries that contradict the store are refused as well.
The store holds raw values: keep it apart from the texts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskline.operators.lookup import likely
from maskline.operators.mapping import MAPPING_COLUMNS, MAPPING_SCHEMA, VALUE_KEY

COMPACT_AFTER = 16
BUCKET_ROWS = 100_000
LEAST_BUCKETS, MOST_BUCKETS = 16, 4_096
TOKEN_KEY = ["scope", "token"]
HIGH_SCHEMA = "scope string, pii_type string, ordinal bigint"


class StoreConflict(RuntimeError):
    """Another writer was faster, or the entries contradict the store."""


@dataclass(frozen=True)
class Commit:
    version: int
    kind: str  # delta or base
    folder: str
    writer: str = ""
    batch: int = -1
    buckets: int = 0


def bucket_of(columns: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


class TokenStore:
    """The mapping under `path`; with `before`, as it was before that version."""

    def __init__(self, spark: SparkSession, path: str, before: int | None = None) -> None:
        self.spark, self.path, self.before = spark, path.rstrip("/"), before

    # --- commits -------------------------------------------------------------------------

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _all(self) -> list[Commit]:
        root, fs = self._fs(f"{self.path}/_commits")
        if not fs.exists(root):
            return []
        out = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if not name.isdigit():
                continue
            stream = fs.open(status.getPath())
            try:
                said = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if not said:
                raise StoreConflict(f"commit {name} of {self.path} is unfinished; delete it if its writer is gone")
            out.append(Commit(int(name), **json.loads(said)))
        return sorted(out, key=lambda c: c.version)

    def commits(self) -> list[Commit]:
        """What counts: the last base and the deltas after it."""
        found = [c for c in self._all() if self.before is None or c.version < self.before]
        last = max((i for i, c in enumerate(found) if c.kind == "base"), default=0)
        return found[last:]

    def committed(self, writer: str, batch: int) -> Commit | None:
        return next((c for c in self._all() if (c.writer, c.batch) == (writer, batch)), None)

    def _commit(self, kind: str, folder: str, version: int, **about) -> None:
        path, fs = self._fs(f"{self.path}/_commits/{version:012d}")
        try:
            out = fs.create(path, False)
        except Exception as error:
            if "exist" not in str(error):
                raise
            raise StoreConflict(f"version {version} of {self.path} was committed by another writer") from error
        out.write(bytearray(json.dumps({"kind": kind, "folder": folder, **about}).encode()))
        out.close()

    # --- reading -------------------------------------------------------------------------

    def _parts(self, side: str, wanted: DataFrame | None, key: Sequence[str], schema: str) -> DataFrame:
        """One side of base and deltas; of the base only the buckets that hold `wanted` keys."""
        commits = self.commits()
        out = None
        if commits and commits[0].kind == "base":
            base = commits.pop(0)
            out = self.spark.read.schema(f"{schema}, bucket int").parquet(f"{self.path}/{base.folder}/{side}")
            if wanted is not None:
                hit = [r[0] for r in wanted.select(bucket_of(key, base.buckets)).distinct().collect()]  # MOST_BUCKETS at most
                if len(hit) < base.buckets:
                    out = out.where(F.col("bucket").isin(sorted(hit)))
            out = out.drop("bucket")
        inside = "high" if side == "high" else "entries"
        folders = [f"{self.path}/{c.folder}/{inside}" for c in commits]
        if folders:
            fresh = self.spark.read.schema(schema).parquet(*folders)
            out = fresh if out is None else out.union(fresh)
        return out if out is not None else self.spark.createDataFrame([], schema)

    def entries(self) -> DataFrame:
        return self._parts("by_value", None, VALUE_KEY, MAPPING_SCHEMA).select(*MAPPING_COLUMNS)

    def holding(self, keys: DataFrame, n_keys: int) -> DataFrame:
        """The entries of the given (scope, pii_type, value), and perhaps a few more."""
        return likely(self._parts("by_value", keys, VALUE_KEY, MAPPING_SCHEMA), keys, VALUE_KEY, n_keys)

    def for_tokens(self, keys: DataFrame, n_keys: int) -> DataFrame:
        """The entries of the given (scope, token), and perhaps a few more."""
        return likely(self._parts("by_token", keys, TOKEN_KEY, MAPPING_SCHEMA), keys, TOKEN_KEY, n_keys)

    def high_water(self, keys: DataFrame) -> DataFrame:
        """(scope, pii_type, ordinal): the highest ordinal given out so far, for the scopes in `keys`."""
        high = self._parts("high", keys, ["scope"], HIGH_SCHEMA)
        return high.groupBy("scope", "pii_type").agg(F.max("ordinal").alias("ordinal"))

    # --- writing -------------------------------------------------------------------------

    def append(self, new: DataFrame, *, writer: str, batch: int) -> None:
        """Add entries, once for each (writer, batch). They are readable when all is written and checked."""
        if self.before is not None:
            raise ValueError("an earlier state of a store is read-only")
        if self.committed(writer, batch) is not None:
            return
        version = max((c.version for c in self._all()), default=0) + 1
        self._append(new, version, writer, batch)

    def _append(self, new: DataFrame, version: int, writer: str, batch: int) -> None:
        folder = f"delta-{version:012d}-{uuid.uuid4().hex[:8]}"
        at = f"{self.path}/{folder}"
        new.select(*MAPPING_COLUMNS).write.parquet(f"{at}/entries")
        written = self.spark.read.schema(MAPPING_SCHEMA).parquet(f"{at}/entries")
        written.groupBy("scope", "pii_type").agg(F.max("ordinal").alias("ordinal")).write.parquet(f"{at}/high")
        n = written.count()
        held = self.for_tokens(written, n).unionByName(written) if n else written
        # also across scopes and types a token is what its ordinal says
        twice = held.groupBy(*TOKEN_KEY).agg(F.count_distinct("pii_type", "value").alias("n")).where("n > 1")
        clash = twice.first()
        if clash is not None:
            raise StoreConflict(f"token {clash['token']} of scope {clash['scope']} would stand for {clash['n']} values")
        self._commit("delta", folder, version, writer=writer, batch=batch)

    def extend(self, batch: int, writer: str) -> tuple[TokenStore, int]:
        """(state to allocate from, version to commit): the state before a batch, also when it is replayed."""
        done = self.committed(writer, batch)
        if done is not None:
            return TokenStore(self.spark, self.path, done.version), done.version
        self.compact_if_due()
        version = max((c.version for c in self._all()), default=0) + 1
        return TokenStore(self.spark, self.path, version), version

    def commit(self, new: DataFrame, version: int, *, writer: str, batch: int) -> None:
        """Add a batch allocated from the state that `extend` gave; a replay adds nothing."""
        done = self.committed(writer, batch)
        if done is None or done.version != version:
            self._append(new, version, writer, batch)

    def compact_if_due(self) -> None:
        if sum(c.kind == "delta" for c in self.commits()) >= COMPACT_AFTER:
            self.compact()

    def compact(self) -> None:
        """Merge base and deltas into a new base; what the base before replaced is deleted."""
        commits = self._all()
        current = self.commits()
        if not any(c.kind == "delta" for c in current):
            return
        version = commits[-1].version + 1
        folder = f"base-{version:012d}-{uuid.uuid4().hex[:8]}"
        entries = self.entries()
        buckets = LEAST_BUCKETS
        n = entries.count()
        while buckets < MOST_BUCKETS and buckets * BUCKET_ROWS < n:
            buckets *= 2

        def write(df: DataFrame, side: str, key: Sequence[str]) -> None:
            at = df.withColumn("bucket", bucket_of(key, buckets)).repartition("bucket").sortWithinPartitions("bucket", *key)
            at.write.partitionBy("bucket").parquet(f"{self.path}/{folder}/{side}")

        write(entries, "by_value", VALUE_KEY)
        write(entries, "by_token", TOKEN_KEY)
        write(self._parts("high", None, ["scope"], HIGH_SCHEMA).groupBy("scope", "pii_type").agg(F.max("ordinal").alias("ordinal")), "high", ["scope"])
        self._commit("base", folder, version, buckets=buckets)
        # readers of the state before may still be at work: only what they never open goes
        bases = [c.version for c in commits if c.kind == "base"]
        for old in (c for c in commits if bases and c.version < bases[-1]):
            for path in (f"{self.path}/_commits/{old.version:012d}", f"{self.path}/{old.folder}"):
                at, fs = self._fs(path)
                fs.delete(at, True)
