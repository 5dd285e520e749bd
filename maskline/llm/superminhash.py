"""MinHash near-duplicates by SuperMinHash signatures (operator 1).

Signatures follow Ertl (2017): element d has a random permutation p of the m slots
and random fractions r; slot p[j] holds the least j + r[j] over all elements. Values
of step j are below those of step j + 1, so all elements of a text take a step
together in numpy, and a text stops once every slot is filled.

Equal sets are one class. Classes that agree on a whole band of slots are candidates.
A bucket is never expanded into pairs. Its members are first held against an elected
pivot, each class against the few pivots it shares most bands with; these pairs are
verified and united. A pair is dropped before verification only if its signatures differ
so much (six standard errors) that a link is out of the question. Links are confirmed on
the full sets. Buckets that stay divided (texts that are alike, but below the threshold,
or linked only through others) are cut into blocks, and block is held against block inside
a task. Every pair of different groups is compared there, and a task puts out only links
that unite groups, at most one per member: no row per pair is ever made.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from maskline.llm.common import WordHashes, give_back, map_rows, mixed, shingle_hashes, staged, with_row_key, words_of
from maskline.llm.groups import components

BANDS, ROWS = 30, 5
# Rounds of pivots, and how many pivots a class is held against in one.
PIVOT_ROUNDS, PIVOTS = 2, 3
# Members of a divided bucket that are compared with as many others at a time.
BLOCK = 1_024
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW = np.uint64(0xFFFFFFFF)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def signatures(elements: np.ndarray, counts: np.ndarray, slots: int) -> np.ndarray:
    """SuperMinHash signatures, one row per text, of the texts' sets laid end to end.

    A value is step * 2^32 + fraction. A text without elements keeps the largest value.
    """
    n = len(counts)
    out = np.full(n * slots, _EMPTY, np.uint64)
    owner = np.repeat(np.arange(n), counts)
    state = mixed(elements + _STEP)
    pick = ((state >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
    np.minimum.at(out, owner * slots + pick, state & _LOW)
    kind = np.uint8 if slots <= 256 else np.uint16
    order, step = None, 0
    while step + 1 < slots:
        step += 1
        open_texts = (out.reshape(n, slots) == _EMPTY).any(axis=1) & (counts > 0)
        active = open_texts[owner]
        if not active.any():
            break
        if order is None:
            owner, state, pick = owner[active], state[active], pick[active]
            row = np.arange(len(owner))
            order = np.tile(np.arange(slots, dtype=kind), (len(owner), 1))
            order[row, pick] = 0
            order[:, 0] = pick
        elif not active.all():
            owner, state, order = owner[active], state[active], order[active]
            row = np.arange(len(owner))
        state = mixed(state + _STEP)
        pick = step + ((state >> np.uint64(32)) * np.uint64(slots - step) >> np.uint64(32)).astype(np.int64)
        slot = order[row, pick]
        order[row, pick] = order[:, step]
        order[:, step] = slot
        np.minimum.at(out, owner * slots + slot.astype(np.int64), (state & _LOW) | np.uint64(step << 32))
    return out.reshape(n, slots)


def shingle_set(text: str | None, size: int, table: WordHashes) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct shingles."""
    return np.unique(shingle_hashes(table.of(words_of(text)), size))


def _digest(members: np.ndarray) -> bytes | None:
    import xxhash

    return xxhash.xxh3_128_digest(members.tobytes()) if len(members) else None


def linked_pairs(sets: list[np.ndarray], groups: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Pairs i < j of different groups whose sets overlap by num/den or more."""
    n = len(sets)
    sizes = np.array([len(x) for x in sets], np.int64)
    rows = np.repeat(np.arange(n), sizes)
    _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = seen[column] > 1
    rows, column = rows[keep], column[keep]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], np.unique(column[order], return_inverse=True)[1]
    common = np.zeros((n, n), np.float32)  # counts below 2^24 are exact
    width = 2_048
    part = np.zeros((n, width), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [at, at + width])
        part[:] = 0
        part[rows[lo:hi], column[lo:hi] - at] = 1
        common += part @ part.T
    found = []
    for lo in range(0, n, 128):
        both = common[lo : lo + 128].astype(np.float64)
        link = den * both >= num * (sizes[lo : lo + 128, None] + sizes[None, :] - both)
        link &= groups[lo : lo + 128, None] != groups[None, :]
        found += [(i + lo, j) for i, j in zip(*(x.tolist() for x in np.nonzero(link))) if i + lo < j]
    return found


def uniting(pairs: list[tuple[int, int]], groups: np.ndarray) -> list[tuple[int, int]]:
    """The pairs that, one after the other, still bring two groups together."""
    parent = list(range(int(groups.max(initial=-1)) + 1))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept = []
    for i, j in pairs:
        a, b = root(groups[i]), root(groups[j])
        if a != b:
            parent[a] = b
            kept.append((i, j))
    return kept


def _block_links(num: int, den: int):
    """Links between members of different groups, for rows sorted by (band, i, j)."""

    def compare(members):
        nodes, labels, sets = zip(*members)
        if len(set(labels)) < 2:
            return []
        number: dict = {}
        groups = np.array([number.setdefault(x, len(number)) for x in labels])
        return [(min(nodes[x], nodes[y]), max(nodes[x], nodes[y])) for x, y in uniting(linked_pairs(sets, groups, num, den), groups)]

    def run(batches):
        give_back()
        schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
        group, members = None, {}
        for batch in batches:
            found = []
            for band, i, j, node, label, data in zip(*[c.to_pylist() for c in batch.columns]):
                if (band, i, j) != group:
                    if len(members) > 1:
                        found += compare(members.values())
                    group, members = (band, i, j), {}
                members[node] = (node, label, np.frombuffer(data, np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.binary())], schema=schema
            )
        if len(members) > 1:
            found = compare(members.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.binary())], schema=schema
            )

    return run


def near_duplicates(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    words: int = 5,
    num: int = 80,
    den: int = 100,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Groups of texts whose sets of `words`-word shingles overlap by num/den or more.

    Words are ASCII-lower-cased runs of characters other than ASCII white space; a text
    with fewer words than a shingle is one shingle; texts without words (null, empty,
    white space) have an empty set and are linked with nothing.

    One row per input row: the key, text_hash (xxhash64 of the text), n_shingles,
    component_id (least key reachable over links, nulls last) and first (the one row
    of its group that stays: least key, then least text_hash; among fully repeated
    rows all say so). Rows with a null key take part in linking. Repeated keys are
    separate rows. Other columns are not carried.
    """
    slots = bands * rows
    table = WordHashes()
    sure = num / den
    least_equal = math.floor(slots * (sure - 6 * math.sqrt(sure * (1 - sure) / slots)))
    source = docs.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash")
    )
    key_type = source.schema["key"].dataType.simpleString()

    def describe(keys, texts, text_hashes):
        sets = [shingle_set(t, words, table) for t in texts]
        counts = np.array([len(s) for s in sets], np.int64)
        values = signatures(np.concatenate(sets), counts, slots)
        sketches = (values & np.uint64(0xFF)).astype(np.uint8)
        keyed = np.zeros((len(sets), bands), np.uint64)
        for r in range(rows):
            keyed = mixed(keyed + values[:, r::rows] + _STEP)
        keyed = mixed(keyed + np.arange(bands, dtype=np.uint64)).view(np.int64)
        filled = counts > 0
        return (
            keys,
            text_hashes,
            counts,
            [_digest(s) for s in sets],
            [k if f else None for k, f in zip(keyed, filled)],
            [s.tobytes() if f else None for s, f in zip(sketches, filled)],
        )

    described = staged(
        map_rows(
            source,
            describe,
            f"key {key_type}, text_hash bigint, n bigint, node binary, bands array<bigint>, sketch binary",
        ),
        "signatures",
    )
    rank = F.struct(F.col("key").isNull().alias("late"), "key", "text_hash")
    classes = staged(
        described.where("node is not null")
        .groupBy("node")
        .agg(F.min(F.struct(F.col("key").isNull().alias("late"), "key", "text_hash", "n", "bands", "sketch")).alias("rep"))
        .select("node", "rep.*"),
        "classes",
    )
    members = classes.select("node", "n", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi")
    buckets = staged(members.join(shared.select("band"), "band"), "buckets")

    def looks_alike(a, b, left, right):
        equal = [
            np.count_nonzero(np.frombuffer(x, np.uint8) == np.frombuffer(y, np.uint8)) >= least_equal
            for x, y in zip(left, right)
        ]
        return a, b, equal

    def texts_of(wanted: DataFrame) -> DataFrame:
        """The text of each row's class (column node)."""
        reps = classes.select("node", F.col("key").alias("rep_key"), F.col("text_hash").alias("rep_hash"))
        return source.join(
            wanted.join(reps, "node"),
            F.col("key").eqNullSafe(F.col("rep_key")) & (F.col("text_hash") == F.col("rep_hash")),
        )

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of classes that are links."""
        sketch = classes.select("node", "sketch")
        alike = map_rows(
            pairs.join(sketch.toDF("a", "left"), "a").join(sketch.toDF("b", "right"), "b").select("a", "b", "left", "right"),
            looks_alike,
            "a binary, b binary, alike boolean",
            "left",
        )
        alike = staged(alike.where("alike").select("a", "b"), "candidates")
        sides = alike.select(F.col("a").alias("node"), "a", "b", F.lit(True).alias("is_a")).union(
            alike.select(F.col("b").alias("node"), "a", "b", F.lit(False).alias("is_a"))
        )
        texts = texts_of(sides).select("text", "a", "b", "is_a")
        last: dict = {}

        def sets(texts, a, b, is_a):
            out = []
            for t, x, y, first in zip(texts, a, b, is_a):
                node = x if first else y
                if last.get("node") != node:
                    found = shingle_set(t, words, table)
                    last.update(node=node, data=found.tobytes() if _digest(found) == node else None)
                out.append(last["data"])
            return a, b, is_a, out

        both = (
            map_rows(texts, sets, "a binary, b binary, is_a boolean, data binary")
            .groupBy("a", "b")
            .agg(
                F.max(F.when(F.col("is_a"), F.col("data"))).alias("left"),
                F.max(F.when(~F.col("is_a"), F.col("data"))).alias("right"),
            )
        )

        def linked(a, b, left, right):
            out = []
            for x, y in zip(left, right):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                out.append(den * common >= num * (len(x) + len(y) - common))
            return a, b, out

        return staged(
            map_rows(both, linked, "a binary, b binary, link boolean", "left").where("link").select("a", "b"), "verified"
        )

    def block_links(divided: DataFrame) -> DataFrame:
        """Links inside divided buckets (band, node, n, label, size)."""

        def sets(texts, nodes):
            found = [shingle_set(t, words, table) for t in texts]
            return nodes, [x.tobytes() if _digest(x) == node else None for x, node in zip(found, nodes)]

        data = map_rows(
            texts_of(divided.select("node").distinct()).select("text", "node"), sets, "node binary, data binary"
        ).where("data is not null")
        blocks = F.ceil(F.col("size") / BLOCK).cast("int")
        own = F.pmod(F.xxhash64("node"), blocks).cast("int")
        dealt = divided.select(
            "band", "node", "label", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
        ).select("band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "label")
        by = ["band", "i", "j"]
        rows = dealt.join(data, "node").select(*by, "node", "label", "data").repartition(*by).sortWithinPartitions(*by)
        return staged(rows.mapInArrow(_block_links(num, den), "a binary, b binary").distinct(), "block-links")

    links, groups, tried = None, None, None
    for turn in range(PIVOT_ROUNDS + 1):
        now = buckets
        if groups is not None:
            now = buckets.join(groups, "node", "left").withColumn("label", F.coalesce("label", "node"))
            mixed_buckets = now.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
            now = now.join(mixed_buckets.select("band"), "band")
        else:
            now = now.withColumn("label", F.col("node"))
        now = now.select("band", "node", "n", "label")
        if turn < PIVOT_ROUNDS:
            lot = F.struct(F.xxhash64("node", F.lit(turn)).alias("lot"), "node", "n", "label")
            pivots = now.groupBy("band").agg(F.min(lot).alias("p")).select(
                "band", F.col("p.node").alias("node2"), F.col("p.n").alias("n2"), F.col("p.label").alias("label2")
            )
            fits = (
                (F.col("label") != F.col("label2"))
                & (F.col("n") * den >= F.col("n2") * num)
                & (F.col("n2") * den >= F.col("n") * num)
            )
            met = now.join(pivots, "band").where(fits).groupBy("node", "node2").agg(F.count(F.lit(1)).alias("bands"))
            most = Window.partitionBy("node").orderBy(F.desc("bands"), F.xxhash64("node2"), "node2")
            pairs = met.withColumn("place", F.row_number().over(most)).where(F.col("place") <= PIVOTS)
            pairs = pairs.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()
            if tried is not None:
                pairs = pairs.join(tried, ["a", "b"], "left_anti")
            pairs = staged(pairs, "pairs")
            tried = pairs if tried is None else tried.union(pairs)
            found = verified(pairs)
        else:
            sized = now.groupBy("band").agg(
                F.count(F.lit(1)).alias("size"), F.min("node").alias("a"), F.max("node").alias("b"),
                F.min("n").alias("least"), F.max("n").alias("most"),
            )
            # two classes of too different sizes, or that were held against each other, are settled
            settled = tried.select("a", "b", F.lit(2).cast("bigint").alias("size"))
            open_buckets = (
                sized.where((F.col("size") > 2) | (F.col("least") * den >= F.col("most") * num))
                .join(settled, ["a", "b", "size"], "left_anti")
                .select("band", "size")
            )
            found = block_links(staged(now.join(open_buckets, "band"), "divided"))
        links = found if links is None else links.union(found)
        groups = components(links)

    labelled = classes.select("node", F.struct("late", "key", "text_hash").alias("rep"))
    if groups is not None:
        labelled = labelled.join(groups, "node", "left").withColumn("label", F.coalesce("label", "node"))
    else:
        labelled = labelled.withColumn("label", F.col("node"))
    heads = labelled.groupBy("label").agg(F.min("rep").alias("head"))
    heads = labelled.select("node", "label").join(heads, "label").select("node", "head")
    return described.join(heads, "node", "left").select(
        F.col("key").alias(key),
        "text_hash",
        F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("head.key")).alias("component_id"),
        F.when(F.col("node").isNull(), F.lit(True)).otherwise(rank == F.col("head")).alias("first"),
    )


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows, with all columns, without near-duplicates: of each group its first row stays.

    Of fully repeated rows (same key and text) one stays, whatever its other columns say.
    Rows without words are no one's duplicates and all stay.
    """
    if len(set(docs.columns)) != len(docs.columns):
        raise ValueError("column names must differ")
    worded = F.coalesce(F.rlike(text, F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    found = near_duplicates(docs.where(worded), key=key, text=text, words=words, num=num, den=den)
    keyed, name = with_row_key(docs.where(worded), key, text)
    parts = F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("null")), F.col("text_hash").cast("string"))
    stay = found.where("first").select(parts.alias(name)).distinct()
    kept = keyed.join(stay, name).dropDuplicates([name]).select(*docs.columns)
    return kept.union(docs.where(~worded))
