"""Operators 11 to 13 against brute force, and their edge cases."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskline.llm import centroids, conversations, topk

VECTORS = "vec_id bigint, embedding array<double>"


def whole(vector):
    return [math.floor(256 * x) for x in vector]


def usable(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


# --- operator 11 -----------------------------------------------------------------------


def clusters_by_hand(rows, k, rounds, dims):
    kept = [(i, whole(v)) for i, v in rows if usable(v) and len(v) == dims]
    lot = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    points = [v for _, v in sorted(kept, key=lot)[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, p)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for c in range(len(points)):
            mine = [v for (_, v), o in zip(kept, own) if o == c]
            if mine:
                points[c] = [sum(column) // len(mine) for column in zip(*mine)]
    last = [(i, *nearest(v)) for i, v in kept]
    inertia = sum(d for _, d, _ in last)
    return sorted(
        ((i, c, d, sum(e for _, e, o in last if o == c), inertia, points[c]) for i, d, c in last), key=str
    )


def clusters(spark, rows, **options):
    table = spark.createDataFrame(rows, VECTORS)
    found = centroids.cluster(table, **options)
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_centroids_equal_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(6)]) for i in range(120)]
    rows += [(i, list(v)) for i, v in rows[:20]]  # repeated rows
    rows += [(300 + i, list(rows[0][1])) for i in range(15)]  # ties
    rows += [(400, None), (401, [0.1] * 5), (402, [0.1] * 5 + [None]), (403, [0.1] * 5 + [float("nan")])]
    rows += [(404, [0.1] * 5 + [float("inf")]), (None, [0.2] * 6), (None, [-0.2] * 6)]
    assert clusters(spark, rows, k=7, rounds=3, dims=6) == clusters_by_hand(rows, 7, 3, 6)


def test_centroids_of_few_rows_and_large_values(spark):
    assert clusters(spark, [], dims=2) == []
    rows = [(1, [1.0, 2.0]), (2, [1e6, -1e6]), (3, [1e6 + 1, -1e6])]
    assert clusters(spark, rows, k=40, rounds=5, dims=2) == clusters_by_hand(rows, 40, 5, 2)
    far = [(1, [2.0**40, 1.0]), (2, [2.0**40 + 8, 1.0])]
    assert clusters(spark, far, k=1, rounds=2, dims=2) == clusters_by_hand(far, 1, 2, 2)
    with pytest.raises(Exception, match="range of a long"):
        clusters(spark, [(1, [1e300, 1.0])], dims=2)


def test_centroids_ignore_other_columns(spark):
    table = spark.createDataFrame([(1, [0.5], 3, 4)], "vec_id bigint, embedding array<float>, cluster int, key int")
    assert [r["cluster"] for r in centroids.cluster(table, dims=1).collect()] == [0]


def test_tables_give_distances():
    rng = np.random.default_rng(3)
    values, points = rng.integers(-200, 200, (50, 9)), rng.integers(-200, 200, (4, 9))
    direct = ((values[:, None, :] - points[None]) ** 2).sum(axis=2)
    best, distance = centroids.nearest(values, points)
    assert (best == direct.argmin(axis=1)).all() and (distance == direct.min(axis=1)).all()


# --- operator 12 -----------------------------------------------------------------------


def products_by_hand(rows, k, step):
    held = {}
    for i, v in rows:
        if i is not None and usable(v):
            held[i] = min(held.get(i, whole(v)), whole(v))
    out = []
    for q, v in held.items():
        if q % step == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in held.items() if i != q and len(w) == len(v))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def products(spark, rows, k=5, step=10, **options):
    table = spark.createDataFrame(rows, VECTORS)
    return sorted(tuple(r) for r in topk.largest_products(table, F.col("vec_id") % step == 0, k=k, **options).collect())


@pytest.mark.parametrize("shard_rows", [37, 8_192])
def test_largest_products_equal_brute_force(spark, shard_rows):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(40)]) for i in range(400)]
    rows += [(500 + i, list(rows[7][1])) for i in range(300)]  # one very common vector
    rows += [(900, [0.0] * 40), (910, []), (911, []), (920, None), (930, [None] * 40), (940, [float("nan")] * 40)]
    rows += [(950, [1.0, 2.0]), (951, [3.0, 4.0]), (None, [0.1] * 40), (3, [9.0] * 40), (960, [float("-inf")] * 40)]
    assert products(spark, rows, shard_rows=shard_rows) == products_by_hand(rows, 5, 10)


def test_largest_products_of_few_or_large_rows(spark):
    assert products(spark, []) == []
    assert products(spark, [(0, [1.0])]) == []
    rows = [(i, [float(i), -1.0]) for i in range(4)]
    assert products(spark, rows, step=1) == products_by_hand(rows, 5, 1)
    large = [(i, [2.0**18 + i, 2.0**18 - 3 * i]) for i in range(30)]
    assert products(spark, large, step=3, shard_rows=8) == products_by_hand(large, 5, 3)


def test_largest_products_carry_no_other_columns(spark):
    table = spark.createDataFrame([(0, [1.0], 9, 8), (1, [2.0], 9, 8)], VECTORS + ", rank int, score int")
    found = topk.largest_products(table, F.col("vec_id") == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert [tuple(r) for r in found.collect()] == [(0, 1, 1, 256 * 512)]


def test_bounds_drop_candidates():
    """On vectors with heavy first dimensions most pairs are dropped, and nothing is lost."""
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(2_000, 64)) * np.r_[np.full(16, 300), np.full(48, 5)]).astype(np.int64)
    shard = topk.Shard(np.arange(2_000), vectors)
    q, c, score = topk.search(shard, np.arange(5), vectors[:5], np.full(5, -np.inf), 3)
    direct = vectors[:5] @ vectors.T
    direct[np.arange(5), np.arange(5)] = -(10**9)
    assert (score.reshape(5, 3) == -np.sort(-direct, axis=1)[:, :3]).all()
    left = topk.remaining(vectors[:, shard.order].astype(float))
    assert left[0].max() < 120


# --- operator 13 -----------------------------------------------------------------------


def damaged_by_hand(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        lot = zlib.crc32(name.encode()) % 20
        if lot == 1:
            text = ""
        if lot == 2:
            text = "".join(c for c in text if c not in ".!?")
        if lot == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if lot == 0 else 2 if lot == 3 else 1)
    return out


def repaired_by_hand(conv, rows):
    """The grammar as a machine: the best edits for each of its four states, turn by turn."""
    rows = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    moves = {0: [("s", 1), ("u", 2)], 1: [("u", 2)], 2: [("a", 3)], 3: [("u", 2)]}
    role_of = {"u": "user", "a": "assistant"}
    best = {0: (0, "", ())}
    seen, counts = set(), [0, 0, 0]

    def insertions(best):
        for _ in range(2):
            for state, (cost, audit, lines) in list(best.items()):
                for letter, after in moves[state]:
                    if letter != "s":
                        new = (cost + 2, audit + "I", (*lines, role_of[letter] + ":"))
                        best[after] = min(best.get(after, new), new)

    for _, role, text in rows:
        white = text.strip(" \t\n\v\f\r")
        blank, again = white == "", (role, text) in seen
        seen.add((role, text))
        cut = not blank and not again and white[-1] not in ".!?"
        counts = [counts[0] + blank, counts[1] + (again and not blank), counts[2] + cut]
        insertions(best)
        after: dict = {}

        def put(state, new):
            after[state] = min(after.get(state, new), new)

        for state, (cost, audit, lines) in best.items():
            put(state, (cost + 3, audit + "D", lines))
            if not blank and not again:
                for letter, to in moves[state]:
                    if role[:1] == letter:
                        put(to, (cost + cut, audit + "K", (*lines, f"{role}:{text}")))
                    elif letter != "s":
                        put(to, (cost + 2 + cut, audit + "R", (*lines, f"{role_of[letter]}:{text}")))
        best = after
    insertions(best)
    cost, audit, lines = min(best[s] for s in (0, 3) if s in best)
    numbers = [r[0] for r in rows if r[0] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines


def some_turns(rng, conv, n):
    out = []
    for turn in range(n):
        role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
        text = rng.choice(["Yes.", "No!", "So", "a b ?  ", " ", None, f"t{turn}.", f"u{turn}", f"v{turn}!", f"w{turn}."])
        out.append((conv, rng.choice([turn, turn, turn, turn // 2, turn + 3, None]), role, text))
    return out


TURNS = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_repairs_equal_brute_force(spark, coalesce):
    rng = random.Random(5)
    rows = []
    for conv in range(60):
        rows += some_turns(rng, conv, rng.randint(1, 12))
    rows += some_turns(rng, 77, 150) + some_turns(rng, None, 70)  # long ones, and a null key
    rows += [(88, None, "user", "Hello."), (88, None, "assistant", "Hi."), (89, None, None, None), (90, 7, "system", "Be kind.")]
    rows += [(91, i, "user", "same.") for i in range(40)]  # repeated turns
    rng.shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        table = spark.createDataFrame(rows, TURNS)
        found = conversations.damaged_and_repaired(table)
        audits = {r["conv_id"]: tuple(r) for r in found.audits.collect()}
        turns: dict = {}
        for r in found.turns.orderBy("conv_id", "place").collect():
            turns.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
        plain = conversations.repair(table).audits.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hurt = damaged_by_hand(rows)
    for conv in {r[0] for r in rows}:
        expected, lines = repaired_by_hand(conv, hurt)
        assert audits[conv] == expected
        assert turns.get(conv, []) == list(lines)
    spaced = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert {r["conv_id"]: tuple(r) for r in plain} == {c: repaired_by_hand(c, spaced)[0] for c in {r[0] for r in rows}}


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], TURNS)
    assert conversations.damaged_and_repaired(empty).audits.count() == 0
    dropped = next(i for i in range(1_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    one = conversations.damaged_and_repaired(spark.createDataFrame([(dropped, 0, "user", "Hi.")], TURNS)).audits.collect()
    assert [tuple(r) for r in one] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repair_of_long_texts_and_clashing_columns(spark):
    rows = [(1, 0, "user", "long. " * 300_000, 5, "x"), (1, 1, "assistant", "short.", 5, "x")]
    table = spark.createDataFrame(rows, TURNS + ", part int, conv string")
    found = conversations.repair(table).audits.collect()
    assert [(r["cost"], r["audit"]) for r in found] == [(0, "KK")]


def test_align_stays_within_its_bound():
    turns = [("u", False, 0), ("u", False, 0), ("a", False, 1)]
    assert conversations.align(turns, "ua", 4, True) == (4, "DKK")
    assert conversations.align(turns, "ua", 3, True) is None
    assert conversations.repair_whole(turns) == (3, "KIKK")
