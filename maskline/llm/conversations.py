"""Repair of damaged conversations by target alignment (operator 13).

A sound conversation is empty or reads `(s?(ua)+)?` in the initials of its roles. Turns are
aligned by Wagner and Fischer's table to every target string of that grammar whose length
can still beat the best alignment so far; the incumbent's cost also bounds how far the
table's cells may leave the diagonal (Ukkonen). The cheapest backtraced edits are compared
as strings, the ASCII-least wins.

Conversations may be of any length, and one key may hold any share of the rows: rows are
put in order by a range partitioning of key and turn, which also cuts through a
conversation. Runs of SEGMENT turns of a long or cut conversation are aligned to every
target between each two states of the grammar (nothing yet, after s, after u, after a),
edits of a run ending with a turn, so that every sequence of edits has one cutting. Then a
pass over these small cost tables chooses each run's states, and the runs' edits are put
end to end. Text travels once, to its place in the order; repeated turns are found on
digests. A long conversation's repaired text is hashed run by run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskline.llm.common import ship, staged

SEGMENT = 32
# States of the grammar, and what it costs to close a conversation there.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
CLOSING = {START: "", AFTER_S: "II", AFTER_U: "I", AFTER_A: ""}
AFTER = {"s": AFTER_S, "u": AFTER_U, "a": AFTER_A}
NEXT = {START: "u", AFTER_S: "u", AFTER_U: "a", AFTER_A: "u"}
ROLE = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
LEGAL = ("su", "ua", "au")
NEVER = 1 << 40
WHITE = " \t\n\x0b\x0c\r"
PREFIX_CHARS = 32


def _lists(batches, rows: int) -> Iterator[zip]:
    """The batches' rows as tuples, some at a time, so that long texts are not all decoded at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield zip(*[c.to_pylist() for c in batch.slice(at, rows).columns])


def align(turns: list[tuple[str, bool, int]], target: str, bound: int, trailing: bool) -> tuple[int, str] | None:
    """The cheapest edits (of equals the ASCII-least) that turn `turns` into `target`, if within `bound`.

    A turn is (initial, must go, added cost if it stays). Without `trailing`, the last edit
    must consume a turn.
    """
    n, m = len(turns), len(target)
    gap = m - n
    least = INSERT * gap if gap > 0 else -DELETE * gap
    if least > bound:
        return None
    # one step beyond the diagonals between 0 and gap costs an insertion and a deletion
    slack = min((bound - least) // (INSERT + DELETE), n + m)
    low, high = min(0, gap) - slack, max(0, gap) + slack
    table: list[list[int]] = [[]] * (n + 1)
    for i in range(n, -1, -1):
        row = [NEVER] * (m + 2)
        for j in range(min(m, i + high), max(0, i + low) - 1, -1):
            if i == n and j == m:
                row[j] = 0
                continue
            best = NEVER
            if i < n:
                initial, gone, extra = turns[i]
                below = table[i + 1]
                best = DELETE + below[j]
                if j < m and not gone:
                    if initial == target[j]:
                        best = min(best, KEEP + extra + below[j + 1])
                    elif target[j] != "s":
                        best = min(best, REROLE + extra + below[j + 1])
            if j < m and target[j] != "s" and (i < n or trailing):
                best = min(best, INSERT + row[j + 1])
            row[j] = best
        table[i] = row
    cost = table[0][0]
    if cost > bound:
        return None
    edits, i, j = [], 0, 0
    while i < n or j < m:
        left = table[i][j]
        if i < n and DELETE + table[i + 1][j] == left:
            edits.append("D")
            i += 1
        elif j < m and target[j] != "s" and (i < n or trailing) and INSERT + table[i][j + 1] == left:
            edits.append("I")
            j += 1
        else:
            edits.append("K" if turns[i][0] == target[j] else "R")
            i, j = i + 1, j + 1
    return cost, "".join(edits)


def targets(state: int, longest: int) -> Iterator[tuple[str, int]]:
    """(string, state after it) of all continuations of the grammar up to a length."""
    yield "", state
    for first in ("", "s") if state == START else ("",):
        text, now = first, AFTER[first] if first else state
        if first and longest:
            yield text, now
        while len(text) < longest:
            text += NEXT[now]
            now = AFTER[text[-1]]
            yield text, now


def repair_whole(turns: list[tuple[str, bool, int]]) -> tuple[int, str]:
    """Cost and edits of a conversation that is at hand as a whole."""
    n = len(turns)
    best = (DELETE * n, "D" * n)  # the empty conversation
    longest = n + best[0] // INSERT
    ends = [t for t, state in targets(START, longest) if state == AFTER_A]
    for target in sorted(ends, key=lambda t: (abs(len(t) - n), t)):
        found = align(turns, target, best[0], True)
        if found is not None:
            best = min(best, found)
    return best


def repair_between(turns: list[tuple[str, bool, int]]) -> list[tuple[int, str] | None]:
    """The best edits for each (state before, state after), numbered 4 * before + after."""
    n = len(turns)
    out: list[tuple[int, str] | None] = [None] * 16
    # with every turn rewritten or deleted, and no more than two insertions before each
    for before in range(4):
        for target, after in sorted(targets(before, 3 * n), key=lambda t: (abs(len(t[0]) - n), t)):
            at = 4 * before + after
            found = align(turns, target, out[at][0] if out[at] else NEVER - 1, False)
            if found is not None:
                out[at] = min(out[at], found) if out[at] else found
    return out


def apply_edits(edits: str, state: int, roles: list[str], texts: list[str]) -> list[tuple[str, str]]:
    """The repaired turns (role, text) of a run that starts in `state`."""
    out, i = [], 0
    for edit in edits:
        if edit == "D":
            i += 1
            continue
        role = roles[i] if edit == "K" else ROLE[NEXT[state]]
        out.append((role, "" if edit == "I" else texts[i]))
        state = AFTER[role[0]]
        i += edit != "I"
    return out


SEGMENT_FIELDS = (
    "part int, seq bigint, done boolean, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "low bigint, high bigint, distinct_turns bigint, head string, tail string, head_turn bigint, tail_turn bigint, "
    "cost bigint, edits string, sha256 string, costs array<bigint>, ranks array<int>, pieces array<string>, "
    "roles array<string>, texts array<string>"
)


def _segment(rows: list[tuple], whole: bool) -> tuple:
    """One row of SEGMENT_FIELDS after `done` for turns (turn, role, text, blank, truncated, duplicate) in order."""
    blank = [r[3] for r in rows]
    duplicate = [r[5] and not r[3] for r in rows]
    truncated = [r[4] and not r[3] and not d for r, d in zip(rows, duplicate)]
    initials = [r[1][:1] for r in rows]
    numbers = [r[0] for r in rows if r[0] is not None]
    roles, texts = [r[1] for r in rows], [r[2] for r in rows]
    turns = [(i, b or d, int(t)) for i, b, d, t in zip(initials, blank, duplicate, truncated)]
    cost = edits = sha256 = costs = ranks = pieces = None
    if whole:
        cost, edits = repair_whole(turns)
        sha256 = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in apply_edits(edits, START, roles, texts)).encode()).hexdigest()
    else:
        best = repair_between(turns)
        costs = [b[0] if b else NEVER for b in best]
        pieces = [b[1] if b else None for b in best]
        ranks = [sorted(x for x in pieces[i // 4 * 4 : i // 4 * 4 + 4] if x is not None).index(p) if p is not None else 4 for i, p in enumerate(pieces)]
    return (
        sum(blank), sum(duplicate), sum(truncated),
        sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        min(numbers, default=None), max(numbers, default=None), len(set(numbers)),
        initials[0], initials[-1], rows[0][0], rows[-1][0],
        cost, edits, sha256, costs, ranks, pieces, roles, texts,
    )


def _cut(schema: pa.Schema):
    """Conversations, or runs of those that are long or may go on in another task, of rows in order."""

    def run(batches):
        part = TaskContext.get().partitionId()
        out: list[tuple] = []
        rows: list[tuple] = []
        seq, now, opened, first, started = 0, None, False, True, False
        place, marked, previous = None, set(), None

        def close(whole: bool) -> None:
            nonlocal seq, rows
            if rows:
                out.append((now, part, seq, whole, *_segment(rows, whole)))
                seq, rows = seq + 1, []

        def packed():
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        for some in _lists(batches, 1_000):
            for conv, turn, role, prefix, flag, text, a, b, blank, truncated in some:
                if not started or conv != now:
                    if started:
                        close(whole=not opened and not first)
                        first = False
                    now, opened, started, place, previous = conv, False, True, None, None
                if (turn, role, prefix) != place:
                    place, marked = (turn, role, prefix), set()
                if flag == 0:
                    marked.add((a, b))
                    continue
                if len(rows) == SEGMENT:
                    close(whole=False)
                    opened = True
                row = (turn, role, text)
                rows.append((*row, blank, truncated, (a, b) in marked or row == previous))
                previous = row
            if len(out) >= 100:
                yield packed()
                out.clear()
        if started:
            close(whole=False)
        if out:
            yield packed()

    return run


def _stitch(schema: pa.Schema):
    """The states each run of a conversation takes, and on its last row the conversation's figures."""

    def settle(conv, runs) -> list[tuple]:
        n = len(runs)
        # least cost from run i on, by the state before it
        onward = [[INSERT * len(CLOSING[s]) for s in range(4)]]
        for run in reversed(runs):
            costs, after = run[13], onward[-1]
            onward.append([min(costs[4 * p + q] + after[q] for q in range(4)) for p in range(4)])
        onward.reverse()
        total, state, out = onward[0][START], START, []
        low = high = None
        sums, distinct, previous = [0, 0, 0, 0], 0, None
        for i, run in enumerate(runs):
            part, seq, *counts = run[:6]
            lowest, highest, own, head, tail, head_turn, tail_turn, costs, ranks = run[6:]
            sums = [x + y for x, y in zip(sums, counts)]
            distinct += own
            if previous is not None:
                sums[3] += previous[0] + head not in LEGAL
                distinct -= head_turn is not None and head_turn == previous[1]
            previous = (tail, tail_turn)
            low = lowest if low is None else low
            high = highest if highest is not None else high
            after = min(
                (q for q in range(4) if costs[4 * state + q] + onward[i + 1][q] == onward[i][state]),
                key=lambda q: ranks[4 * state + q],
            )
            last = i == n - 1
            gaps = 0 if low is None else high - low + 1 - distinct
            figures = (gaps, *sums, total) if last else (None,) * 6
            out.append((conv, part, seq, state, 4 * state + after, CLOSING[after] if last else "", *figures))
            state = after
        return out

    def run(batches):
        now, runs, started = None, [], False

        def packed():
            cols = list(zip(*settle(now, runs)))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        for some in _lists(batches, 1_000):
            for conv, *rest in some:
                if started and conv != now:
                    yield packed()
                    runs = []
                now, started = conv, True
                runs.append(rest)
        if started:
            yield packed()

    return run


def _joined(schema: pa.Schema):
    """Audit and digest of conversations whose runs come in order."""

    def run(batches):
        now, state = None, None
        for some in _lists(batches, 100):
            out = []
            for conv, before, edits, closing, roles, texts, *figures in some:
                if state is None or conv != now:
                    now, state = conv, {"edits": [], "sha": hashlib.sha256(), "sep": ""}
                state["edits"] += [edits, closing]
                for role, text in apply_edits(edits + closing, before, roles, texts):
                    state["sha"].update(f"{state['sep']}{role}:{text}".encode())
                    state["sep"] = "\n"
                if figures[0] is not None:
                    out.append((conv, *figures, "".join(state["edits"]), state["sha"].hexdigest()))
            cols = list(zip(*out)) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return run


@dataclass(frozen=True)
class Repaired:
    """`audits`: a row per conversation. `turns`: the repaired turns, with their order in `place`."""

    audits: DataFrame
    turns: DataFrame


FIGURES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair(table: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repaired:
    """Faults, cheapest repair and repaired turns of every conversation.

    `audits` has the key, gaps, blank, duplicate, truncated, illegal, cost (longs), audit and
    sha256 (of the repaired `role:text`, newline-joined) for every key of the table, a null
    key included. Turns are taken by number, nulls first; of equal numbers by role, then
    text. A null role or text counts as one space: a null text is blank, and a null role
    fits no grammar. A turn's first fault counts: blank (white space only), duplicate (role
    and text seen before in the conversation), truncated (does not end in `.`, `!` or `?`).
    Keeping a turn is free, a new role costs 2, deletion 3, insertion 2, and a truncated turn
    that stays 1 more; blank and duplicate turns must go. Empty tables give empty results,
    other columns are not carried.
    """
    one = F.lit(" ")
    named = table.select(
        F.col(key).alias("conv"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role).cast("string"), one).alias("role"),
        F.coalesce(F.col(text).cast("string"), one).alias("text"),
    )
    return _repair(named, named.select("conv"), key)


def damage(table: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The table's turns with faults put in by the CRC-32 of `key:turn`, modulo 20.

    0 drops a turn, 1 empties its text, 2 removes its `.`, `!` and `?`, 3 repeats it, 4 makes
    its role `user`; nulls in key, turn, role and text read as one space. Columns key, turn,
    role and text; key and turn keep their nulls.
    """
    one = F.lit(" ")
    name = F.concat(F.coalesce(F.col(key).cast("string"), one), F.lit(":"), F.coalesce(F.col(turn).cast("string"), one))
    lot = F.crc32(F.encode(name, "UTF-8")) % 20
    return (
        table.select(
            F.col(key).alias("k"), F.col(turn).alias("n"), F.coalesce(F.col(role), one).alias("r"),
            F.coalesce(F.col(text), one).alias("t"), lot.alias("lot"),
        )
        .where("lot <> 0")
        .withColumn("copy", F.explode(F.when(F.col("lot") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select(
            F.col("k").alias(key),
            F.col("n").alias(turn),
            F.when(F.col("lot") == 4, "user").otherwise(F.col("r")).alias(role),
            F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.translate("t", ".!?", "")).otherwise(F.col("t")).alias(text),
        )
    )


def _flags(text: str) -> tuple[Column, Column]:
    """(blank, truncated)"""
    ended = F.rtrim(F.col(text), F.lit(WHITE))
    return ended == "", ~F.substring(ended, -1, 1).isin(".", "!", "?")


def _repair(rows: DataFrame, keys: DataFrame, key: str) -> Repaired:
    spark = rows.sparkSession
    ship(spark)
    kind = rows.schema["conv"].dataType.simpleString()
    blank, truncated = _flags("text")
    place = ["conv", "turn", "role", "prefix"]
    digests = [F.xxhash64(F.lit(i), "role", "text").alias(f"digest{i}") for i in (0, 1)]
    rows = rows.select(
        "conv", "turn", "role", F.substring("text", 1, PREFIX_CHARS).alias("prefix"), F.lit(1).alias("flag"), "text", *digests,
        blank.alias("blank"), truncated.alias("truncated"),
    )

    # Where a turn was seen at an earlier number: small rows, put just before their turns.
    told = ["conv", "digest0", "digest1"]
    slim = rows.where("not blank").select(*place, "digest0", "digest1")
    seen = (
        slim.groupBy(*told)
        .agg(F.count(F.lit(1)).alias("n"), F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("unnumbered"))
        .where("n > 1")
        .select(F.col("conv").alias("c"), F.col("digest0").alias("d0"), F.col("digest1").alias("d1"), "least", "unnumbered")
    )
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest0") == F.col("d0")) & (F.col("digest1") == F.col("d1"))
    earlier = F.when(F.col("unnumbered"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("least"))
    marks = staged(slim.join(seen, same).where(earlier).select(*place, "digest0", "digest1").distinct(), "repeated-turns")
    marks = marks.select(
        *place, F.lit(0).alias("flag"), F.lit(None).cast("string").alias("text"), "digest0", "digest1",
        F.lit(False).alias("blank"), F.lit(False).alias("truncated"),
    )

    ordered = rows.union(marks).repartitionByRange(*place).sortWithinPartitions(*place, "flag", "text")
    cut_schema = f"conv {kind}, {SEGMENT_FIELDS}"
    runs = staged(ordered.mapInArrow(_cut(_arrow(cut_schema)), cut_schema), "conversation-runs")

    slim_run = [
        "conv", "part", "seq", "blank", "duplicate", "truncated", "illegal", "low", "high", "distinct_turns",
        "head", "tail", "head_turn", "tail_turn", "costs", "ranks",
    ]
    order = ["conv", "part", "seq"]
    figures = ", ".join(f"{c} bigint" for c in FIGURES)
    chosen_schema = f"conv {kind}, part int, seq bigint, before int, choice int, closing string, {figures}"
    chosen = staged(
        runs.where("not done").select(*slim_run).repartition("conv").sortWithinPartitions(*order)
        .mapInArrow(_stitch(_arrow(chosen_schema)), chosen_schema),
        "run-states",
    )
    open_runs = chosen.join(runs.where("not done").select("part", "seq", "pieces", "roles", "texts"), ["part", "seq"]).select(
        *order, "before", F.get("pieces", F.col("choice")).alias("edits"), "closing", "roles", "texts", *FIGURES
    )
    audit_schema = f"conv {kind}, {figures}, audit string, sha256 string"
    long_ones = (
        open_runs.repartition("conv").sortWithinPartitions(*order).drop("part", "seq")
        .mapInArrow(_joined(_arrow(audit_schema)), audit_schema)
    )
    gaps = F.when(F.col("low").isNull(), F.lit(0)).otherwise(F.col("high") - F.col("low") + 1 - F.col("distinct_turns"))
    short_ones = runs.where("done").select(
        "conv", gaps.cast("bigint").alias("gaps"), *FIGURES[1:], F.col("edits").alias("audit"), "sha256"
    )
    found = short_ones.union(long_ones).withColumnRenamed("conv", "c")
    nothing = hashlib.sha256(b"").hexdigest()
    audits = keys.distinct().join(found, F.col("conv").eqNullSafe(F.col("c")), "left").select(
        F.col("conv").alias(key),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in FIGURES],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(nothing)).alias("sha256"),
    )

    turns_schema = f"conv {kind}, part int, seq bigint, turns array<struct<role:string,text:string>>"
    turns_arrow = _arrow(turns_schema)

    def rebuilt(batches):
        for some in _lists(batches, 100):
            conv, part, seq, before, edits, roles, texts = zip(*some)
            new = [[{"role": r, "text": t} for r, t in apply_edits(*x)] for x in zip(edits, before, roles, texts)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((conv, part, seq, new), turns_arrow)], schema=turns_arrow)

    every = runs.where("done").select(*order, F.lit(START).alias("before"), "edits", "roles", "texts").union(
        open_runs.select(*order, "before", F.concat("edits", "closing").alias("edits"), "roles", "texts")
    )
    turns = every.mapInArrow(rebuilt, turns_schema).select(
        F.col("conv").alias(key), "part", "seq", F.posexplode("turns").alias("i", "turn")
    ).select(key, F.struct("part", "seq", "i").alias("place"), "turn.role", "turn.text")
    return Repaired(audits, turns)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def damaged_and_repaired(table: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repaired:
    """`repair` of `damage`; keys of the undamaged table that lost every turn are listed, too."""
    names = {"key": key, "turn": turn, "role": role, "text": text}
    rows = damage(table, **names).select(
        F.col(key).alias("conv"), F.col(turn).cast("bigint").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
    )
    return _repair(rows, table.select(F.col(key).alias("conv")), key)
