"""Spans of a text as array expressions: find, check, score, untangle, rewrite.

Offsets count code points and are half open. Every function takes and returns
SQL text and can be used inside a lambda as well.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from maskline.catalog import PATTERNS, Detector
from maskline.functions import sql as Q

# `substring` walks a string from its start. Texts are therefore cut into
# chunks first, so that many cuts in one long text stay linear.
CHUNK_BITS = 12
CHUNK = 1 << CHUNK_BITS
# How far to look back for context words before reading everything before a match.
NEARBY = (128, 4096)
# White space as patterns know it, and what a text with single spaces alone does not hold.
BLANK = re.compile(r"[ \t\n\x0b\f\r]")
UNEVEN = r"[\t\n\x0B\f\r]|  "

TOKEN_PATTERN = r"\[[A-Z_]+_\d+\]"
# Matches are found by putting this character around them and splitting there:
# one pass of the pattern gives values and gaps. Texts that hold it are read
# with SUBSTITUTE in its place, and their values are cut from the source.
MARK = "\ue001"
SUBSTITUTE = "\ue002"
# Between the matches of several patterns at one place; no pattern of TOGETHER matches it.
SEPARATOR = "\ue003"
# The catalog's patterns that are searched in one pass: they have no groups, begin with START and never match again
# inside one of their own matches. (Functions are nested no deeper than needed: Spark resolves a level a round, in 100.)
START = r"(?=[\dA-Z])(?<![\p{L}\p{N}_])"
TOGETHER = frozenset(r for n, r in PATTERNS.items() if n not in ("email", "pl_nip", "pl_phone", "credit_card"))
# Type of the tokens that stand for token strings a source text already holds.
LITERAL = "LITERAL"
# A private-use character: neither letter nor digit, so word edges hold beside it.
MASK = "\ue000"

FINDING_TYPE = (
    "array<struct<start:int,end:int,rank:int,detector:string,entity:string,pii_type:string,"
    "value:string,pattern_score:double,score:double>>"
)
CANDIDATE_TYPE = "array<struct<start:int,end:int,rank:int,value:string,valid:boolean>>"
HIT_TYPE = "array<struct<rank:int,parts:array<string>>>"
PLACE_TYPE = "array<struct<start:int,end:int,value:string>>"


def empty(kind: str) -> str:
    return f"cast(array() as {kind})"


def chunks_of(text: str) -> str:
    pattern = Q.text(rf"(?s).{{1,{CHUNK}}}")
    return f"if(length({text}) <= {CHUNK}, array({text}), regexp_extract_all({text}, {pattern}, 0))"


def cut(chunks: str, start: str, end: str) -> str:
    """`text[start:end]` of a chunked text."""
    first = f"shiftright({start}, {CHUNK_BITS})"
    count = f"shiftright({end}, {CHUNK_BITS}) - {first} + 1"
    offset = f"{start} - shiftleft({first}, {CHUNK_BITS})"
    covered = f"array_join(slice({chunks}, {first} + 1, {count}), '')"
    return f"substring({covered}, {offset} + 1, {end} - {start})"


def _placed(matches: str, gaps: str) -> str:
    """Offsets of matches from the text between them."""
    steps = Q.zip_with(
        f"slice({gaps}, 1, size({matches}))", matches, lambda gap, m: f"length({gap}) + length({m})"
    )
    return Q.zip_with(
        matches,
        Q.running(steps, lambda a, b: f"{a} + {b}"),
        lambda m, end: Q.struct(start=f"{end} - length({m})", end=end, value=m),
    )


def _parts(text: str, regex: str) -> str:
    """Alternating gaps and matches; a single part when nothing matches."""
    return (
        f"split(regexp_replace({text}, {regex}, {Q.text(MARK + '$0' + MARK)}), {Q.text(MARK)}, -1)"
    )


def _matches(parts: str, body: Callable[[str, str, str], str]) -> str:
    """`body(start, end, value)` for every match in at least three parts."""
    return Q.let(
        Q.running(Q.transform(parts, lambda p: f"length({p})"), lambda a, b: f"{a} + {b}"),
        lambda ends: Q.transform(
            f"sequence(1, size({parts}) - 2, 2)",
            lambda i: body(f"get({ends}, {i} - 1)", f"get({ends}, {i})", f"get({parts}, {i})"),
        ),
    )


def _starting(clean: str, regexes: Sequence[str], body: Callable[[str, str, str], str]) -> str:
    """`body(start, value, i)` wherever the `i`-th pattern matches, whatever the others do there.

    One pass: every place where some pattern matches gets the matches of all of them put
    before it, between marks. The patterns have no groups and begin with START.
    """
    tried = "".join(rf"(?=({r})|)" for r in regexes)
    some = "|".join(rf"\{i}" for i in range(1, len(regexes) + 1))
    shown = MARK + SEPARATOR.join(f"${i}" for i in range(1, len(regexes) + 1)) + MARK
    regex = Q.text(rf"{START}{tried}(?={some})")
    parts = f"split(regexp_replace({clean}, {regex}, {Q.text(shown)}), {Q.text(MARK)}, -1)"

    def of_parts(parts: str) -> str:
        gaps = Q.transform(f"sequence(0, size({parts}) - 3, 2)", lambda i: f"length(get({parts}, {i}))")
        placed = Q.transform_indexed(
            Q.running(gaps, lambda a, b: f"{a} + {b}"),
            lambda start, k: Q.let(
                f"split(get({parts}, 2 * {k} + 1), {Q.text(SEPARATOR)}, -1)",
                lambda values: Q.transform(
                    Q.keep(f"sequence(0, {len(regexes) - 1})", lambda i: f"get({values}, {i}) != ''"),
                    lambda i: body(start, f"get({values}, {i})", i),
                ),
            ),
        )
        return f"if(size({parts}) < 3, {empty(CANDIDATE_TYPE)}, flatten({placed}))"

    return Q.let(parts, of_parts)


def _spoken(lang: str, langs: Sequence[str]) -> str:
    return f"coalesce({lang} in ({', '.join(Q.text(x) for x in langs)}), false)"


def tokens_in(text: str) -> str:
    """Token strings of a text: array<struct<start,end,value>>."""
    clean = f"replace({text}, {Q.text(MARK)}, {Q.text(SUBSTITUTE)})"
    placed = Q.let(
        _parts(clean, Q.text(TOKEN_PATTERN)),
        lambda parts: f"if(size({parts}) < 3, {empty(PLACE_TYPE)}, "
        + _matches(parts, lambda start, end, value: Q.struct(start=start, end=end, value=value))
        + ")",
    )
    return f"if(contains({text}, '['), {placed}, {empty(PLACE_TYPE)})"


def literals(text: str) -> str:
    """Token strings of a source text as findings that win every overlap."""
    return Q.transform(
        tokens_in(text),
        lambda t: Q.struct(
            start=f"{t}.start",
            end=f"{t}.end",
            rank="-1",
            detector="'literal'",
            entity=Q.text(LITERAL),
            pii_type=Q.text(LITERAL),
            value=f"{t}.value",
            pattern_score="double(2)",
            score="double(2)",
        ),
    )


def masked(text: str, spans: str) -> str:
    """The text with the spans blanked out, at the same length."""
    blanks = Q.transform(
        spans,
        lambda s: Q.struct(
            start=f"{s}.start", end=f"{s}.end", token=f"repeat({Q.text(MASK)}, {s}.end - {s}.start)"
        ),
    )
    return f"if(size({spans}) = 0, {text}, {rewrite(text, blanks)})"


def mentions_token(text: str) -> str:
    return f"(contains({text}, '[') and {text} rlike {Q.text(TOKEN_PATTERN)})"


def _by_gate(rows: Sequence[Detector]) -> dict[str | None, list[Detector]]:
    """Detectors grouped by the first of their hints."""
    gates: dict[str | None, list[Detector]] = {}
    for d in rows:
        gates.setdefault(d.hint[0] if d.hint else None, []).append(d)
    return gates


def gated(text: str, rows: Sequence[Detector]) -> str:
    """True wherever a detector could match, by first hints only; never null."""
    tests = [_hint(text, gate) for gate in _by_gate(rows)] or ["false"]
    return f"coalesce({' or '.join(tests)}, false)"


def hinted(text: str, rows: Sequence[Detector]) -> str:
    """True wherever a detector could match, by all hints; never null."""
    tests = []
    for gate, group in _by_gate(rows).items():
        rest = [_hints(text, d.hint[1:]) for d in group]
        tests.append(f"({_hint(text, gate)} and ({' or '.join(dict.fromkeys(rest))}))")
    return f"coalesce({' or '.join(tests or ['false'])}, false)"


def _hint(text: str, hint: str | None) -> str:
    if hint is None:
        return "true"
    if hint.startswith("="):
        return f"contains({text}, {Q.text(hint[1:])})"
    return f"{text} rlike {Q.text(hint)}"


def _hints(text: str, hints: Sequence[str]) -> str:
    return f"({' and '.join(_hint(text, h) for h in hints) or 'true'})"


def merged(rows: Sequence[Detector]) -> list[tuple[Detector, list[str]]]:
    """The same detector listed for several languages runs once."""
    found: dict[tuple, tuple[Detector, list[str]]] = {}
    for d in rows:
        key = (d.name, d.regex, d.pii_type, d.entity, d.score, d.context, d.valid)
        found.setdefault(key, (d, []))[1].append(d.lang)
    return list(found.values())


def candidates(text: str, lang: str, rows: Sequence[Detector]) -> str:
    """Shape matches with the outcome of their checksum in `valid`."""
    ranked = merged(rows)
    if not ranked:
        return empty(CANDIDATE_TYPE)
    checked = "".join(
        f" when {rank} then coalesce({d.valid.replace('{}', '%s')}, false)"
        for rank, (d, _) in enumerate(ranked)
        if d.valid is not None
    )

    def candidate(rank: str, start: str, end: str, value: str) -> str:
        def of(v: str) -> str:
            test = f"case {rank}{checked.replace('%s', v)} else true end" if checked else "true"
            return Q.struct(start=start, end=end, rank=rank, value=v, valid=test)

        return Q.let(value, of)

    def search(clean: str) -> str:
        def hit(rank: int, d: Detector, langs: list[str]) -> str:
            parts = f"if({_spoken(lang, langs)}, {_parts(clean, Q.text(d.regex))}, array(''))"
            return Q.struct(rank=str(rank), parts=parts)

        def alone(found: str) -> str:
            placed = Q.transform(
                Q.keep(found, lambda h: f"size({h}.parts) > 2"),
                lambda h: _matches(
                    f"{h}.parts", lambda start, end, value: candidate(f"{h}.rank", start, end, value)
                ),
            )
            return f"flatten({placed})"

        def together(group: list[int]) -> str:
            """The candidates of several detectors from one pass over the text."""
            langs = ranked[group[0]][1]
            gates = dict.fromkeys(ranked[r][0].hint[0] if ranked[r][0].hint else None for r in group)
            test = f"{_spoken(lang, langs)} and ({' or '.join(_hint(clean, gate) for gate in gates)})"
            ranks = Q.array(str(r) for r in group)
            at_once = _starting(
                clean,
                [ranked[r][0].regex for r in group],
                lambda start, value, i: candidate(f"get({ranks}, {i})", start, f"{start} + length({value})", value),
            )

            return f"if({test}, {at_once}, {empty(CANDIDATE_TYPE)})"

        by_langs: dict[tuple[str, ...], list[int]] = {}
        for rank, (d, langs) in enumerate(ranked):
            if d.regex in TOGETHER:
                by_langs.setdefault(tuple(langs), []).append(rank)
        groups = [g for g in by_langs.values() if len(g) > 1]
        joined = {r for g in groups for r in g}
        single = [(rank, d, langs) for rank, (d, langs) in enumerate(ranked) if rank not in joined]
        place = {id(d): (rank, d, langs) for rank, d, langs in single}
        hits = [
            f"if({_hint(clean, gate)}, {Q.array(hit(*place[id(d)]) for d in group)}, {empty(HIT_TYPE)})"
            for gate, group in _by_gate([d for _, d, _ in single]).items()
        ]
        found = [together(g) for g in groups]
        if hits:
            found.append(alone(f"concat({', '.join(hits)})"))
        return Q.keep(f"concat({', '.join(found)})", lambda c: f"{c}.end > {c}.start")

    mark = Q.text(MARK)

    def from_source(found: str) -> str:
        recut = Q.transform(
            found,
            lambda c: candidate(
                f"{c}.rank", f"{c}.start", f"{c}.end", f"substring({text}, {c}.start + 1, {c}.end - {c}.start)"
            ),
        )
        return f"if(contains({text}, {mark}), {recut}, {found})"

    clean = f"replace({text}, {mark}, {Q.text(SUBSTITUTE)})"
    return Q.let(Q.let(clean, search), from_source)


def words_before(text: str, chunks: str, plain: str, start: str, window: int) -> str:
    """The last `window` white-space separated words before an offset, in lower case, joined by spaces.

    A nearby stretch is enough when it holds more words than asked for; only
    otherwise is a longer one read, and in the end the whole preceding text. `plain` says
    that the text has no white space but single spaces.
    """

    def read(left: str) -> str:
        before = f"if(size({chunks}) = 1, substring({text}, {left} + 1, {start} - ({left})), {cut(chunks, left, start)})"
        return f"trim(if({plain}, {before}, regexp_replace({before}, {Q.text(chr(92) + 's+')}, ' ')))"

    def nearest(words: str) -> str:
        return f"substring_index({words}, ' ', -{window})"

    enough = nearest(read("0"))
    for near in reversed(NEARBY):
        farther = enough
        enough = Q.let(
            read(f"greatest({start} - {near}, 0)"),
            lambda ws: f"if({start} <= {near} or length({nearest(ws)}) < length({ws}), {nearest(ws)}, {farther})",
        )
    return f"lower({enough})"


def findings(
    text: str, lang: str, rows: Sequence[Detector], *, boost: float = 0.35, window: int = 5
) -> str:
    """All accepted findings of a text, unordered and possibly overlapping."""
    ranked = [d for d, _ in merged(rows)]
    if not ranked:
        return empty(FINDING_TYPE)
    accepted = Q.keep(candidates(text, lang, rows), lambda c: f"{c}.valid")

    def per_rank(rank: str, values: list[str]) -> str:
        return f"get({Q.array(values)}, {rank})"

    # words have no white space inside: a context that has some supports nothing
    contexts = [
        f"cast({Q.array(Q.text(w.lower()) for w in d.context if not BLANK.search(w))} as array<string>)" for d in ranked
    ]

    def scored(near: tuple[str, str] | None, f: str) -> str:
        base = per_rank(f"{f}.rank", [f"double({d.score!r})" for d in ranked])
        score = base
        if near is not None:
            supported = Q.let(
                words_before(text, *near, f"{f}.start", window),
                lambda words: Q.exists(
                    per_rank(f"{f}.rank", contexts), lambda c: f"contains({words}, {c})"
                ),
            )
            score = f"if({supported}, least(double(1), {base} + double({boost!r})), {base})"
        return Q.struct(
            start=f"{f}.start",
            end=f"{f}.end",
            rank=f"{f}.rank",
            detector=per_rank(f"{f}.rank", [Q.text(d.name) for d in ranked]),
            entity=per_rank(f"{f}.rank", [Q.text(d.entity) for d in ranked]),
            pii_type=per_rank(f"{f}.rank", [Q.text(d.pii_type) for d in ranked]),
            value=f"{f}.value",
            pattern_score=base,
            score=score,
        )

    def scored_all(items: str) -> str:
        if boost == 0 or not any(d.context for d in ranked):
            return Q.transform(items, lambda f: scored(None, f))
        words = dict.fromkeys(w.lower() for d in ranked for w in d.context)
        in_context = Q.let(
            f"lower({text})", lambda low: f"({' or '.join(f'contains({low}, {Q.text(w)})' for w in words)})"
        )
        near = Q.let(
            Q.struct(chunks=chunks_of(text), plain=f"not ({text} rlike {Q.text(UNEVEN)})"),
            lambda cuts: Q.transform(items, lambda f: scored((f"{cuts}.chunks", f"{cuts}.plain"), f)),
        )
        return f"if({in_context}, {near}, {Q.transform(items, lambda f: scored(None, f))})"

    return Q.let(accepted, lambda a: f"if(size({a}) = 0, {empty(FINDING_TYPE)}, {scored_all(a)})")


def untangle(spans: str) -> str:
    """Drop overlaps: higher score, longer, further left, earlier detector wins.

    Returns the survivors in text order. Only spans that hang together through
    overlaps are compared with one another.
    """

    def overlap(a: str, b: str) -> str:
        return f"{a}.start < {b}.end and {b}.start < {a}.end"

    def greedy(group: str) -> str:
        # Survivors are filed by their place in text order, in about root(n) shelves of root(n)
        # places (a small group has one shelf). They do not overlap, so shelves follow one another, and a span meets no
        # survivor of a shelf that ends before it or begins behind it.
        def by_rank(width: str) -> str:
            return "sort_array(" + Q.transform_indexed(
                group,
                lambda s, i: Q.struct(
                    a=f"-{s}.score",
                    b=f"{s}.start - {s}.end",
                    c=f"{s}.start",
                    d=f"{s}.rank",
                    shelf=f"cast({i} div {width} as int)",
                    span=s,
                ),
            ) + ")"

        def taken(shelves: str, x: str) -> str:
            return Q.exists(
                shelves,
                lambda h: f"{h}.start < {x}.span.end and {x}.span.start < {h}.end and "
                + Q.exists(f"{h}.kept", lambda k: overlap(k, f"{x}.span")),
            )

        def filed(shelves: str, x: str) -> str:
            return Q.transform_indexed(
                shelves,
                lambda h, i: f"if({i} = {x}.shelf, "
                + Q.struct(
                    start=f"least({h}.start, {x}.span.start)",
                    end=f"greatest({h}.end, {x}.span.end)",
                    kept=f"array_append({h}.kept, {x}.span)",
                )
                + f", {h})",
            )

        def settled(width: str) -> str:
            bare = Q.struct(start="2147483647", end="-1", kept=Q.keep(group, lambda _: "false"))
            shelves = Q.aggregate(
                by_rank(width),
                f"array_repeat({bare}, cast((size({group}) - 1) div {width} as int) + 1)",
                lambda acc, x: f"if({taken(acc, x)}, {acc}, {filed(acc, x)})",
            )
            return "flatten(" + Q.transform(shelves, lambda h: f"sort_array({h}.kept)") + ")"

        small = f"size({group}) <= {Q.BLOCK}"
        return Q.let(f"if({small}, size({group}), cast(ceil(sqrt(size({group}))) as int))", settled)

    def pair(group: str) -> str:
        """Of two spans that overlap, in text order, the one that wins."""

        def place(s: str) -> str:
            return Q.struct(a=f"-{s}.score", b=f"{s}.start - {s}.end", c=f"{s}.start", d=f"{s}.rank")

        second = f"{place(f'get({group}, 1)')} < {place(f'get({group}, 0)')}"
        return f"slice({group}, if({second}, 2, 1), 1)"

    def by_group(a: str) -> str:
        heads = Q.let(
            Q.running(Q.transform(a, lambda s: f"{s}.end"), lambda x, y: f"greatest({x}, {y})"),
            lambda reach: Q.keep(
                f"sequence(0, size({a}) - 1)",
                lambda i: f"{i} = 0 or get({a}, {i}).start >= get({reach}, {i} - 1)",
            ),
        )
        groups = Q.let(
            heads,
            lambda hs: Q.transform_indexed(
                hs,
                lambda head, i: f"slice({a}, {head} + 1, coalesce(get({hs}, {i} + 1), size({a})) - {head})",
            ),
        )
        settled = Q.transform(
            groups, lambda g: f"case size({g}) when 1 then {g} when 2 then {pair(g)} else {greedy(g)} end"
        )
        return f"flatten({settled})"

    def tangled(a: str) -> str:
        neighbours = Q.zip_with(
            f"slice({a}, 1, size({a}) - 1)",
            f"slice({a}, 2, size({a}) - 1)",
            lambda x, y: f"{y}.start < {x}.end",
        )
        return Q.exists(neighbours, lambda hit: hit)

    return Q.let(
        f"sort_array({spans})",
        lambda a: f"case when size({a}) < 2 then {a} when not {tangled(a)} then {a} "
        f"else {by_group(a)} end",
    )


def rewrite(text: str, spans: str) -> str:
    """Replace each span by its `token`; spans are sorted and do not overlap."""

    def joined(s: str, chunks: str) -> str:
        pieces = Q.transform_indexed(
            s,
            lambda x, i: "concat("
            + Q.let(
                f"coalesce(get({s}, {i} - 1).end, 0)", lambda left: cut(chunks, left, f"{x}.start")
            )
            + f", {x}.token)",
        )
        tail = Q.let(f"{Q.last(s)}.end", lambda left: cut(chunks, left, f"length({text})"))
        return f"concat(array_join({pieces}, ''), {tail})"

    return Q.let(spans, lambda s: Q.let(chunks_of(text), lambda chunks: joined(s, chunks)))


def mask_known(text: str, known: str) -> str:
    """Blank out known values in list order: struct<text, spans>.

    `known` is array<struct<seq,value,pii_type>>, sorted. A masked stretch keeps
    its length, so later offsets still refer to the source text.
    """

    def step(acc: str, k: str) -> str:
        # Quote for a regex; a \E inside the value is spelled out between two quotes.
        quoted = (
            f"concat({Q.text(chr(92) + 'Q')}, replace({k}.value, {Q.text(chr(92) + 'E')}, "
            f"{Q.text(chr(92) + 'E' + chr(92) * 2 + 'E' + chr(92) + 'Q')}), {Q.text(chr(92) + 'E')})"
        )
        places = Q.let(
            f"split({acc}.text, {quoted}, -1)",
            lambda gaps: Q.let(
                f"array_repeat({k}.value, size({gaps}) - 1)", lambda m: _placed(m, gaps)
            ),
        )
        spans = Q.transform(
            places,
            lambda p: Q.struct(
                start=f"{p}.start",
                end=f"{p}.end",
                rank="-1",
                detector="'known'",
                entity=f"{k}.pii_type",
                pii_type=f"{k}.pii_type",
                value=f"{k}.value",
                pattern_score="double(1)",
                score="double(1)",
            ),
        )
        blank = f"repeat({Q.text(MASK)}, length({k}.value))"
        masked = Q.struct(
            text=f"replace({acc}.text, {k}.value, {blank})",
            spans=f"cast(concat({acc}.spans, {spans}) as {FINDING_TYPE})",
        )
        return f"if({k}.value != '' and contains({acc}.text, {k}.value), {masked}, {acc})"

    none = Q.keep(known, lambda _: "false")
    start = Q.struct(text=text, spans=empty(FINDING_TYPE))
    return Q.aggregate(f"coalesce({known}, {none})", start, step)
