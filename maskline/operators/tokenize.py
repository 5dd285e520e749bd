"""Replace identifiers by tokens, and tokens by identifiers.

Texts, whole cells of typed columns and string leaves of nested columns all go
the same way: spans with a path are found in the row, tokens are attached to
the spans, and the spans come back to their row once. Only the compact span
table travels for the token look-up; a text moves at most once, and only when
a cheap test says it may hold something to replace.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskline.catalog import HINTS, Detector, only
from maskline.functions import spans as S
from maskline.functions import sql as Q
from maskline.functions.leaves import JsonText, has_text, leaves, rebuilt
from maskline.operators.detect import BOOST, WINDOW, routed
from maskline.operators.lookup import likely, salted_join
from maskline.operators.mapping import MAPPING_COLUMNS, VALUE_KEY, parse_tokens
from maskline.operators.mapping import allocate as new_entries
from maskline.sources.staging import stage
from maskline.sources.token_store import TOKEN_KEY, TokenStore

SPAN_TYPE = "array<struct<path:string,start:int,end:int,entity:string,pii_type:string,value:string>>"
CORPUS = "corpus"


@dataclass(frozen=True)
class Tokenized:
    """`table`: the rewritten input. `mapping`: all entries, of which `new` were added
    by this run. `spans`: what was found.
    """

    table: DataFrame
    mapping: DataFrame
    spans: DataFrame
    new: DataFrame | None = None


def _columns(df: DataFrame, names: Iterable[str], json: Sequence[str] = ()) -> list[tuple[str, T.DataType, str]]:
    """Present columns with their type and root path; absent ones are skipped."""
    kinds = {f.name: JsonText() if f.name in json and _is_text(f.dataType) else f.dataType for f in df.schema.fields}
    return [(n, kinds[n], f"'{i}'") for i, n in enumerate(names) if n in kinds]


def _is_text(kind: T.DataType) -> bool:
    return isinstance(kind, T.StringType)


def _all_leaves(columns) -> str:
    return f"concat({', '.join(leaves(Q.name(n), kind, path) for n, kind, path in columns)})"


def _any_leaf(columns, test: Callable[[str], str], raw: bool = False) -> Column:
    """True where some string in the columns passes `test`; never null.

    With `raw`, JSON is not parsed but tested as it is written, where what `test` looks for
    shows unless it is escaped: it may be true where no string passes, never the other way.
    """

    def of(n: str, kind: T.DataType, path: str) -> str:
        if _is_text(kind):
            return test(Q.name(n))
        if raw and isinstance(kind, JsonText):
            return f"(contains({Q.name(n)}, {Q.text(chr(92))}) or {test(Q.name(n))})"
        return Q.exists(leaves(Q.name(n), kind, path), lambda leaf: test(f"{leaf}.text"))

    return F.expr(f"coalesce({' or '.join(of(*c) for c in columns)}, false)")


def _shows_in_json(rows: Sequence[Detector]) -> bool:
    """Whether the hints of the detectors hold for a JSON text if they hold for one of its strings."""
    return all(h.startswith("=") or h in HINTS.get(d.name, ()) for d in rows for h in d.hint)


ROW = ["_row_a", "_row_b"]


def _with_row(df: DataFrame, key: Sequence[str], columns, scope: Column) -> DataFrame:
    """Add what identifies a row's work: 96 bits of its key, its scope and its strings.

    Keys may be null or repeated: rows that agree in all of it have the same spans and
    the same result. Every span carries these bits through two shuffles, where they are
    most of what it takes; among 10^10 rows, two share them with probability 6e-10.
    """
    # JSON is known by its text: to list its strings takes a parse
    whole = [c for c in columns if isinstance(c[1], JsonText) or len(columns) == 1 and _is_text(c[1])]
    strings = [F.col(Q.name(n)) for n, _, _ in whole]
    if len(whole) < len(columns):
        strings.append(F.expr(_all_leaves([c for c in columns if c not in whole])))
    parts = [*[F.col(Q.name(k)) for k in key], *[F.col(Q.name(k)).isNull() for k in key], scope, *strings]
    long, short = (F.xxhash64(F.lit(i), *parts) for i in range(2))
    return df.withColumns(dict(zip(ROW, (long, F.shiftright(short, 32).cast("int")))))


def scan(
    df: DataFrame,
    rows: Sequence[Detector],
    *,
    key: Sequence[str],
    free_text: Sequence[str],
    typed: dict[str, str],
    lang: Column | str,
    scope: Column,
    known: str | None = None,
    known_first: bool = True,
    escape: bool = True,
    min_score: float | None = None,
    unknown_lang: str = "error",
    json: Sequence[str] = (),
    boost: float = BOOST,
    window: int = WINDOW,
) -> DataFrame:
    """One narrow pass: key, scope, spans to replace, token strings already present.

    Only strings that pass the detectors' first hints are looked at closely. There
    is no filter on the result: Spark would push it down and search twice.
    """
    cells = _columns(df, [*typed, *free_text], json)
    spoken, strange, rows = routed(lang, rows, unknown_lang)

    def detected(text: str) -> str:
        found = S.findings(text, "_lang", rows, boost=boost, window=window)
        if min_score is not None:
            found = Q.keep(found, lambda f: f"{f}.score >= double({min_score!r})")
        return f"concat({found}, {S.literals(text)})" if escape else found

    def of_text(text: str) -> str:
        if known is None:
            return S.untangle(detected(text))
        if not known_first:
            return Q.let(
                S.untangle(detected(text)),
                lambda d: Q.let(
                    S.mask_known(S.masked(text, d), Q.name(known)), lambda m: f"sort_array(concat({d}, {m}.spans))"
                ),
            )
        return Q.let(
            S.mask_known(text, Q.name(known)),
            lambda m: S.untangle(f"concat({m}.spans, {detected(f'{m}.text')})"),
        )

    def of_leaf(leaf: str) -> str:
        return Q.transform(
            of_text(f"{leaf}.text"),
            lambda f: Q.struct(
                path=f"{leaf}.path",
                start=f"{f}.start",
                end=f"{f}.end",
                entity=f"{f}.entity",
                pii_type=f"{f}.pii_type",
                value=f"{f}.value",
            ),
        )

    parts, seen = [], S.empty("array<string>")
    texts = [c for c in cells if c[0] not in typed]
    if texts:
        parts.append(f"flatten({Q.transform(_all_leaves(texts), of_leaf)})")
        if not escape:
            present = Q.transform(
                _all_leaves(texts),
                lambda leaf: Q.transform(S.tokens_in(f"{leaf}.text"), lambda t: f"{t}.value"),
            )
            seen = f"array_distinct(flatten({present}))"
    for column, kind, path in cells:
        if column in typed and _is_text(kind):
            cell = Q.struct(
                path=path,
                start="0",
                end=f"length({Q.name(column)})",
                entity=Q.text(typed[column]),
                pii_type=Q.text(typed[column]),
                value=Q.name(column),
            )
            parts.append(f"if({Q.name(column)} != '', array({cell}), {S.empty(SPAN_TYPE)})")
    spans = f"concat({', '.join([S.empty(SPAN_TYPE), *parts])})"
    # strings inside a column are listed once: a filter on them would build and walk the column twice
    if known is None and not typed and texts and not any(has_text(kind) and not _is_text(kind) for _, kind, _ in texts):
        df = df.where(_any_leaf(texts, lambda t: f"({S.gated(t, rows)} or contains({t}, '['))") | strange)
    return _with_row(df, key, cells, scope).withColumns({"_lang": spoken, "_scope": scope}).select(
        *key,
        *ROW,
        "_scope",
        F.expr(f"cast({spans} as {SPAN_TYPE})").alias("_spans"),
        F.expr(seen).alias("_seen"),
    )


def _put_back(
    df: DataFrame,
    key: Sequence[str],
    columns,
    spans: DataFrame,
    may_change: Column | None,
    scope: Column,
    hashed,
    unique: bool = False,
) -> DataFrame:
    """Rewrite the columns of `df` by `spans` (row, path, start, end, token).

    Rows that cannot change never meet the join: their texts are not shuffled. With
    `unique`, two different strings for one place are an error.
    """
    new = F.sort_array(F.collect_set(F.struct("path", "start", "end", "token")))
    per_row = spans.groupBy(*ROW).agg(new.alias("_new"))
    if unique:
        twice = Q.zip_with(
            "slice(_new, 1, size(_new) - 1)",
            "slice(_new, 2, size(_new) - 1)",
            lambda x, y: f"{x}.path = {y}.path and {x}.start = {y}.start",
        )
        checked = f"if({Q.exists(twice, lambda hit: hit)}, raise_error('a token stands for two values'), _new)"
        per_row = per_row.withColumn("_new", F.expr(checked))
    plain = len(columns) == 1 and _is_text(columns[0][1])

    def new_text(text: str, path: str) -> str:
        if plain:
            return S.rewrite(text, "_new")
        return Q.let(
            Q.keep("_new", lambda s: f"{s}.path = {path}"),
            lambda mine: f"if(size({mine}) > 0, {S.rewrite(text, mine)}, {text})",
        )

    changed = {n: (kind, path) for n, kind, path in columns}
    output = [
        F.expr(
            f"if(_new is null, {Q.name(c)}, {rebuilt(Q.name(c), *changed[c], new_text)})"
        ).alias(c)
        if c in changed
        else F.col(Q.name(c))
        for c in df.columns
    ]
    open_rows = df if may_change is None else df.where(may_change)
    done = _with_row(open_rows, key, hashed, scope).join(per_row, ROW, "left").select(*output)
    if may_change is None:
        return done
    return done.unionByName(df.where(~may_change))


def tokenize(
    df: DataFrame,
    rows: Iterable[Detector],
    *,
    key: Sequence[str] = ("doc_id",),
    free_text: Sequence[str] = ("text",),
    typed: dict[str, str] | None = None,
    lang: Column | str = "lang",
    scope: Column | None = None,
    mapping: DataFrame | TokenStore | None = None,
    known: str | None = None,
    visible: DataFrame | None = None,
    entities: Iterable[str] | None = None,
    others: str | Mapping[str, str | Callable[[Column], Column]] = "mask",
    min_score: float | None = None,
    unknown_lang: str = "error",
    known_first: bool = True,
    literals: str = "escape",
    json: Sequence[str] = (),
    allocate: bool = True,
    secret: str = "",
    boost: float = BOOST,
    window: int = WINDOW,
    keep_visible_on: Sequence[str] = (),
) -> Tokenized:
    """Replace every identifier in `df` by its token.

    `key` names a row; it may be null or repeated, rows are told apart by their texts too.
    A null scope is an error. `free_text` columns are searched, at any nesting
    depth; each string cell of a `typed` column gets a token as a whole. String columns
    that `json` names hold JSON of any shape, as VARIANT columns do: their string values
    are searched, keys and numbers stay, malformed JSON and repeated keys are errors. The
    `known` column holds array<struct<seq,value,pii_type>> of literal values to
    replace before detection. `scope` separates mappings (default: one for
    all). With `allocate=False` values the mapping lacks become [TYPE_000]. Of a mapping
    that is given, only the entries of values found here go any further; a `TokenStore`
    opens only their buckets.
    Spans matching `visible` on `keep_visible_on` keep their text, though they
    are part of the mapping.

    With `entities` only those get tokens. `others` says what becomes of the rest:
    `mask` puts <ENTITY> in their place for good, `error` raises, `keep` does not look
    for them. A dict says so entity by entity (those it leaves out are masked); there, a
    function from the value's column to a string column puts its result in the place: a
    keyed digest, the last four digits. What it makes is not restored. Findings below `min_score` are none. `unknown_lang` is that of `routed`.
    With `known_first=False` known values are looked for in what detection left over.

    Token strings that the texts already hold get tokens of the type LITERAL, so that
    they come back as they were whatever the mapping holds, now or later. Texts that are
    tokenized already are passed with `literals="keep"`: their tokens stay, and numbering
    starts above them. With `allocate=False` they stay, too.
    """
    rows = list(rows)
    typed = dict(typed or {})
    key = list(key)
    fates = dict(others) if isinstance(others, Mapping) else {}
    fallback = "mask" if isinstance(others, Mapping) else others
    for fate in (fallback, *fates.values()):
        if not callable(fate) and fate not in ("mask", "error", "keep"):
            raise ValueError(f"others must be mask, error or keep, not {fate!r}")
    if literals not in ("escape", "keep"):
        raise ValueError(f"literals must be escape or keep, not {literals!r}")
    escape = literals == "escape" and allocate
    if entities is not None:
        entities = list(entities)
        chosen = only(rows, entities)
        only(rows, fates)  # names that no detector has are errors here, too
        fates = {e: fate for e, fate in fates.items() if e not in entities}
        if fallback == "keep":
            rows = chosen
        rows = [d for d in rows if fates.get(d.entity) != "keep"]
    free_text = list(dict.fromkeys([*free_text, *json]))
    scope = F.lit(CORPUS) if scope is None else F.coalesce(scope, F.raise_error("null scope").cast("string"))
    found, n_spans = stage(
        scan(
            df, rows, key=key, free_text=free_text, typed=typed, lang=lang, scope=scope,
            known=known, known_first=known_first, escape=escape, min_score=min_score,
            unknown_lang=unknown_lang, json=json, boost=boost, window=window,
        ),
        "spans",
        F.size("_spans"),
    )
    spans = found.select(*key, *ROW, F.col("_scope").alias("scope"), F.inline("_spans"))
    rest = None
    if entities is not None:
        # Typed cells, known values and literals are named by the caller or by their form.
        found_by = sorted({d.entity for d in rows} - set(entities))
        whole = F.col("path").isin([str(i) for i in range(len(typed))]) if typed else F.lit(False)
        other = F.col("entity").isin(found_by) & ~whole
        rest, spans = spans.where(other), spans.where(~other)
        refused = [e for e in found_by if fates.get(e, fallback) == "error"]
        wrong = rest.where(F.col("entity").isin(refused)).first() if refused else None
        if wrong is not None:
            raise ValueError(f"identifiers beyond {entities}: {wrong['entity']}")

    if mapping is None and not allocate:
        raise ValueError("allocate=False needs a mapping to look values up in")
    new, held, high = None, None, None
    wanted = spans.where(F.col("value") != "").select(*VALUE_KEY).distinct()
    if mapping is not None:
        wanted, n_wanted = stage(wanted, "values")
        if isinstance(mapping, TokenStore):
            high = mapping.high_water(wanted)
            held = mapping.holding(wanted, n_wanted)
            mapping = mapping.entries()
        else:
            held = likely(mapping.select(*MAPPING_COLUMNS), wanted, VALUE_KEY, n_wanted)
            high = mapping.groupBy("scope", "pii_type").agg(F.max("ordinal").alias("ordinal"))
        held, _ = stage(held, "held")
    if allocate:
        reserved = None
        if not escape:
            reserved = parse_tokens(found.select(F.col("_scope").alias("scope"), F.explode("_seen").alias("token")))
        # read to rewrite the texts and as the mapping: numbered once
        new, _ = stage(new_entries(wanted, held, reserved=reserved, high=high, secret=secret), "new-entries")
    full = mapping if new is None else new if mapping is None else mapping.select(*MAPPING_COLUMNS).unionByName(new)
    entries = held if new is None else new if held is None else held.unionByName(new)
    shown = spans
    if visible is not None:
        shown = spans.join(visible, list(keep_visible_on), "left_anti")
    replaced = salted_join(
        shown.select(*ROW, "scope", "path", "start", "end", "pii_type", "value"),
        entries.select("scope", "pii_type", "value", "token"),
        ["scope", "pii_type", "value"],
        spread=["_row_a", "path", "start"],
        how="inner" if allocate else "left",
        n_left=n_spans,
    ).withColumn(
        "token", F.coalesce("token", F.concat(F.lit("["), F.col("pii_type"), F.lit("_000]")))
    )

    places = [*ROW, "path", "start", "end", "token"]
    if rest is not None:
        written = F.concat(F.lit("<"), "entity", F.lit(">"))
        for entity, fate in fates.items():
            if callable(fate):
                written = F.when(F.col("entity") == entity, fate(F.col("value"))).otherwise(written)
        masks = rest.withColumn("token", written)
        replaced = replaced.select(*places).unionByName(masks.select(*places))

    columns = [
        c for c in _columns(df, [*typed, *free_text], json) if c[0] not in typed or _is_text(c[1])
    ]
    may_change = None
    if all(d.hint for d in rows):

        def open_text(text: str) -> str:
            tests = [S.hinted(text, rows)]
            if escape:
                tests.append(S.mentions_token(text))
            if known is not None:
                tests.append(Q.exists(Q.name(known), lambda k: f"contains({text}, {k}.value)"))
            return f"({' or '.join(f'coalesce({t}, false)' for t in tests)})"

        tests = [F.expr(f"coalesce({Q.name(n)} != '', false)") for n, _, _ in columns if n in typed]
        searched = [c for c in columns if c[0] not in typed]
        if searched:
            tests.append(_any_leaf(searched, open_text, raw=_shows_in_json(rows)))
        may_change = reduce(or_, tests) if tests else None
    hashed = _columns(df, [*typed, *free_text], json)
    return Tokenized(_put_back(df, key, columns, replaced, may_change, scope, hashed), full, spans.drop(*ROW), new)


def restore(
    df: DataFrame,
    mapping: DataFrame | TokenStore,
    *,
    key: Sequence[str] = ("doc_id",),
    columns: Sequence[str] | None = None,
    scope: Column | None = None,
    json: Sequence[str] = (),
) -> DataFrame:
    """Replace tokens by the values of `mapping`; unknown tokens stay.

    A token with two different values in its scope is an error. Of the mapping, only the
    entries of tokens found here are shuffled. Covers every column with strings in it unless `columns` names some. String columns
    that `json` names hold JSON: what is put back is spelled as JSON spells it.
    """
    key = list(key)
    scope = F.lit(CORPUS) if scope is None else F.coalesce(scope, F.raise_error("null scope").cast("string"))
    names = columns if columns is not None else [n for n in df.columns if n not in key]
    cells = [c for c in _columns(df, names, json) if has_text(c[1])]
    if not cells:
        return df
    located = Q.transform(
        _all_leaves(cells),
        lambda leaf: Q.transform(
            S.tokens_in(f"{leaf}.text"),
            lambda t: Q.struct(
                path=f"{leaf}.path", start=f"{t}.start", end=f"{t}.end", token=f"{t}.value"
            ),
        ),
    )
    found, n_tokens = stage(
        _with_row(df, key, cells, scope).select(*ROW, scope.alias("scope"), F.expr(f"inline(flatten({located}))")), "tokens"
    )
    if isinstance(mapping, TokenStore):
        held = mapping.for_tokens(found, n_tokens)
    else:
        held = likely(mapping.select("scope", "token", "value"), found, TOKEN_KEY, n_tokens)
    values = salted_join(
        found,
        held.select("scope", "token", "value"),
        ["scope", "token"],
        spread=["_row_a", "path", "start"],
        n_left=n_tokens,
    ).select(*ROW, "path", "start", "end", F.col("value").alias("token"))
    may_change = _any_leaf(cells, S.mentions_token, raw=True)
    return _put_back(df, key, cells, values, may_change, scope, cells, unique=True)


# Groups of rows whose digests are added up before single rows are looked at.
COMPARE_BUCKETS = 4_096


def round_trip_differences(
    source: DataFrame, restored: DataFrame, key: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Keys of rows that are not on both sides equally often, with the same key and cells.

    Keys may be null or repeated. Only digests leave the tables: 128 bits of each row are
    added up in COMPARE_BUCKETS buckets, and the digests of single rows are counted only in
    buckets whose sums differ.
    """
    key = list(key)

    def side(df: DataFrame, sign: int) -> DataFrame:
        parts = [*[F.col(Q.name(c)) for c in [*key, *columns]], *[F.col(Q.name(c)).isNull() for c in [*key, *columns]]]
        return df.select(
            *[F.col(Q.name(c)).alias(f"_k{i}") for i, c in enumerate(key)],
            F.xxhash64(F.lit(0), *parts).alias("_a"),
            F.xxhash64(F.lit(1), *parts).alias("_b"),
            F.lit(sign).alias("_sign"),
        ).withColumn("_bucket", F.pmod("_a", F.lit(COMPARE_BUCKETS)).cast("int"))

    both = side(source, 1).union(side(restored, -1))
    low = F.lit((1 << 32) - 1)
    sums = [F.sum(F.col("_sign") * x).alias(n) for n, x in
            (("_n", F.lit(1)), ("_x", F.col("_a").bitwiseAND(low)), ("_y", F.col("_b").bitwiseAND(low)))]
    summed = both.groupBy("_bucket").agg(*sums, F.bit_xor("_a").alias("_xa"), F.bit_xor("_b").alias("_xb"))
    unlike, n_unlike = stage(
        summed.where("_n <> 0 or _x <> 0 or _y <> 0 or _xa <> 0 or _xb <> 0").select("_bucket"), "unlike"
    )
    names = [f"_k{i}" for i in range(len(key))]
    if n_unlike == 0:
        # no row is asked for: the tables, and what restored one of them, need not be computed again
        return both.where(F.lit(False)).select(*[F.col(n).alias(k) for n, k in zip(names, key)])
    return (
        both.join(F.broadcast(unlike), "_bucket")  # COMPARE_BUCKETS rows at most
        .groupBy(*names, "_a", "_b")
        .agg(F.sum("_sign").alias("_n"))
        .where("_n <> 0")
        .select(*[F.col(n).alias(k) for n, k in zip(names, key)])
        .distinct()
    )
