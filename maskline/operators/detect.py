"""Corpus scans that turn texts into findings. All of them are narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskline.catalog import CROSS_LANGUAGE, ENTITY_OF_TYPE, TYPE_OF_ENTITY, Detector, only
from maskline.functions import spans as S
from maskline.functions import sql as Q
from maskline.operators.lookup import salted_join

BOOST = 0.35
WINDOW = 5


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _applicable(rows: Iterable[Detector], entities, min_score, boost) -> list[Detector]:
    """Leave out detectors whose findings the caller would drop anyway."""
    rows = list(rows)
    if entities is not None:
        rows = only(rows, entities)
    if min_score is not None:
        rows = [d for d in rows if min(1.0, d.score + (boost if d.context else 0.0)) >= min_score]
    return rows


# Language code of the texts whose own language has no catalog row.
ELSEWHERE = ""


def routed(
    lang: Column | str, rows: Iterable[Detector], unknown_lang: str
) -> tuple[Column, Column, list[Detector]]:
    """(language to search with, whether the row must be looked at, detectors).

    A language without catalog rows, null included, is an `error`; or such texts are
    searched with the detectors of every language (`cross`); or left as they are (`skip`).
    """
    lang, rows = as_column(lang), list(rows)
    if unknown_lang not in ("error", "cross", "skip"):
        raise ValueError(f"unknown_lang must be error, cross or skip, not {unknown_lang!r}")
    if unknown_lang == "skip" or not rows:
        return lang, F.lit(False), rows
    known = sorted({d.lang for d in rows})
    strange = ~F.coalesce(lang.isin(known), F.lit(False))
    if unknown_lang == "cross":
        anywhere = {d.name: replace(d, lang=ELSEWHERE) for d in rows if d.name in CROSS_LANGUAGE}
        return F.when(strange, F.lit(ELSEWHERE)).otherwise(lang), F.lit(False), [*rows, *anywhere.values()]
    message = F.concat(F.lit("no detectors for language "), F.coalesce(lang, F.lit("null")), F.lit(f"; known: {known}"))
    return F.when(strange, F.raise_error(message).cast("string")).otherwise(lang), strange, rows


def detect(
    docs: DataFrame,
    rows: Iterable[Detector],
    *,
    key: Sequence[str] = ("doc_id",),
    text: str = "text",
    lang: Column | str = "lang",
    entities: Iterable[str] | None = None,
    min_score: float | None = None,
    boost: float = BOOST,
    window: int = WINDOW,
    resolve: bool = False,
    unknown_lang: str = "error",
) -> DataFrame:
    """One row per finding: key, detector, entity, pii_type, start, end, value, scores.

    `lang` is a column name or a column such as `lit("pl")`; `unknown_lang` says what
    happens to texts in a language without detectors (see `routed`). With `resolve`,
    overlapping findings are settled first.
    """
    spoken, strange, rows = routed(lang, rows, unknown_lang)
    rows = _applicable(rows, entities, min_score, boost)
    found = S.findings(Q.name(text), "_lang", rows, boost=boost, window=window)
    if min_score is not None:
        found = Q.keep(found, lambda f: f"{f}.score >= double({min_score!r})")
    if resolve:
        found = S.untangle(found)
    return (
        docs.where(F.expr(S.gated(Q.name(text), rows)) | strange)
        .withColumn("_lang", spoken)
        .select(*key, F.expr(f"inline({found})"))
        .select(*key, "detector", "entity", "pii_type", "start", "end", "value", "pattern_score", "score")
    )


def detect_distinct(
    docs: DataFrame,
    rows: Iterable[Detector],
    *,
    key: Sequence[str] = ("doc_id",),
    text: str = "text",
    lang: Column | str = "lang",
    unknown_lang: str = "error",
    **options,
) -> DataFrame:
    """`detect` for tables with many copies: every text is searched once for each language.

    Only texts that pass the first hints travel, one of each per task at most; the findings
    come back to the rows by 128 bits of text and language, with hot texts salted.
    """
    rows = list(rows)
    _, strange, gates = routed(lang, rows, unknown_lang)
    digests = {f"_text_{i}": F.xxhash64(F.lit(i), F.col(text), as_column(lang)) for i in (0, 1)}
    open_texts = docs.where(F.expr(S.gated(Q.name(text), gates)) | strange).withColumns({**digests, "_spoken": as_column(lang)})
    once = open_texts.groupBy(*digests, "_spoken").agg(F.any_value(Q.name(text)).alias("_text"))
    found = detect(once, rows, key=list(digests), text="_text", lang="_spoken", unknown_lang=unknown_lang, **options)
    columns = [c for c in found.columns if c not in digests]
    return salted_join(open_texts.select(*key, *digests), found, list(digests), spread=list(key)).select(*key, *columns)


def look_alikes(
    docs: DataFrame,
    rows: Iterable[Detector],
    *,
    key: Sequence[str] = ("doc_id",),
    text: str = "text",
    lang: Column | str = "lang",
    unknown_lang: str = "error",
) -> DataFrame:
    """Every shape match with the outcome of its checksum in `valid`."""
    spoken, strange, rows = routed(lang, rows, unknown_lang)
    names = [d.name for d, _ in S.merged(rows)]
    found = S.candidates(Q.name(text), "_lang", rows)
    return (
        docs.where(F.expr(S.gated(Q.name(text), rows)) | strange)
        .withColumn("_lang", spoken)
        .select(*key, F.expr(f"inline({found})"))
        .withColumn("detector", F.get(F.array(*[F.lit(n) for n in names]), F.col("rank")))
        .select(*key, "detector", "start", "end", "value", "valid")
    )


def count_outcomes(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy("detector").agg(
        F.count_if("valid").alias("accepted"), F.count_if(~F.col("valid")).alias("rejected")
    )


def count_per_detector(findings: DataFrame, *by: str) -> DataFrame:
    return findings.groupBy(*by, "detector").agg(F.count(F.lit(1)).alias("n"))


def in_text_order(findings: DataFrame, key: Sequence[str] = ("doc_id",)) -> DataFrame:
    return findings.orderBy(*key, "start", "end", "detector")


def _relabel(values: dict[str, str], column: str) -> Column:
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.col(column))


def entity_of(column: str = "pii_type") -> Column:
    """Entity name of a PII type; a type of the caller's own keeps its name."""
    return F.coalesce(_relabel(ENTITY_OF_TYPE, column), F.col(column))


def pii_type_of(column: str = "entity") -> Column:
    return F.coalesce(_relabel(TYPE_OF_ENTITY, column), F.col(column))
