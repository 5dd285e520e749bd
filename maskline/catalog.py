"""The detector catalog: which identifiers exist, how they look, how they score."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskline.functions import checksums

# Score tiers, entity names and context words of the data model.
CHECKSUM_SCORE = 0.85
SHAPE_SCORE = 0.4

ENTITY_OF_TYPE = {
    "PL_PESEL": "PL_PESEL",
    "PL_NIP": "PL_NIP",
    "PL_REGON": "PL_REGON",
    "PL_ID_CARD": "PL_ID_CARD",
    "PL_PASSPORT": "PL_PASSPORT",
    "PL_KRS": "PL_KRS",
    "PL_POSTAL_CODE": "PL_POSTAL_CODE",
    "PL_PHONE": "PHONE_NUMBER",
    "PL_IBAN": "IBAN_CODE",
    "EMAIL": "EMAIL_ADDRESS",
    "CREDIT_CARD": "CREDIT_CARD",
}
TYPE_OF_ENTITY = {entity: pii_type for pii_type, entity in ENTITY_OF_TYPE.items()}

CONTEXT_WORDS = {
    "pl_pesel": ("pesel",),
    "pl_nip": ("nip", "podatk", "podatkowy"),
    "pl_regon": ("regon",),
    "pl_id_card": ("dowód", "dowod", "osobisty"),
    "pl_passport": ("paszport", "passport"),
    "pl_iban": ("iban", "konto", "rachunek"),
    "pl_phone": ("telefon", "tel", "kom", "phone"),
    "pl_krs": ("krs",),
    "pl_postal_code": ("kod", "pocztowy"),
    "email": ("email", "e-mail", "mail"),
    "credit_card": ("card", "karta", "credit"),
}

# `\b` changed its meaning between Java versions, so word edges are spelled out.
# The look-ahead comes first: most positions fail it without a look back.
_EDGE = r"(?<![\p{L}\p{N}_])"
_DIGIT_EDGE = r"(?=\d)" + _EDGE
_END = r"(?![\p{L}\p{N}_])"

_LETTER = r"\p{L}\p{M}"
_ADDRESS = _LETTER + r"0-9._%+-"

PATTERNS = {
    "pl_pesel": rf"{_DIGIT_EDGE}\d{{11}}{_END}",
    "pl_nip": rf"{_DIGIT_EDGE}(?:\d{{10}}|\d{{3}}-\d{{3}}-\d{{2}}-\d{{2}}|\d{{3}}-\d{{2}}-\d{{2}}-\d{{3}}){_END}",
    "pl_regon": rf"{_DIGIT_EDGE}(?:\d{{14}}|\d{{9}}){_END}",
    "pl_id_card": rf"{_EDGE}[A-Z]{{3}} ?\d{{6}}{_END}",
    "pl_passport": rf"{_EDGE}[A-Z]{{2}} ?\d{{7}}{_END}",
    "pl_iban": rf"{_EDGE}PL\d{{2}}(?: ?\d{{4}}){{6}}{_END}",
    "pl_phone": rf"(?=[+\d])(?<![\p{{L}}\p{{N}}_+])(?:\+48[ -]?)?\d{{3}}[ -]?\d{{3}}[ -]?\d{{3}}{_END}",
    "pl_krs": rf"{_DIGIT_EDGE}\d{{10}}{_END}",
    "pl_postal_code": rf"{_DIGIT_EDGE}\d{{2}}-\d{{3}}{_END}",
    # A local part starts where a run of its characters starts (or where the last
    # match ended): a long run without "@" is then read once, not once per start.
    # The domain repeats one character, not a label group, because Java matches
    # repeated groups of varying length recursively and runs out of stack.
    # Letters of any script count, or half of an address would stay in the text.
    "email": rf"(?:(?<![{_ADDRESS}])|\G)[{_ADDRESS}]++@[{_LETTER}0-9-](?:(?!\.\.)[{_LETTER}0-9.-])*\.[{_LETTER}]{{2,}}",
    "credit_card": rf"{_DIGIT_EDGE}(?:\d{{13,19}}|\d{{4}}([ -])\d{{4}}\1\d{{4}}\1\d{{4}}){_END}",
}

# Necessary conditions, tried in order before the pattern. "=x" asks for the
# literal x, anything else is a small regex without lookaround. Detectors with
# the same first condition share its evaluation, and most texts stop there.
_LONG_NUMBER = r"\d{3}[ -]?\d{2}"

HINTS = {
    "pl_pesel": (_LONG_NUMBER, r"\d{11}"),
    "pl_nip": (_LONG_NUMBER, r"\d{10}|\d{3}-\d{2,3}-\d{2}-\d{2}"),
    "pl_regon": (_LONG_NUMBER, r"\d{9}"),
    "pl_id_card": (_LONG_NUMBER, r"[A-Z] ?\d{6}"),
    "pl_passport": (_LONG_NUMBER, r"[A-Z] ?\d{7}"),
    "pl_iban": ("=PL", r"PL\d{2} ?\d{4}"),
    "pl_phone": (_LONG_NUMBER, r"\d{3}[ -]?\d{3}[ -]?\d{3}"),
    "pl_krs": (_LONG_NUMBER, r"\d{10}"),
    "pl_postal_code": (r"\d-\d{3}",),
    "email": ("=@",),
    "credit_card": (_LONG_NUMBER, r"\d{4}[ -]?\d{4}[ -]?\d{4}"),
}

CHECKSUMS = {
    "pl_pesel": checksums.PESEL,
    "pl_nip": checksums.NIP,
    "pl_regon": checksums.REGON,
    "pl_iban": checksums.IBAN,
    "credit_card": checksums.LUHN,
}

TYPE_OF_DETECTOR = {name: "EMAIL" if name == "email" else name.upper() for name in PATTERNS}
POLISH = ("pl_pesel", "pl_nip", "pl_regon", "pl_id_card", "pl_passport", "pl_iban", "pl_phone")
OPT_IN = ("pl_krs", "pl_postal_code")
CROSS_LANGUAGE = ("email", "credit_card")

PII_TYPE_SHAPE = re.compile(r"[A-Z_]+")


@dataclass(frozen=True)
class Detector:
    """One catalog row.

    `valid` is a checksum as a SQL condition with `{}` for the value, or None
    when the shape alone decides.
    """

    name: str
    pii_type: str
    entity: str
    lang: str
    regex: str
    score: float
    context: tuple[str, ...] = ()
    valid: str | None = None
    hint: tuple[str, ...] = ()
    opt_in: bool = False

    def __post_init__(self) -> None:
        if not PII_TYPE_SHAPE.fullmatch(self.pii_type):
            raise ValueError(f"PII type {self.pii_type!r} must consist of A-Z and underscores")
        if not 0.0 <= self.score <= 1.0:
            raise ValueError(f"score of {self.name!r} must lie between 0 and 1")


def _builtin(name: str, lang: str) -> Detector:
    pii_type = TYPE_OF_DETECTOR[name]
    return Detector(
        name=name,
        pii_type=pii_type,
        entity=ENTITY_OF_TYPE[pii_type],
        lang=lang,
        regex=PATTERNS[name],
        score=CHECKSUM_SCORE if name in CHECKSUMS else SHAPE_SCORE,
        context=CONTEXT_WORDS[name],
        valid=CHECKSUMS.get(name),
        hint=HINTS[name],
        opt_in=name in OPT_IN,
    )


def detectors(languages: Iterable[str] = ("pl",), *, include_opt_in: bool = False) -> list[Detector]:
    """Catalog rows for the given languages, in order."""
    rows: list[Detector] = []
    for lang in dict.fromkeys(languages):
        names = CROSS_LANGUAGE
        if lang == "pl":
            names = POLISH + (OPT_IN if include_opt_in else ()) + CROSS_LANGUAGE
        rows += [_builtin(name, lang) for name in names]
    return rows


def custom_detector(
    name: str,
    regex: str,
    *,
    pii_type: str,
    score: float,
    entity: str | None = None,
    lang: str = "pl",
    context: Sequence[str] = (),
    valid: str | None = None,
    hint: Sequence[str] = (),
) -> Detector:
    """A caller's own detector; `regex` uses Java syntax and must not match ''."""
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.range(1).select(F.rlike(F.lit(""), F.lit(regex))).first()[0]:
        raise ValueError(f"the pattern of {name!r} matches an empty text")
    return Detector(
        name, pii_type, entity or pii_type, lang, regex, score, tuple(context), valid, tuple(hint)
    )


def with_context(rows: Iterable[Detector], words: dict[str, Sequence[str]]) -> list[Detector]:
    """Replace the context words of the named detectors."""
    return [replace(d, context=tuple(words[d.name])) if d.name in words else d for d in rows]


def excluding(rows: Iterable[Detector], entities: Iterable[str]) -> list[Detector]:
    dropped = set(entities)
    return [d for d in rows if d.entity not in dropped]


def only(rows: Iterable[Detector], entities: Iterable[str]) -> list[Detector]:
    """Keep the named entities; a name no catalog row carries is an error."""
    rows = list(rows)
    wanted = list(entities)
    known = {d.entity for d in rows}
    for entity in wanted:
        if entity not in known:
            raise ValueError(f"no detector finds {entity!r}, only {sorted(known)}")
    return [d for d in rows if d.entity in wanted]


def catalog_frame(spark: SparkSession, rows: Iterable[Detector]) -> DataFrame:
    """The catalog as a table, for reports and joins."""
    return spark.createDataFrame(
        [
            (d.name, d.pii_type, d.entity, d.lang, d.regex, d.score, d.valid is not None, list(d.context), i)
            for i, d in enumerate(rows)
        ],
        "detector string, pii_type string, entity string, lang string, regex string, "
        "score double, has_checksum boolean, context array<string>, rank int",
    )
