"""Secret scans: patterns, and zstandard novelty in sensitive places (operator 2).

Base patterns find assigned, access-key and long hexadecimal secrets. The method adds
what no pattern names: a string near a word such as "auth" or "credential" is held
against a raw-content dictionary made of common code identifiers and the text around
it. Its marginal cost is what its own bytes add to a compressed frame that already holds
some identifiers: the frame's tables and headers are paid for by those, so a short string
made of known words costs little. Letters are compared in lower case, so that
`SessionHandler` is known where `session` and `handler` are. A string that costs nearly
as much as its length is new: no identifier, no word said nearby, no repetition. Such
strings, with mixed kinds of characters, are reported as `novel`.
"""

from __future__ import annotations

import re

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskline.llm.common import map_rows

KINDS = ("assign", "access", "hex", "novel")
NEAR = 64  # code points before a candidate in which the sensitive word must end
AROUND = 512  # code points of surrounding text on either side in the dictionary
NOVELTY = 0.7  # least marginal bytes per byte
LEVEL = 12  # of compression; searches the dictionary for more than the last match

# The base patterns, and the words that make a place sensitive.
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
ASSIGN_LEAST = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 16
HEX = re.compile(r"[0-9a-f]{32,}")
SENSITIVE = re.compile(
    r"password|passwd|passphrase|secret|token|api_?key|private_?key|access_?key|credential|bearer|authorization|"
    r"auth_?key|client_?id|signature|session_?id",
    re.I | re.A,
)
SENSITIVE_STEMS = (
    "passw", "passph", "secret", "token", "key", "credential", "bearer", "auth", "client", "signature", "session",
)
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
IDENTIFIERS = (
    "abstract assert async await boolean break buffer callback catch char class client config connection const "
    "content context continue controller count create current data database debug default delete description "
    "dictionary document double element else encode encoding endpoint entity enum environment error event example "
    "except exception export extends false field file final finally float format from function get handler hash "
    "header height hostname html http https identifier implements import include index initialize input insert "
    "instance integer interface internal iterator json lambda language length library list localhost logger manager "
    "message method model module name namespace network null number object option output override package parameter "
    "parent parse password path pattern position prefix print private process property protected protocol public "
    "query random range read reference register release remove request resource response result return schema "
    "secret select self server service session setting setup source static status stream string struct super switch "
    "system table template test text thread throw timeout timestamp token true type undefined update upload url user "
    "username utils validate value variable vector version virtual void while width window workspace write www yield "
    "0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ com org net example"
).encode()

# Words of the dictionary that a frame begins with, in another order.
OPENING = b" ".join(IDENTIFIERS.split()[3:103:9][::-1]) + b" "


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds by start, then kind in the order of KINDS."""
    low, found = text.lower(), []
    if any(w in low for w in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[1]) >= ASSIGN_LEAST:
                found.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(a, b, KINDS[k]) for a, k, b in sorted(found)]


def novelty(candidate: str, around: str) -> float:
    """Marginal compressed bytes per byte of a string, given the text around it and code identifiers."""
    dictionary = zstandard.ZstdCompressionDict(
        IDENTIFIERS.lower() + b" " + around.lower().encode("utf-8", "surrogatepass"),
        dict_type=zstandard.DICT_TYPE_RAWCONTENT,
    )
    press = zstandard.ZstdCompressor(
        level=LEVEL, dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False
    )
    data = candidate.lower().encode("utf-8", "surrogatepass")
    return (len(press.compress(OPENING + data)) - len(press.compress(OPENING))) / len(data)


def _mixed(text: str) -> bool:
    digit, upper, lower = (any(map(f, text)) for f in (str.isdigit, str.isupper, str.islower))
    return digit and (upper or lower) and len(set(text)) >= 8


def novel_spans(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans of incompressible strings in sensitive places that meet no base span."""
    low = text.lower()
    if not any(s in low for s in SENSITIVE_STEMS):
        return []
    out, checked = [], 0
    for word in SENSITIVE.finditer(text):
        if word.end() < checked:
            start = checked
        else:
            start = word.end()
        limit = word.end() + NEAR
        while m := CANDIDATE.search(text, start, len(text)):
            if m.start() > limit:
                break
            start = checked = m.end()
            if any(a < m.end() and m.start() < b for a, b, _ in taken) or not _mixed(m[0]):
                continue
            around = text[max(0, m.start() - AROUND) : m.start()] + " " + text[m.end() : m.end() + AROUND]
            if novelty(m[0], around) >= NOVELTY:
                out.append((m.start(), m.end(), "novel"))
    return out


def scan(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and spans (array of start, end, kind) of every row.

    Offsets are code points, end exclusive; spans are ordered by start, then by KINDS, and
    the base kinds are there whatever the method adds. Null and empty texts have none.
    Rows are kept one to one, repeated and null keys too; other columns are not carried.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_type = rows.schema["key"].dataType.simpleString()

    def run(keys, texts):
        out = []
        for t in texts:
            if not t:
                out.append([])
                continue
            base = base_spans(t)
            spans = sorted(base + novel_spans(t, base), key=lambda s: (s[0], KINDS.index(s[2])))
            out.append([{"start": a, "end": b, "kind": k} for a, b, k in spans])
        return keys, out

    spans = "array<struct<start: int, end: int, kind: string>>"
    return map_rows(rows, run, f"key {key_type}, spans {spans}").withColumnRenamed("key", key)


def redact(docs: DataFrame, *, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The rows with every found span replaced by `mark`; overlapping spans are replaced as one.

    All columns stay. Null texts stay null.
    """
    names = docs.columns
    schema = docs.schema
    place = names.index(text)

    def run(*columns):
        changed = []
        for t in columns[place]:
            base = base_spans(t) if t else []
            spans = sorted(base + novel_spans(t, base)) if t else []
            pieces, at = [], 0
            for a, b, _ in spans:
                if a >= at:
                    pieces += [t[at:a], mark]
                at = max(at, b)
            changed.append("".join([*pieces, t[at:]]) if spans else t)
        return [changed if i == place else c for i, c in enumerate(columns)]

    if len(set(names)) != len(names):
        raise ValueError("column names must differ")
    return map_rows(docs, run, schema, text)
