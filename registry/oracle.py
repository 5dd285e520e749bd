"""SQL that a second engine runs on the same tables, with arithmetic of its own.

Patterns are in RE2 syntax: `\\b` for word edges, no look-around. Positions come
from window sums and lists, check digits from list arithmetic, overlap
resolution from a list reduction, rewriting from an ordered string aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from registry.inputs import (
    ALL_NAMES_SQL,
    CALLS_SQL,
    CASES_SQL,
    EVERYTHING_SQL,
    LANGUAGES_SQL,
    LITERALS_SQL,
    NAMES_SQL,
    NOTES_SQL,
    ROUTED_SQL,
    SUBJECTS_SQL,
    TYPED_SQL,
    UNKEYED_SQL,
)

DOCUMENTS_SQL = "SELECT doc_id, lang, text FROM documents"
LANGS = ("de", "en", "es", "fr")

# name: (entity, type, score, context words, pattern, check)
_WEIGHTED = "list_sum(list_transform(range(1, {n} + 1), lambda i: {w}[i] * CAST(substr({v}, i, 1) AS BIGINT)))"


def _sum(weights: Sequence[int], value: str) -> str:
    return _WEIGHTED.format(n=len(weights), w=list(weights), v=value)


_BARE = "replace(replace(value, '-', ''), ' ', '')"
_LUHN = (
    f"list_sum(list_transform(range(1, length({_BARE}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN "
    f"CAST(substr(reverse({_BARE}), i, 1) AS BIGINT) ELSE 2 * CAST(substr(reverse({_BARE}), i, 1) AS BIGINT) "
    f"- 9 * CAST(CAST(substr(reverse({_BARE}), i, 1) AS BIGINT) > 4 AS BIGINT) END)) % 10 = 0"
)
_REGON9 = f"{_sum((8, 9, 2, 3, 4, 5, 6, 7), 'value')} % 11 % 10 = CAST(substr(value, 9, 1) AS BIGINT)"
_REGON14 = (
    f"{_sum((2, 4, 8, 5, 0, 9, 7, 3, 6, 1, 2, 4, 8), 'value')} % 11 % 10 = CAST(substr(value, 14, 1) AS BIGINT)"
)

DETECTORS: dict[str, tuple[str, str, float, list[str], str, str]] = {
    "pl_pesel": (
        "PL_PESEL", "PL_PESEL", 0.85, ["pesel"], r"\b\d{11}\b",
        f"({_sum((1, 3, 7, 9, 1, 3, 7, 9, 1, 3, 1), 'value')}) % 10 = 0",
    ),
    "pl_nip": (
        "PL_NIP", "PL_NIP", 0.85, ["nip", "podatk", "podatkowy"],
        r"\b(?:\d{10}|\d{3}-\d{3}-\d{2}-\d{2}|\d{3}-\d{2}-\d{2}-\d{3})\b",
        f"{_sum((6, 5, 7, 2, 3, 4, 5, 6, 7), _BARE)} % 11 = CAST(substr({_BARE}, 10, 1) AS BIGINT)",
    ),
    "pl_regon": (
        "PL_REGON", "PL_REGON", 0.85, ["regon"], r"\b(?:\d{14}|\d{9})\b",
        f"CASE WHEN length(value) = 9 THEN {_REGON9} ELSE {_REGON9} AND {_REGON14} END",
    ),
    "pl_id_card": ("PL_ID_CARD", "PL_ID_CARD", 0.4, ["dowód", "dowod", "osobisty"], r"\b[A-Z]{3} ?\d{6}\b", "true"),
    "pl_passport": ("PL_PASSPORT", "PL_PASSPORT", 0.4, ["paszport", "passport"], r"\b[A-Z]{2} ?\d{7}\b", "true"),
    "pl_iban": (
        "IBAN_CODE", "PL_IBAN", 0.85, ["iban", "konto", "rachunek"], r"\bPL\d{2}(?: ?\d{4}){6}\b",
        f"CAST(substr({_BARE}, 5) || '2521' || substr({_BARE}, 3, 2) AS HUGEINT) % 97 = 1",
    ),
    "pl_phone": (
        "PHONE_NUMBER", "PL_PHONE", 0.4, ["telefon", "tel", "kom", "phone"],
        r"(?:\+48[ -]?)?\b\d{3}[ -]?\d{3}[ -]?\d{3}\b", "true",
    ),
    "pl_krs": ("PL_KRS", "PL_KRS", 0.4, ["krs"], r"\b\d{10}\b", "true"),
    "pl_postal_code": ("PL_POSTAL_CODE", "PL_POSTAL_CODE", 0.4, ["kod", "pocztowy"], r"\b\d{2}-\d{3}\b", "true"),
    "email": (
        "EMAIL_ADDRESS", "EMAIL", 0.4, ["email", "e-mail", "mail"],
        r"[\p{L}\p{M}0-9._%+-]+@[\p{L}\p{M}0-9-]+(?:\.[\p{L}\p{M}0-9-]+)*\.[\p{L}\p{M}]{2,}", "true",
    ),
    "credit_card": (
        "CREDIT_CARD", "CREDIT_CARD", 0.85, ["card", "karta", "credit"],
        r"\b(?:\d{13,19}|\d{4} \d{4} \d{4} \d{4}|\d{4}-\d{4}-\d{4}-\d{4})\b", _LUHN,
    ),
    "customer_id": (
        "CUSTOMER_ID", "CUSTOMER_ID", 0.85, ["customer", "klient", "sprawa"], r"\bCID-\d{5,}\b", "true",
    ),
}
BASE = ["pl_pesel", "pl_nip", "pl_regon", "pl_id_card", "pl_passport", "pl_iban", "pl_phone"]
OPT_IN = ["pl_krs", "pl_postal_code"]
CROSS = ["email", "credit_card"]
POLISH = BASE + CROSS
POLISH_ALL = BASE + OPT_IN + CROSS


def _literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def shapes(
    source: str,
    names: Sequence[str],
    *,
    key: str = "doc_id",
    other_langs: Sequence[str] = (),
    context: dict[str, list[str]] | None = None,
) -> str:
    """CTEs src, hit, placed, checked: shape matches, offsets, outcome of the check."""
    hits = []
    for rank, name in enumerate(names):
        entity, pii_type, score, words, pattern, _ = DETECTORS[name]
        words = (context or {}).get(name, words)
        langs = ["pl", *(other_langs if name in CROSS else ())]
        hits.append(
            f"SELECT *, {rank} AS rnk, '{name}' AS detector, '{entity}' AS entity, '{pii_type}' AS pii_type, "
            f"CAST({score} AS DOUBLE) AS pattern_score, CAST({words} AS VARCHAR[]) AS words, "
            f"regexp_extract_all(text, {_literal(pattern)}) AS m, "
            f"regexp_split_to_array(text, {_literal(pattern)}) AS g FROM src "
            f"WHERE lang IN ({', '.join(map(_literal, langs))})"
        )
    checks = " ".join(f"WHEN '{n}' THEN {DETECTORS[n][5]}" for n in names)
    return f"""
src AS ({source}),
hit AS ({' UNION ALL '.join(hits)}),
numbered AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM hit WHERE len(m) > 0),
placed AS (
  SELECT * EXCLUDE (m, g, i), m[i] AS value,
    CAST(list_sum(list_transform(g[1:i], lambda s: length(s)))
      + coalesce(list_sum(list_transform(m[1:i - 1], lambda s: length(s))), 0) AS BIGINT) AS s
  FROM numbered),
checked AS (SELECT *, s + length(value) AS e, CASE detector {checks} END AS valid FROM placed)"""


def findings(source: str, names: Sequence[str], **options) -> str:
    """CTE f on top of `shapes`: accepted findings with their score."""
    return (
        shapes(source, names, **options)
        + r""",
near AS (
  SELECT *, string_split(trim(regexp_replace(lower(left(text, s)), '\s+', ' ', 'g')), ' ')[-5:] AS before
  FROM checked WHERE valid),
f AS (
  SELECT * EXCLUDE (before, valid), CASE
    WHEN len(list_filter(before, lambda w: len(list_filter(words, lambda c: contains(w, c))) > 0)) > 0
    THEN least(CAST(1 AS DOUBLE), pattern_score + CAST(0.35 AS DOUBLE)) ELSE pattern_score END AS score
  FROM near)"""
    )


def kept(source: str, names: Sequence[str], *, key: str = "doc_id", **options) -> str:
    """CTE k on top of `findings`: what is left after overlaps are settled."""
    return (
        findings(source, names, key=key, **options)
        + f""",
per_doc AS (
  SELECT {key}, list({{'s': s, 'e': e, 'rnk': rnk, 'detector': detector, 'entity': entity, 'pii_type': pii_type,
    'value': value, 'pattern_score': pattern_score, 'score': score}}
    ORDER BY score DESC, e - s DESC, s, rnk) AS all_found
  FROM f GROUP BY {key}),
settled AS (
  SELECT {key}, list_reduce(list_transform(all_found, lambda x: [x]), lambda acc, y: CASE
    WHEN len(list_filter(acc, lambda q: q.s < y[1].e AND y[1].s < q.e)) > 0 THEN acc
    ELSE list_concat(acc, y) END) AS won
  FROM per_doc),
k AS (
  SELECT {key}, w.s, w.e, w.rnk, w.detector, w.entity, w.pii_type, w.value, w.pattern_score, w.score
  FROM (SELECT {key}, unnest(won) AS w FROM settled))"""
    )


FINDING = (
    "doc_id, detector, entity, pii_type, s AS start, e AS \"end\", value, pattern_score, round(score, 6) AS score"
)
TOKEN = "'[' || pii_type || '_' || CASE WHEN ordinal < 100 THEN lpad(CAST(ordinal AS VARCHAR), 3, '0') ELSE CAST(ordinal AS VARCHAR) END || ']'"


def numbering(values: str, scope: str = "'corpus'") -> str:
    """CTEs v, map: distinct values in the order of their digest."""
    return f"""
v AS (SELECT DISTINCT {scope} AS scope, pii_type, value FROM ({values})),
ord AS (SELECT *, row_number() OVER (PARTITION BY scope, pii_type ORDER BY sha256(value), value) AS ordinal FROM v),
map AS (SELECT scope, pii_type, ordinal, {TOKEN} AS token, value FROM ord)"""


MAP = "SELECT scope, pii_type, ordinal, token, value FROM map"


def rewriting(spans: str, source: str = "src", key: str = "doc_id") -> str:
    """CTE done: texts of `source` with the spans (key, s, e, token) replaced."""
    return f"""
cuts AS (
  SELECT {key}, s, e, token, coalesce(lag(e) OVER (PARTITION BY {key} ORDER BY s), 0) AS behind FROM ({spans})),
pieces AS (
  SELECT {key}, string_agg(substr(text, CAST(behind + 1 AS BIGINT), CAST(s - behind AS BIGINT)) || token, '' ORDER BY s) AS head,
    max(e) AS stop
  FROM cuts JOIN {source} USING ({key}) GROUP BY {key}),
done AS (
  SELECT b.* EXCLUDE (text), CASE WHEN head IS NULL THEN b.text
    ELSE head || substr(b.text, CAST(stop + 1 AS BIGINT)) END AS text
  FROM {source} b LEFT JOIN pieces USING ({key}))"""


def tokenized(source: str, names: Sequence[str], *, where: str = "true", **options) -> str:
    return (
        kept(source, names, **options)
        + ","
        + numbering(f"SELECT pii_type, value FROM k WHERE {where}")
        + ","
        + rewriting(f"SELECT doc_id, s, e, token FROM k JOIN map USING (pii_type, value) WHERE {where}")
    )


def q(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()} {select}"


def nested(name: str, ctes: str, select: str) -> str:
    """A CTE with CTEs of its own, whose names stay inside."""
    return f"{name} AS (WITH {ctes.strip()} {select})"


def one(name: str, source: str, **options) -> str:
    return q(findings(source, [name], **options), f"SELECT {FINDING} FROM f")


ALL_OPTIONS = {"other_langs": LANGS}
PEOPLE = """
people AS ({typed}),
cells AS (
  SELECT id, 'name' AS col, name AS value, 'PERSON' AS pii_type FROM people UNION ALL
  SELECT id, 'email', email, 'EMAIL' FROM people UNION ALL
  SELECT id, 'pesel', pesel, 'PL_PESEL' FROM people),
filled AS (SELECT * FROM cells WHERE value <> '')"""
PEOPLE = PEOPLE.format(typed=TYPED_SQL)


_PERSON_COLUMNS = (
    "p.id, coalesce(n.token, p.name) AS name, coalesce(m.token, p.email) AS email, "
    "coalesce(z.token, p.pesel) AS pesel, p.balance"
)
_PERSON_JOINS = (
    "LEFT JOIN map n ON n.pii_type = 'PERSON' AND n.value = p.name "
    "LEFT JOIN map m ON m.pii_type = 'EMAIL' AND m.value = p.email "
    "LEFT JOIN map z ON z.pii_type = 'PL_PESEL' AND z.value = p.pesel"
)

TABLE_SQL = (
    kept("SELECT id AS doc_id, 'pl' AS lang, notes AS text FROM (" + TYPED_SQL + ")", POLISH)
    + ","
    + PEOPLE
    + ","
    + numbering("SELECT pii_type, value FROM k UNION ALL SELECT pii_type, value FROM filled")
    + ","
    + rewriting("SELECT doc_id, s, e, token FROM k JOIN map USING (pii_type, value)")
)

# Known names of a case: positions of all occurrences, first listed first.
_NAME_SPANS = f"""
src AS ({CASES_SQL}),
names AS ({NAMES_SQL}),
gaps AS (
  SELECT case_id, doc_id, name, string_split(text, name) AS g
  FROM src JOIN names USING (case_id) WHERE contains(text, name)),
name_numbers AS (SELECT *, unnest(range(1, len(g))) AS i FROM gaps),
name_spans AS (
  SELECT case_id, doc_id, 'PERSON' AS pii_type, name AS value,
    CAST(list_sum(list_transform(g[1:i], lambda s: length(s))) + (i - 1) * length(name) AS BIGINT) AS s
  FROM name_numbers)"""

# Payload leaves of the tool calls, one row per string.
LEAVES_SQL = (
    f"SELECT id, 'recipient' AS leaf, recipient AS text FROM ({CALLS_SQL}) UNION ALL "
    f"SELECT id, 'subject', subject FROM ({CALLS_SQL}) UNION ALL "
    f"SELECT id, 'body', body FROM ({CALLS_SQL}) UNION ALL SELECT id, 'tag', tag FROM ({CALLS_SQL})"
)


def _loose(recipient: str, subject: str, body: str, tag: str) -> str:
    """The JSON text of a call: three shapes, and keys by the call's number."""
    r, s, b, t = (f"CAST(to_json({x}) AS VARCHAR)" for x in (recipient, subject, body, tag))
    key = "'k' || (c.id % 5)"
    return (
        f"""CASE c.id % 3 WHEN 0 THEN '{{"to": ' || {r} || ', "' || {key} || '": {{"subject": ' || {s} || """
        f"""', "lines": [' || {b} || ', null]}}, "tag": ' || {t} || '}}' """
        f"""WHEN 1 THEN '[' || {r} || ', ' || {s} || ', {{"' || {key} || '": ' || {b} || ', "n": ' || c.amount || '}}, ' || {t} || ']' """
        f"""ELSE '{{"' || {key} || '":[[' || {r} || '],[' || {s} || ',true]],"b":' || {b} || ',"tags":{{"' || {key} || '":' || {t} || '}}}}' END"""
    )


_LEAF_KEY = "CAST(id AS VARCHAR) || '/' || leaf"

_WORDS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), lambda w: w <> '')"


def scores(queries: str, docs: str) -> str:
    return f"""
asked AS ({queries}),
answering AS ({docs}),
qt AS (SELECT query_id, term, count(*) AS tf FROM (SELECT query_id, unnest({_WORDS}) AS term FROM asked) GROUP BY ALL),
dt AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_WORDS}) AS term FROM answering) GROUP BY ALL),
qn AS (SELECT query_id, sqrt(CAST(sum(tf * tf) AS DOUBLE)) AS norm FROM qt GROUP BY query_id),
dn AS (SELECT doc_id, sqrt(CAST(sum(tf * tf) AS DOUBLE)) AS norm FROM dt GROUP BY doc_id),
dots AS (SELECT query_id, doc_id, CAST(sum(qt.tf * dt.tf) AS DOUBLE) AS dot FROM qt JOIN dt USING (term) GROUP BY ALL),
sc AS (SELECT query_id, doc_id, dot / (qn.norm * dn.norm) AS score FROM dots JOIN qn USING (query_id) JOIN dn USING (doc_id))"""


_BENCH = "SELECT item_id AS query_id, text FROM benchmark"
_TOP = (
    "top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank "
    "FROM {0}) WHERE rank <= 2)"
)
_PROMPT = (
    "'Pytanie: ' || a.text || chr(10) || chr(10) || 'Kontekst:' || chr(10) || coalesce(c.context, '') || chr(10) "
    "|| chr(10) || 'Odpowiedź:'"
)


def prompts(docs: str = "answering", asked: str = "asked") -> str:
    return (
        f"ctx AS (SELECT query_id, string_agg('- ' || d.text, chr(10) ORDER BY rank) AS context "
        f"FROM top JOIN {docs} d USING (doc_id) GROUP BY query_id), "
        f"prompts AS (SELECT a.query_id, {_PROMPT} AS prompt FROM {asked} a LEFT JOIN ctx c USING (query_id))"
    )


_JSON_ENTRY = "{'token': token, 'type': pii_type, 'value': value}"
_DIFF_BEFORE = findings(NOTES_SQL, BASE + ["email"])
_DIFF_AFTER = findings(NOTES_SQL, POLISH_ALL, context={"pl_pesel": []})
_NOTE_VALUES = kept(NOTES_SQL, POLISH) + "," + numbering("SELECT pii_type, value FROM k")
_NOTE_TOKENS = tokenized(NOTES_SQL, POLISH)
_DOC_TOKENS = tokenized(DOCUMENTS_SQL, CROSS, **ALL_OPTIONS)
_SUBJECT_TEXT = (
    nested("k", kept(CASES_SQL, POLISH, key="case_id, doc_id"), "SELECT * FROM k")
    + ","
    + _NAME_SPANS
    + """,
all_spans AS (
  SELECT case_id, doc_id, pii_type, value, s, e FROM k UNION ALL
  SELECT case_id, doc_id, pii_type, value, s, s + length(value) FROM name_spans),"""
    + numbering(
        "SELECT case_id, doc_id, pii_type, value FROM all_spans",
        "CAST(case_id AS VARCHAR) || '/' || CAST(doc_id AS VARCHAR)",
    )
    + f""",
subjects AS ({SUBJECTS_SQL}),
shown AS (
  SELECT doc_id, s, e, token FROM all_spans JOIN map
    ON map.scope = CAST(case_id AS VARCHAR) || '/' || CAST(doc_id AS VARCHAR)
    AND map.pii_type = all_spans.pii_type AND map.value = all_spans.value
  WHERE NOT EXISTS (SELECT 1 FROM subjects u WHERE u.case_id = all_spans.case_id AND u.pii_type = all_spans.pii_type
    AND u.value = all_spans.value)),"""
    + rewriting("SELECT * FROM shown")
)

_CHOSEN = "entity IN ('PL_PESEL', 'EMAIL_ADDRESS')"

SQL: dict[str, str] = {
    "read_documents": "SELECT doc_id, text FROM documents",
    "read_table": "SELECT * FROM customer",
    "write_documents": q(_DOC_TOKENS, "SELECT doc_id, text FROM done"),
    "mapping_export": q(
        _NOTE_VALUES,
        "SELECT scope, (ordinal - 1) // 1000 AS part, CAST(to_json({'entries': list(" + _JSON_ENTRY
        + " ORDER BY pii_type, ordinal)}) AS VARCHAR) AS mapping_json FROM map GROUP BY ALL",
    ),
    "mapping_import": q(_NOTE_VALUES, MAP),
    "mapping_vault": q(
        kept(NOTES_SQL, POLISH) + "," + numbering("SELECT doc_id, pii_type, value FROM k", "CAST(doc_id AS VARCHAR)"),
        MAP,
    ),
    "write_report": q(
        findings(NOTES_SQL, POLISH),
        'SELECT doc_id, entity AS entity_type, s AS start, e AS "end", round(score, 2) AS score, detector FROM f',
    ),
    "findings_per_detector": q(
        findings(EVERYTHING_SQL, POLISH, **ALL_OPTIONS),
        "SELECT source, lang, detector, count(*) AS n FROM f GROUP BY ALL",
    ),
    "detect_opt_in": q(findings(NOTES_SQL, POLISH_ALL), f"SELECT {FINDING} FROM f"),
    "findings_relabelled": q(
        findings(NOTES_SQL, POLISH_ALL), "SELECT entity, pii_type, count(*) AS n FROM f GROUP BY ALL"
    ),
    "context_override": q(
        findings(
            NOTES_SQL, ["pl_pesel", "pl_nip"],
            context={"pl_pesel": ["zgłoszenie", "ewidencyjny"], "pl_nip": []},
        ),
        f"SELECT {FINDING} FROM f",
    ),
    "detect_custom": q(findings(NOTES_SQL, ["customer_id", "email"]), f"SELECT {FINDING} FROM f"),
    "detect_excluding": q(findings(NOTES_SQL, BASE), "SELECT detector, count(*) AS n FROM f GROUP BY ALL"),
    "tokenize_whitelist": q(
        tokenized(NOTES_SQL, POLISH, where="entity IN ('PL_PESEL', 'EMAIL_ADDRESS')"), "SELECT doc_id, text FROM done"
    ),
    "tokenize_others_masked": q(
        kept(NOTES_SQL, POLISH) + "," + numbering(f"SELECT pii_type, value FROM k WHERE {_CHOSEN}") + "," + rewriting(
            f"SELECT doc_id, s, e, CASE WHEN {_CHOSEN} THEN token ELSE '<' || entity || '>' END AS token "
            "FROM k LEFT JOIN map USING (pii_type, value)"
        ),
        "SELECT doc_id, text FROM done",
    ),
    "tokenize_others_by_entity": q(
        kept(NOTES_SQL, POLISH) + "," + numbering("SELECT pii_type, value FROM k WHERE entity = 'PL_PESEL'") + "," + rewriting(
            "SELECT doc_id, s, e, CASE entity WHEN 'PL_PESEL' THEN token WHEN 'CREDIT_CARD' THEN '****' || right(value, 4) "
            "WHEN 'EMAIL_ADDRESS' THEN sha256('salt:' || value) ELSE '<' || entity || '>' END AS token "
            "FROM k LEFT JOIN map USING (pii_type, value)"
        ),
        "SELECT doc_id, text FROM done",
    ),
    "tokenize_threshold": q(
        nested("f0", findings(NOTES_SQL, POLISH_ALL), "SELECT * FROM f WHERE score >= 0.75") + ","
        + kept(NOTES_SQL, POLISH_ALL).replace("FROM f GROUP BY", "FROM f0 GROUP BY") + ","
        + numbering("SELECT pii_type, value FROM k") + ","
        + rewriting("SELECT doc_id, s, e, token FROM k JOIN map USING (pii_type, value)"),
        "SELECT doc_id, text FROM done",
    ),
    "detect_languages": q(
        findings(
            f"SELECT doc_id, CASE WHEN lang = 'pl' THEN 'pl' ELSE 'en' END AS lang, text FROM ({LANGUAGES_SQL})",
            POLISH, other_langs=["en"],
        ),
        f"SELECT {FINDING} FROM f",
    ),
    "known_after": q(
        nested("k", kept(CASES_SQL, POLISH, key="case_id, doc_id"), "SELECT * FROM k") + "," + _NAME_SPANS + """,
all_spans AS (
  SELECT doc_id, pii_type, value, s, e FROM k UNION ALL
  SELECT doc_id, pii_type, value, s, s + length(value) FROM name_spans n WHERE NOT EXISTS (
    SELECT 1 FROM k WHERE k.doc_id = n.doc_id AND k.s < n.s + length(n.value) AND n.s < k.e)),"""
        + numbering("SELECT pii_type, value FROM all_spans") + ","
        + rewriting("SELECT doc_id, s, e, token FROM all_spans JOIN map USING (pii_type, value)"),
        "SELECT doc_id, text FROM done",
    ),
    "tokenize_unkeyed": q(
        _DOC_TOKENS + f", unkeyed AS ({UNKEYED_SQL.replace('FROM documents', 'FROM done')})",
        "SELECT doc_id, text FROM unkeyed",
    ),
    "tokenize_literals": f"SELECT doc_id, text FROM ({LITERALS_SQL})",
    "stream_literals": f"SELECT doc_id, text FROM ({LITERALS_SQL})",
    "detect_all": q(findings(EVERYTHING_SQL, POLISH, **ALL_OPTIONS), f"SELECT source, {FINDING} FROM f"),
    "detect_multilingual": q(findings(ROUTED_SQL, POLISH, **ALL_OPTIONS), f"SELECT {FINDING} FROM f"),
    "detect_offsets": q(
        findings(DOCUMENTS_SQL, CROSS, **ALL_OPTIONS),
        'SELECT doc_id, detector, s AS start, e AS "end", substr(text, s + 1, e - s) AS value, true AS matches FROM f',
    ),
    "detect_rejected": q(
        shapes(EVERYTHING_SQL, POLISH, **ALL_OPTIONS),
        "SELECT detector, count(*) FILTER (WHERE valid) AS accepted, count(*) FILTER (WHERE NOT valid) AS rejected "
        "FROM checked GROUP BY detector",
    ),
    "context_boost": q(
        findings(NOTES_SQL, POLISH_ALL),
        "SELECT detector, pattern_score, round(score, 6) AS score, count(*) AS n FROM f GROUP BY ALL",
    ),
    "score_threshold": q(findings(NOTES_SQL, POLISH), f"SELECT {FINDING} FROM f WHERE f.score >= 0.75"),
    "entity_filter": q(findings(NOTES_SQL, ["pl_iban", "pl_phone"]), f"SELECT {FINDING} FROM f"),
    "resolve_overlaps": q(kept(NOTES_SQL, POLISH_ALL), f"SELECT {FINDING} FROM k"),
    "findings_sorted": q(
        findings(DOCUMENTS_SQL, CROSS, **ALL_OPTIONS), f"SELECT {FINDING} FROM f ORDER BY doc_id, s, e, detector"
    ),
    "allocate_tokens": q(_NOTE_VALUES, "SELECT scope, pii_type, token, value FROM map"),
    "allocate_ordinals": q(_NOTE_VALUES, MAP),
    "extend_mapping": q(
        nested("v", kept(NOTES_SQL, POLISH), "SELECT DISTINCT pii_type, value FROM k")
        + ","
        + nested("d", findings(DOCUMENTS_SQL, CROSS, **ALL_OPTIONS), "SELECT DISTINCT pii_type, value FROM f")
        + f""",
old AS (SELECT pii_type, value, row_number() OVER (PARTITION BY pii_type ORDER BY sha256(value), value) AS ordinal
  FROM d),
fresh AS (SELECT pii_type, value, row_number() OVER (PARTITION BY pii_type ORDER BY sha256(value), value)
    + coalesce((SELECT max(ordinal) FROM old WHERE old.pii_type = v.pii_type), 0) AS ordinal
  FROM v WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.pii_type = v.pii_type AND old.value = v.value)),
full_map AS (SELECT * FROM old UNION ALL SELECT * FROM fresh)""",
        f"SELECT 'corpus' AS scope, pii_type, ordinal, {TOKEN} AS token, value FROM full_map",
    ),
    "preseed_values": q(
        kept(NOTES_SQL, POLISH) + "," + numbering(
            f"SELECT pii_type, value FROM k UNION ALL SELECT 'PERSON', name FROM ({NAMES_SQL})"
        ),
        MAP,
    ),
    "allocate_per_document": q(
        kept(NOTES_SQL, POLISH) + "," + numbering("SELECT doc_id, pii_type, value FROM k", "CAST(doc_id AS VARCHAR)"),
        MAP,
    ),
    "mapping_size": q(_NOTE_VALUES, "SELECT scope, pii_type, count(*) AS n FROM map GROUP BY ALL"),
    "token_consistency": q(
        kept(NOTES_SQL, POLISH),
        "SELECT pii_type, count(DISTINCT value) AS values, count(DISTINCT value) AS tokens, count(*) AS uses, "
        "CAST(0 AS BIGINT) AS inconsistent FROM k GROUP BY pii_type",
    ),
    "tokenize_documents": q(_DOC_TOKENS, "SELECT doc_id, lang, text FROM done"),
    "tokenize_notes": q(tokenized(NOTES_SQL, POLISH_ALL), "SELECT doc_id, text FROM done"),
    "tokenize_columns": q(
        PEOPLE + "," + numbering("SELECT pii_type, value FROM filled"),
        f"SELECT {_PERSON_COLUMNS}, p.notes FROM people p {_PERSON_JOINS}",
    ),
    "tokenize_table": q(
        TABLE_SQL, f"SELECT {_PERSON_COLUMNS}, d.text AS notes FROM people p {_PERSON_JOINS} JOIN done d ON d.doc_id = p.id"
    ),
    "replace_known_values": q(
        _NAME_SPANS + "," + numbering("SELECT pii_type, value FROM name_spans") + "," + rewriting(
            "SELECT doc_id, s, s + length(value) AS e, token FROM name_spans JOIN map USING (pii_type, value)"
        ),
        "SELECT doc_id, text FROM done",
    ),
    "tokenize_custom": q(tokenized(NOTES_SQL, [*POLISH, "customer_id"]), "SELECT doc_id, text FROM done"),
    "known_long_list": q(
        _NAME_SPANS.replace(f"names AS ({NAMES_SQL})", f"names AS (SELECT case_id, name FROM ({CASES_SQL}), ({ALL_NAMES_SQL}) WHERE contains(text, name) GROUP BY ALL)")
        + "," + numbering("SELECT pii_type, value FROM name_spans") + "," + rewriting(
            "SELECT doc_id, s, s + length(value) AS e, token FROM name_spans JOIN map USING (pii_type, value)"
        ),
        "SELECT doc_id, text FROM done",
    ),
    "restore_documents": "SELECT doc_id, lang, text FROM documents",
    "restore_from_saved": q(f"src AS ({NOTES_SQL})", "SELECT doc_id, text FROM src"),
    "restore_table": TYPED_SQL,
    "restore_selected": q(
        kept(NOTES_SQL, POLISH) + "," + numbering("SELECT pii_type, value FROM k") + ","
        + f"subjects AS ({SUBJECTS_SQL})," + rewriting(
            "SELECT doc_id, s, e, token FROM k JOIN map USING (pii_type, value) WHERE NOT EXISTS "
            "(SELECT 1 FROM subjects u WHERE u.pii_type = k.pii_type AND u.value = k.value)"
        ),
        "SELECT doc_id, text FROM done",
    ),
    "round_trip_check": "SELECT CAST(0 AS BIGINT) AS differences",
    "tokenize_json": q(
        tokenized(
            f"SELECT {_LEAF_KEY} AS doc_id, 'pl' AS lang, text, id, leaf FROM ({LEAVES_SQL})", POLISH
        ),
        "SELECT c.id, 'send_email' AS tool, r.text AS recipient, s.text AS subject, b.text AS body, "
        "'bez danych' AS footer, t.text AS tag, c.amount, true AS urgent "
        f"FROM ({CALLS_SQL}) c JOIN done r ON r.id = c.id AND r.leaf = 'recipient' "
        "JOIN done s ON s.id = c.id AND s.leaf = 'subject' JOIN done b ON b.id = c.id AND b.leaf = 'body' "
        "JOIN done t ON t.id = c.id AND t.leaf = 'tag'",
    ),
    "tokenize_payloads": q(
        tokenized(
            f"SELECT {_LEAF_KEY} AS doc_id, 'pl' AS lang, text, id, leaf FROM ({LEAVES_SQL})", POLISH
        ),
        "SELECT c.id, " + _loose("r.text", "s.text", "b.text", "t.text")
        + f" AS payload FROM ({CALLS_SQL}) c JOIN done r ON r.id = c.id AND r.leaf = 'recipient' "
        "JOIN done s ON s.id = c.id AND s.leaf = 'subject' JOIN done b ON b.id = c.id AND b.leaf = 'body' "
        "JOIN done t ON t.id = c.id AND t.leaf = 'tag'",
    ),
    "restore_payloads": "SELECT id, " + _loose("recipient", "subject", "body", "tag") + f" AS payload FROM ({CALLS_SQL}) c",
    "restore_json": f"SELECT *, 'bez danych' AS footer, true AS urgent FROM ({CALLS_SQL})",
    "tokenize_json_numbers": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type FROM events",
    "audit_report": q(
        findings(NOTES_SQL, POLISH),
        'SELECT doc_id, entity AS entity_type, s AS start, e AS "end", round(score, 2) AS score, detector, '
        "value AS value_preview FROM f WHERE f.score >= 0.4",
    ),
    "audit_summary": q(
        findings(EVERYTHING_SQL, POLISH, **ALL_OPTIONS),
        "SELECT entity AS entity_type, count(*) AS n FROM f GROUP BY entity ORDER BY n DESC, entity_type",
    ),
    "audit_total": q(
        findings(EVERYTHING_SQL, POLISH, **ALL_OPTIONS), "SELECT count(*) AS n FROM f WHERE f.score >= 0.75"
    ),
    "audit_diff": (
        f"WITH b AS (WITH {_DIFF_BEFORE.strip()} SELECT doc_id, entity, s, e, max(score) AS score FROM f GROUP BY ALL), "
        f"a AS (WITH {_DIFF_AFTER.strip()} SELECT doc_id, entity, s, e, max(score) AS score FROM f GROUP BY ALL) "
        'SELECT doc_id, entity, s AS start, e AS "end", CASE WHEN b.score IS NULL THEN \'added\' '
        "WHEN a.score IS NULL THEN 'removed' ELSE 'rescored' END AS change, round(b.score, 6) AS score_before, "
        "round(a.score, 6) AS score_after FROM b FULL OUTER JOIN a USING (doc_id, entity, s, e) "
        "WHERE b.score IS DISTINCT FROM a.score"
    ),
    "audit_rejected": q(
        shapes(EVERYTHING_SQL, POLISH, **ALL_OPTIONS),
        "SELECT detector, count(*) AS n, count(DISTINCT value) AS n_values FROM checked WHERE NOT valid GROUP BY detector",
    ),
    "audit_overlaps": q(
        kept(NOTES_SQL, POLISH_ALL),
        "SELECT detector, count(*) AS n FROM f ANTI JOIN k USING (doc_id, s, e, detector) GROUP BY detector",
    ),
    "bag_of_words": q(
        _DOC_TOKENS,
        f"SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_WORDS}) AS term FROM done) GROUP BY ALL",
    ),
    "cosine_scores": q(
        scores(_BENCH, DOCUMENTS_SQL), "SELECT query_id, doc_id, round(score, 6) AS score FROM sc"
    ),
    "retrieve_topk": q(
        scores(_BENCH, DOCUMENTS_SQL)
        + ", every AS (SELECT query_id, doc_id, coalesce(score, 0) AS score FROM (SELECT query_id, doc_id FROM asked, "
        "answering) LEFT JOIN sc USING (query_id, doc_id)), " + _TOP.format("every"),
        "SELECT query_id, rank, doc_id, round(score, 6) AS score FROM top",
    ),
    "tokenize_queries": q(
        _NOTE_VALUES
        + ", asked AS (SELECT c_custkey AS query_id, 'klient' || CAST(c_custkey AS VARCHAR) || '@example.pl' AS mail, "
        "c_mktsegment FROM customer)",
        "SELECT query_id, 'Jakie sprawy zgłosił klient ' || coalesce(token, '[EMAIL_000]') || ' w segmencie ' "
        "|| c_mktsegment || '?' AS text FROM asked LEFT JOIN map ON map.pii_type = 'EMAIL' AND map.value = mail",
    ),
    "build_prompts": q(
        scores(_BENCH, DOCUMENTS_SQL) + ", " + _TOP.format("sc") + ", " + prompts(), "SELECT query_id, prompt FROM prompts"
    ),
    "batch_corpus": q(_NOTE_TOKENS, "SELECT doc_id, text, CAST(0 AS BIGINT) AS differences FROM done"),
    "retrieval_with_redaction": q(
        nested("src", f"src AS ({DOCUMENTS_SQL})", "SELECT * FROM src") + ","
        + nested("tokenized", _DOC_TOKENS, "SELECT doc_id, text FROM done") + ","
        + scores(_BENCH, "SELECT * FROM tokenized") + ", " + _TOP.format("sc") + ", " + prompts("src"),
        "SELECT query_id, prompt AS text FROM prompts",
    ),
    "subject_access": q(_SUBJECT_TEXT, "SELECT case_id, doc_id, text FROM done"),
    "subject_access_artifacts": q(
        _SUBJECT_TEXT,
        "SELECT 'external_delivery' AS artifact, case_id, doc_id, text FROM done UNION ALL "
        "SELECT 'internal_review', case_id, doc_id, text FROM src",
    ),
    "customer_files": q(
        shapes(NOTES_SQL, POLISH_ALL),
        "SELECT detector, count(*) AS n, count(DISTINCT value) AS n_values, CAST(0 AS BIGINT) AS differences "
        "FROM checked WHERE NOT valid GROUP BY detector",
    ),
    "stream_detect": q(findings(DOCUMENTS_SQL, CROSS, **ALL_OPTIONS), f"SELECT {FINDING} FROM f"),
    "stream_tokenize": q(_DOC_TOKENS, "SELECT doc_id, lang, text FROM done"),
    "stream_batches": "SELECT doc_id, lang, text FROM documents",
    "detect_copies": q(findings(ROUTED_SQL, POLISH, **ALL_OPTIONS), f"SELECT {FINDING} FROM f"),
    "round_trip_unkeyed": "SELECT CAST(0 AS BIGINT) AS differences",
    "stream_restore": "SELECT doc_id, lang, text FROM documents",
}
SQL |= {
    f"detect_{short}": one(f"pl_{short}", NOTES_SQL)
    for short in ("pesel", "nip", "regon", "id_card", "passport", "iban", "phone", "krs", "postal_code")
}
SQL |= {f"detect_{name}": one(name, DOCUMENTS_SQL, **ALL_OPTIONS) for name in CROSS}
