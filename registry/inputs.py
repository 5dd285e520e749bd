"""Inputs of the registered queries, all derived from the given tables.

The test tables hold no Polish texts, so every order becomes a note with
Polish identifiers. The SQL below means the same to Spark and to the checker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _digits(number: str, width: int) -> str:
    return f"lpad(cast({number} as string), {width}, '0')"


_NIP = _digits("o_orderkey * 6007 % 10000000000", 10)
_PARTS = {
    "pesel": _digits("o_orderkey * 7919 % 100000000000", 11),
    "nip": f"case when o_orderkey % 2 = 0 then {_NIP} else substring({_NIP}, 1, 3) || '-' || "
    f"substring({_NIP}, 4, 3) || '-' || substring({_NIP}, 7, 2) || '-' || substring({_NIP}, 9, 2) end",
    "regon": _digits("o_custkey * 10007 % 1000000000", 9),
    "id_card": f"'ABC' || {_digits('o_custkey % 1000000', 6)}",
    "passport": f"'AB' || {_digits('o_orderkey * 31 % 10000000', 7)}",
    "iban": "'PL' || "
    + _digits("98 - (o_custkey * 1000000 + 252100) % 97 + o_custkey % 2", 2)
    + " || "
    + _digits("o_custkey", 24),
    "phone": f"'+48 600 ' || {_digits('o_custkey % 1000', 3)} || ' ' || {_digits('o_custkey * 7 % 1000', 3)}",
    "krs": _digits("o_custkey * 13 % 10000000000", 10),
    "postal_code": f"{_digits('o_custkey % 100', 2)} || '-' || {_digits('o_orderkey % 1000', 3)}",
    "email": "'klient' || cast(o_custkey as string) || '@example.pl'",
    "card": "cast(4000000000000000 + o_orderkey * 999983 as string)",
}

NAME = "'Anna ' || cast({} as string) || 'ska'"
CUSTOMER_ID = "'CID-' || lpad(cast({} as string), 7, '0')"

# Context words stand before the numbers in two notes out of three.
NOTE_TEXT = (
    "case when o_orderkey % 3 = 0 then 'Zgłoszenie, numer ' else 'Mój PESEL to ' end || "
    f"({_PARTS['pesel']}) || ', NIP firmy ' || ({_PARTS['nip']}) || ', REGON ' || ({_PARTS['regon']}) "
    f"|| '. Dowód osobisty ' || ({_PARTS['id_card']}) || ', paszport ' || ({_PARTS['passport']}) "
    f"|| '. Przelewy idą na ' || ({_PARTS['iban']}) || ', kontakt: ' || ({_PARTS['email']}) || ' albo ' "
    f"|| ({_PARTS['phone']}) || '. KRS ' || ({_PARTS['krs']}) || ', kod ' || ({_PARTS['postal_code']}) "
    f"|| ', karta firmowa: ' || ({_PARTS['card']}) || '. Sprawa ' || ({CUSTOMER_ID.format('o_custkey')}) || '.'"
)
CASE_TEXT = (
    f"({NOTE_TEXT}) || ' Zgłasza ' || ({NAME.format('o_custkey')}) || ', prowadzi ' || "
    f"({NAME.format('o_custkey + 1')}) || ', zastępuje ' || ({NAME.format('o_custkey + 2')}) || "
    f"' oraz ' || ({NAME.format('o_custkey + 1')})"
)

NOTES_SQL = f"SELECT o_orderkey AS doc_id, 'pl' AS lang, {NOTE_TEXT} AS text FROM orders"
CASES_SQL = f"SELECT o_custkey AS case_id, o_orderkey AS doc_id, 'pl' AS lang, {CASE_TEXT} AS text FROM orders"
SUBJECTS_SQL = (
    f"SELECT c_custkey AS case_id, 'EMAIL' AS pii_type, 'klient' || cast(c_custkey as string) || '@example.pl' "
    f"AS value FROM customer UNION ALL SELECT c_custkey, 'PERSON', {NAME.format('c_custkey')} FROM customer"
)
NAMES_SQL = (
    f"SELECT c_custkey AS case_id, {NAME.format('c_custkey + 1')} AS name, 1 AS seq FROM customer UNION ALL "
    f"SELECT c_custkey, {NAME.format('c_custkey + 2')}, 2 FROM customer"
)
ALL_NAMES_SQL = f"SELECT {NAME.format('c_custkey')} AS name, min(c_custkey) AS seq FROM customer GROUP BY 1"
# Spanish texts stand in for Polish ones where routing by language is shown.
ROUTED_SQL = "SELECT doc_id, case when lang = 'es' then 'pl' else lang end AS lang, text FROM documents"
LANGUAGES_SQL = (
    "SELECT o_orderkey AS doc_id, case o_orderkey % 4 when 0 then 'pl' when 1 then 'en' when 2 then 'xx' end AS lang, "
    f"{NOTE_TEXT} AS text FROM orders"
)
UNKEYED_SQL = (
    "SELECT case when doc_id % 3 = 0 then null else doc_id % 7 end AS doc_id, lang, text FROM documents"
)
LITERALS_SQL = (
    "SELECT doc_id, lang, '[EMAIL_001] ' || text || ' [CREDIT_CARD_' || lpad(cast(doc_id % 9 as string), 3, '0') || "
    "'] [EMAIL_99999999999999999999] [LITERAL_001]' AS text FROM documents"
)
TYPED_SQL = (
    f"SELECT c_custkey AS id, {NAME.format('c_custkey')} AS name, 'klient' || cast(c_custkey as string) || "
    "'@example.pl' AS email, case when c_custkey % 5 = 0 then '' when c_custkey % 7 = 0 then null else "
    "lpad(cast(c_custkey * 7919 % 100000000000 as string), 11, '0') end AS pesel, c_acctbal AS balance, "
    "'Polecił klient' || cast(c_custkey + 1 as string) || '@example.pl, segment ' || c_mktsegment AS notes "
    "FROM customer"
)
CALLS_SQL = (
    f"SELECT o_orderkey AS id, 'send_email' AS tool, {_PARTS['email']} AS recipient, "
    f"'Zamówienie ' || o_orderpriority AS subject, {NOTE_TEXT} AS body, {_PARTS['card']} AS tag, o_custkey AS amount "
    "FROM orders"
)


KEYS = {
    "documents": ["doc_id"],
    "pages": ["page_id"],
    "conversations": ["conv_id", "turn"],
    "orders": ["o_orderkey"],
    "customer": ["c_custkey"],
}


# Rows of these tables are short, but a long text is made of each: a part holds this many at most,
# or the longest task would grow with the table.
PART_ROWS = {"orders": 50_000, "customer": 50_000}


def spread(df: DataFrame, *key: str, part_rows: int | None = None) -> DataFrame:
    """Give every core work: the test tables come in one piece each, real ones in many."""
    parts = df.sparkSession.sparkContext.defaultParallelism
    if part_rows is not None:
        parts = max(parts, -(-df.count() // part_rows))
    return made(df.repartition(parts, *key)) if df.rdd.getNumPartitions() < parts else df


def made(df: DataFrame) -> DataFrame:
    """The same rows, as if read from a table: Spark moves no filter past the numbering.

    It would move filters on texts before a shuffle, where a table has few pieces, and make each
    text anew wherever a filter or a column names it.
    """
    return df.withColumn("_at", F.monotonically_increasing_id()).where("_at >= 0").drop("_at")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows, *KEYS[name], part_rows=PART_ROWS.get(name)) if name in KEYS else rows


def derived(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run one of the statements above on the given tables."""
    tables = {t: table(spark, sf_dir, t) for t in ("orders", "customer", "documents") if f"FROM {t}" in sql}
    for name in tables:
        sql = sql.replace(f"FROM {name}", f"FROM {{{name}}}")
    return made(spark.sql(sql, **tables))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "text")


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, NOTES_SQL)


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, CASES_SQL)


def everything(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts: documents, pages, conversations and notes."""
    parts = [
        documents(spark, sf_dir).withColumn("source", F.lit("documents")),
        table(spark, sf_dir, "pages").select(
            F.lit("pages").alias("source"), F.col("page_id").alias("doc_id"), F.lit("en").alias("lang"),
            F.col("html").alias("text"),
        ),
        table(spark, sf_dir, "conversations").select(
            F.lit("conversations").alias("source"), (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"),
            F.lit("en").alias("lang"), "text",
        ),
        notes(spark, sf_dir).withColumn("source", F.lit("notes")),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


EVERYTHING_SQL = (
    "SELECT 'documents' AS source, doc_id, lang, text FROM documents UNION ALL "
    "SELECT 'pages', page_id, 'en', html FROM pages UNION ALL "
    "SELECT 'conversations', conv_id * 1000 + turn, 'en', text FROM conversations UNION ALL "
    f"SELECT 'notes', doc_id, lang, text FROM ({NOTES_SQL})"
)


def tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads as JSON strings, parsed with a declared schema."""
    flat = derived(spark, sf_dir, CALLS_SQL)
    payload = F.to_json(
        F.struct(
            "tool",
            F.struct(
                F.col("recipient").alias("to"),
                "subject",
                F.struct(F.array("body", F.lit("bez danych")).alias("lines")).alias("content"),
                F.create_map(F.lit("card"), F.col("tag")).alias("tags"),
                "amount",
                F.lit(True).alias("urgent"),
            ).alias("args"),
        )
    )
    schema = (
        "struct<tool:string,args:struct<to:string,subject:string,content:struct<lines:array<string>>,"
        "tags:map<string,string>,amount:bigint,urgent:boolean>>"
    )
    return made(flat.select("id", F.from_json(payload, schema).alias("payload")))


def loose_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads as JSON text whose shape and keys differ from row to row."""
    flat = derived(spark, sf_dir, CALLS_SQL)
    key = F.concat(F.lit("k"), (F.col("id") % 5).cast("string"))
    text = lambda c: F.expr(f"substring(to_json(array({c})), 2, length(to_json(array({c}))) - 2)")
    recipient, subject, body, tag = map(text, ("recipient", "subject", "body", "tag"))
    said = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    call = said('{"to": ', recipient, ', "', key, '": {"subject": ', subject, ', "lines": [', body, ', null]}, "tag": ', tag, "}")
    row = said("[", recipient, ", ", subject, ', {"', key, '": ', body, ', "n": ', F.col("amount").cast("string"), "}, ", tag, "]")
    deep = said('{"', key, '":[[', recipient, "],[", subject, ',true]],"b":', body, ',"tags":{"', key, '":', tag, "}}")
    shape = F.when(F.col("id") % 3 == 0, call).when(F.col("id") % 3 == 1, row).otherwise(deep)
    return made(flat.select("id", shape.alias("payload")))


def opened(calls: DataFrame) -> DataFrame:
    """The fields of the payloads as plain columns, for comparison."""
    args = F.col("payload.args")
    return calls.select(
        "id",
        F.col("payload.tool").alias("tool"),
        args["to"].alias("recipient"),
        args["subject"].alias("subject"),
        args["content"]["lines"][0].alias("body"),
        args["content"]["lines"][1].alias("footer"),
        args["tags"]["card"].alias("tag"),
        args["amount"].alias("amount"),
        args["urgent"].alias("urgent"),
    )
