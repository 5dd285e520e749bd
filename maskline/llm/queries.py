"""The operators of this package as queries over the test tables, and SQL where it can say the same."""

from __future__ import annotations

import os
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskline.llm import (
    bpe,
    centroids,
    conversations,
    decontaminate,
    extract,
    language,
    secrets,
    superminhash,
    tokencounts,
    topk,
    toxicity,
    urlfilter,
    vptree,
)
from maskline.llm.common import map_rows, staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_bpe() -> str:
    """The tokenizer file of the queries; a path in BYTE_BPE_FILE takes precedence."""
    import public_tokenizers

    return os.environ.get("BYTE_BPE_FILE") or public_tokenizers.path("byte_bpe_50k.json")


def op1_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = superminhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, num=85, den=100)
    return found.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    def written(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
            ",",
        )

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return secrets.scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(F.encode(written(F.filter("spans", lambda s: s["kind"] != "novel")), "UTF-8"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


# The rules of the URL filter query.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def op3_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlfilter.judge(table(spark, sf_dir, "pages"), rules)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    test = toxicity.held_out(F.col("doc_id"), 5, 0)
    model = toxicity.fit(docs, labels.where(~test))
    return toxicity.score(docs, model).select("doc_id", test.alias("held_out"), "score", "predicted", "passages")


def op5_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    test = toxicity.held_out(F.col("doc_id"), 4, 2)
    model = language.fit(docs.where(~test))
    return language.predict(docs, model).select("doc_id", test.alias("held_out"), "lang_pred", "score")


# What the query of op8 edits out: e-mail addresses and long digit runs. An address starts
# where a run of its characters does, so every run is read once.
REDACTED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+|[0-9]{6,}")


def redacted(text: str) -> list[tuple[int, int, str]]:
    """The edits that take addresses and long numbers out of a text."""
    return [(*m.span(), "[REDACTED]") for m in REDACTED.finditer(text)]


def redactions(docs: DataFrame) -> DataFrame:
    """doc_id, text and the edits of `redacted`, as a column."""

    def find(keys, texts):
        return keys, texts, [[{"start": a, "end": b, "new": new} for a, b, new in redacted(t or "")] for t in texts]

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text string, edits array<struct<start: int, end: int, new: string>>"
    return map_rows(docs.select("doc_id", "text"), find, schema)


def op8_tokencounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees of all texts are built and written; then e-mail addresses and long digit runs are edited out of them."""
    trees = staged(tokencounts.build(table(spark, sf_dir, "documents"), byte_bpe()), "trees")
    edited = tokencounts.edit(trees, byte_bpe(), edits=redacted)
    return edited.select("doc_id", "n_tokens_before", "n_tokens", "n_edits", "n_encoded")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), byte_bpe(), decoded=True).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op10_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_text(table(spark, sf_dir, "pages"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = F.array_join(F.transform("centroid", lambda x: x.cast("string")), ",")
    return centroids.cluster(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(digits, 256).alias("centroid_sha256")
    )


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.largest_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator's digest of the repaired text is made where the turns are, run by run."""
    found = conversations.damaged_and_repaired(table(spark, sf_dir, "conversations"))
    return found.audits.withColumnRenamed("sha256", "repaired_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_superminhash": op1_superminhash,
    "op2_secrets": op2_secrets,
    "op3_urlfilter": op3_urlfilter,
    "op4_toxicity": op4_toxicity,
    "op5_vptree": op5_vptree,
    "op6_decontaminate": op6_decontaminate,
    "op7_language": op7_language,
    "op8_tokencounts": op8_tokencounts,
    "op9_bpe": op9_bpe,
    "op10_extract": op10_extract,
    "op11_centroids": op11_centroids,
    "op12_topk": op12_topk,
    "op13_conversations": op13_conversations,
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SQL: dict[str, str] = {
    "op1_superminhash": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE
           WHEN len(ws) = 0 THEN []
           WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
           ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
         END) AS shingles
  FROM w
), flat AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM flat AS a JOIN flat AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach AS r JOIN links AS l ON l.a = r.other
)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, r.component_id, s.doc_id = r.component_id AS kept
FROM sets AS s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) AS r USING (doc_id)
""",
    "op3_urlfilter": rf"""
WITH rules (rule_host, rule_path, verdict) AS (
  VALUES {", ".join(str(r) for r in URL_RULES)}
), cut AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), parts AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_UPPER.lower()}'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut
)
SELECT p.page_id, p.host, p.path, r.rule_host || r.rule_path AS rule, coalesce(r.verdict, 'allow') AS verdict
FROM parts AS p LEFT JOIN rules AS r
  ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
QUALIFY row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule_host || r.rule_path) DESC NULLS LAST) = 1
""",
    "op12_topk": """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), one AS (
  SELECT vec_id, min(v) AS v FROM good GROUP BY vec_id
), cells AS (
  SELECT vec_id, len(v) AS dims, unnest(v) AS x, unnest(range(len(v))) AS i FROM one
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x) AS score
  FROM cells AS q JOIN cells AS c ON q.i = c.i AND q.dims = c.dims AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
  GROUP BY ALL
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id,
         CAST(score AS BIGINT) AS score
  FROM scored
)
SELECT * FROM ranked WHERE rank <= 5
""",
}


def _clusters_sql(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """Lloyd's rounds written out one after the other."""
    parts = [
        f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cells AS MATERIALIZED (
  SELECT r, unnest(v) AS x, unnest(range({dims})) AS i FROM kept
), firsts AS (
  SELECT r, row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)) NULLS LAST, v) - 1 AS c FROM kept
  QUALIFY c < {k}
), c0 AS MATERIALIZED (
  SELECT c, i, x FROM firsts JOIN cells USING (r)
)"""
    ]
    for t in range(rounds + 1):
        parts.append(
            f"""d{t} AS (
  SELECT r, c, sum((v.x - w.x) * (v.x - w.x)) AS distance FROM cells AS v JOIN c{t} AS w USING (i) GROUP BY r, c
), a{t} AS MATERIALIZED (
  SELECT * FROM d{t} QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, c) = 1
)"""
        )
        if t < rounds:
            parts.append(
                f"""m{t} AS (
  SELECT c, i, floor(CAST(sum(x) AS DOUBLE) / count(*)) AS x FROM a{t} JOIN cells USING (r) GROUP BY c, i
), c{t + 1} AS MATERIALIZED (
  SELECT o.c, o.i, CAST(coalesce(m.x, o.x) AS BIGINT) AS x FROM c{t} AS o LEFT JOIN m{t} AS m ON o.c = m.c AND o.i = m.i
)"""
            )
    return (
        "WITH "
        + ", ".join(parts)
        + f""", digests AS (
  SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c
)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN digests USING (c)
"""
    )


SQL["op11_centroids"] = _clusters_sql()

# The grammar as a machine: 0 nothing yet, 1 after s, 2 after u, 3 after a.
SQL["op13_conversations"] = r"""
WITH RECURSIVE bits AS (
  SELECT list(list_reduce(list_prepend(n, range(8)),
              lambda c, _: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)) AS n)
), source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations
), lots AS (
  SELECT s.*, xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(string_split(name, ''), lambda x: CAST(ascii(x) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) % 20 AS lot
  FROM source AS s, bits
), damaged AS (
  SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
         CASE lot WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN lot = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM lots WHERE lot <> 0
), keys AS (
  SELECT conv_id, row_number() OVER () AS k FROM (SELECT DISTINCT conv_id FROM conversations)
), placed AS (
  SELECT k, turn, role, text, left(role, 1) AS first, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ended,
         row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, text) AS i
  FROM damaged JOIN keys ON damaged.conv_id IS NOT DISTINCT FROM keys.conv_id
), faults AS (
  SELECT *, ended = '' AS blank, row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 AS seen,
         right(ended, 1) NOT IN ('.', '!', '?') AS cut, lag(first) OVER (PARTITION BY k ORDER BY i) || first AS pair
  FROM placed
), turns AS MATERIALIZED (
  SELECT *, blank OR seen AS gone, CASE WHEN NOT blank AND NOT seen AND cut THEN 1 ELSE 0 END AS extra FROM faults
), inserts (a, b, cost, letters, lines) AS (
  VALUES (0, 0, 0, '', CAST([] AS VARCHAR[])), (0, 2, 2, 'I', ['user:']), (0, 3, 4, 'II', ['user:', 'assistant:']),
         (1, 1, 0, '', []), (1, 2, 2, 'I', ['user:']), (1, 3, 4, 'II', ['user:', 'assistant:']),
         (2, 2, 0, '', []), (2, 3, 2, 'I', ['assistant:']), (3, 3, 0, '', []), (3, 2, 2, 'I', ['user:'])
), takes (b, want, c, role) AS (
  VALUES (0, 's', 1, NULL), (0, 'u', 2, 'user'), (1, 'u', 2, 'user'), (2, 'a', 3, 'assistant'), (3, 'u', 2, 'user')
), steps AS (
  SELECT a, b, cost, letters, lines, 'D' AS kind, CAST(NULL AS VARCHAR) AS want, b AS c, CAST(NULL AS VARCHAR) AS role FROM inserts
  UNION ALL
  SELECT a, b, cost, letters, lines, 'T', want, c, role FROM inserts JOIN takes USING (b)
), walk AS (
  SELECT k, CAST(0 AS BIGINT) AS i, 0 AS state, {'cost': 0, 'audit': '', 'lines': CAST([] AS VARCHAR[])} AS best FROM keys
  UNION ALL
  SELECT w.k, t.i, s.c, min({
           'cost': w.best.cost + s.cost + CASE WHEN kind = 'D' THEN 3 ELSE extra + CASE WHEN t.first = want THEN 0 ELSE 2 END END,
           'audit': w.best.audit || letters || CASE WHEN kind = 'D' THEN 'D' WHEN t.first = want THEN 'K' ELSE 'R' END,
           'lines': list_concat(list_concat(w.best.lines, s.lines), CASE WHEN kind = 'D' THEN CAST([] AS VARCHAR[])
                      ELSE [CASE WHEN t.first = want THEN t.role ELSE s.role END || ':' || t.text] END)})
  FROM walk AS w JOIN turns AS t ON t.k = w.k AND t.i = w.i + 1 JOIN steps AS s ON s.a = w.state
  WHERE kind = 'D' OR (NOT t.gone AND (t.first = want OR want <> 's'))
  GROUP BY w.k, t.i, s.c
), ends AS (
  SELECT w.k, min({'cost': w.best.cost + s.cost, 'audit': w.best.audit || s.letters, 'lines': list_concat(w.best.lines, s.lines)}) AS best
  FROM walk AS w JOIN inserts AS s ON s.a = w.state AND (s.b = 3 OR (s.a = 0 AND s.b = 0))
  WHERE w.i = (SELECT count(*) FROM turns AS t WHERE t.k = w.k)
  GROUP BY w.k
), counts AS (
  SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
         count_if(seen AND NOT blank) AS duplicate, sum(extra) AS truncated, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY k
)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(best.cost AS BIGINT) AS cost, best.audit AS audit,
       sha256(array_to_string(best.lines, chr(10))) AS repaired_sha256
FROM keys JOIN ends USING (k) LEFT JOIN counts USING (k)
"""
