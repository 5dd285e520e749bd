"""Word-count retrieval over tokenized texts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from maskline.functions import sql as Q
from maskline.operators.lookup import BROADCAST_BYTES, BROADCAST_ROWS, broadcast_if_small, salted_join
from maskline.sources.staging import stage

WORD_GAP = r"[^\p{L}\p{N}_]+"

# Width of a term row besides the term itself, for the size check of a broadcast.
ROW_BYTES = 64
# Cells of a block of documents x queries, and of their shared terms, held at once.
BLOCK_CELLS = 2_000_000

# Fixed value: the wording of the prompt.
PROMPT = "Pytanie: {question}\n\nKontekst:\n{context}\n\nOdpowiedź:"


def _words(text: str) -> str:
    return Q.keep(f"split(lower({Q.name(text)}), {Q.text(WORD_GAP)})", lambda w: f"{w} != ''")


def bag_of_words(docs: DataFrame, *, key: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """(key, term, tf). Counting starts before the shuffle."""
    return (
        docs.select(*key, F.explode(F.expr(_words(text))).alias("term"))
        .groupBy(*key, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def _norm(words: str) -> Column:
    """Length of the count vector, within the row: the r-th copy of a word adds 2r - 1."""

    def step(acc: str, word: str) -> str:
        copies = f"if({word} = {acc}.word, {acc}.copies + 1, 1L)"
        return Q.struct(word=word, copies=copies, total=f"{acc}.total + 2 * {copies} - 1")

    start = Q.struct(word="''", copies="0L", total="0L")
    return F.expr(f"sqrt({Q.aggregate(f'array_sort({words})', start, step)}.total)")


def _occurrences(texts: DataFrame, key: str, text: str, norm: str) -> DataFrame:
    """(key, norm, term), one row per word. The norm is computed below the explode, once per text."""
    split = texts.select(key, F.expr(_words(text)).alias("_words"))
    return split.select(key, _norm("_words").alias(norm), "_words").select(key, norm, F.explode("_words").alias("term"))


def _query_terms(queries: DataFrame, query_id: str, text: str) -> tuple[DataFrame, int]:
    terms = (
        _occurrences(queries, query_id, text, "_query_norm")
        .groupBy(query_id, "_query_norm", "term")
        .agg(F.count(F.lit(1)).alias("_query_tf"))
    )
    return stage(terms, "query-terms", F.octet_length("term") + ROW_BYTES)


def cosine_scores(
    queries: DataFrame,
    docs: DataFrame,
    *,
    query_id: str = "query_id",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(query_id, doc_id, score) of every pair that shares a word; all others score 0.

    A document's words meet the query words where they are read: the dot
    product is summed before the shuffle, and norms never leave the row.
    """
    terms, n_bytes = _query_terms(queries, query_id, text)
    return _all_scores(terms, n_bytes, docs, query_id, doc_id, text)


def _all_scores(terms: DataFrame, n_bytes: int, docs: DataFrame, query_id: str, doc_id: str, text: str) -> DataFrame:
    words = _occurrences(docs, doc_id, text, "_norm")
    terms, small = broadcast_if_small(terms, n_bytes // ROW_BYTES, n_bytes)
    if small:
        shared = words.join(terms, "term")
    else:
        shared = salted_join(words, terms, ["term"], spread=[doc_id])
    return (
        shared.groupBy(query_id, doc_id, "_query_norm", "_norm")
        .agg(F.sum("_query_tf").alias("_dot"))
        .select(query_id, doc_id, (F.col("_dot") / (F.col("_query_norm") * F.col("_norm"))).alias("score"))
    )


def leading_scores(
    queries: DataFrame,
    docs: DataFrame,
    k: int,
    *,
    query_id: str = "query_id",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Rows of `cosine_scores` among which are the k best of every query, for `top_k`.

    Documents are scored where they are read against the query terms, whose size is
    checked, and a partition hands on its own k best per query only: neither texts nor
    (query, document) pairs are shuffled. Queries whose terms exceed that size are dealt by
    their hash into blocks that do not, and the documents are read once for each block.
    """
    terms, n_bytes = _query_terms(queries, query_id, text)
    limit = min(BROADCAST_BYTES, BROADCAST_ROWS * ROW_BYTES)
    blocks = 1 if n_bytes <= limit else -(-2 * n_bytes // limit)  # half full, so that none runs over
    if blocks == 1:
        return _block_scores(terms, queries, docs, k, query_id, doc_id, text)
    block = F.pmod(F.xxhash64(query_id), F.lit(blocks)).cast("int")
    sized = terms.groupBy(block.alias("b")).agg(F.sum(F.octet_length("term") + ROW_BYTES).alias("n")).collect()  # a row per block
    found = None
    for row in sorted(sized):
        part = terms.where(block == row["b"])
        if row["n"] > limit:  # a few queries with very many words
            more = _all_scores(part, row["n"], docs, query_id, doc_id, text)
        else:
            more = _block_scores(part, queries, docs, k, query_id, doc_id, text)
        found = more if found is None else found.union(more)
    return found


def _block_scores(
    terms: DataFrame, queries: DataFrame, docs: DataFrame, k: int, query_id: str, doc_id: str, text: str
) -> DataFrame:
    """The k best documents of each partition for queries whose terms are few enough to send along."""
    schema = T.StructType(
        [
            T.StructField(query_id, queries.schema[query_id].dataType),
            T.StructField(doc_id, docs.schema[doc_id].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    known = docs.sparkSession.sparkContext.broadcast(_Asked(terms.select(query_id, "_query_norm", "term", "_query_tf").toArrow()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = known.value
        best = None
        for batch in batches:
            best = asked.better(best, batch, k)
        if best is not None and len(best):
            yield pa.RecordBatch.from_arrays(
                [
                    asked.ids.take(pa.array(best["query"].to_numpy())),
                    pa.array(best["doc"].tolist(), type=asked.doc_type),
                    pa.array(best["score"].to_numpy()),
                ],
                names=[query_id, doc_id, "score"],
            )

    return docs.select(doc_id, F.expr(_words(text)).alias("_words")).mapInArrow(score, schema)


class _Asked:
    """Query terms as arrays: for each term the queries that hold it, and how often."""

    doc_type: pa.DataType | None = None

    def __init__(self, terms: pa.Table) -> None:
        ids, norms, words, counts = (c.combine_chunks() for c in terms.columns)
        coded = ids.dictionary_encode()
        self.ids = coded.dictionary
        query = coded.indices.to_numpy(zero_copy_only=False)
        self.norms = np.ones(len(self.ids))
        self.norms[query] = norms.to_numpy(zero_copy_only=False)
        coded = words.dictionary_encode()
        self.words = coded.dictionary
        term = coded.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(term, kind="stable")
        self.query = query[order]
        self.count = counts.to_numpy(zero_copy_only=False)[order].astype("float64")
        self.size = np.bincount(term, minlength=len(self.words))
        self.first = np.cumsum(self.size) - self.size

    def better(self, best: pd.DataFrame | None, batch: pa.RecordBatch, k: int) -> pd.DataFrame | None:
        """The k best rows (query, doc, score) of each query among `best` and the batch."""
        ids, lists = batch.columns
        self.doc_type = ids.type
        if not len(self.ids) or not len(ids):
            return best
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        spelled = lists.flatten().dictionary_encode()
        if not len(spelled):
            return best
        of_doc = np.repeat(np.arange(len(ids)), lengths)
        word = spelled.indices.to_numpy(zero_copy_only=False).astype("int64")
        pairs, copies = np.unique(of_doc * len(spelled.dictionary) + word, return_counts=True)
        doc, word = np.divmod(pairs, len(spelled.dictionary))
        norms = np.sqrt(np.bincount(doc, copies.astype("float64") ** 2, len(ids)))
        term = pc.fill_null(pc.index_in(spelled.dictionary, value_set=self.words), -1).to_numpy(zero_copy_only=False)[word]
        hit = term >= 0
        doc, term, copies = doc[hit], term[hit], copies[hit]
        names = pd.Series(ids.to_pandas(integer_object_nulls=True))
        n_queries = len(self.ids)
        step = max(1, BLOCK_CELLS // max(n_queries, len(self.query)))
        for left in range(0, len(ids), step):
            right = min(left + step, len(ids))
            a, b = np.searchsorted(doc, [left, right])
            if a == b:
                continue
            size = self.size[term[a:b]]
            at = np.repeat(self.first[term[a:b]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            cell = np.repeat(doc[a:b] - left, size) * n_queries + self.query[at]
            dots = np.bincount(cell, np.repeat(copies[a:b], size) * self.count[at], (right - left) * n_queries)
            dots = dots.reshape(right - left, n_queries)
            with np.errstate(divide="ignore", invalid="ignore"):
                scores = dots / (self.norms * norms[left:right, None])
            least = np.zeros(n_queries)
            if best is not None:
                full = best.groupby("query")["score"].agg(["size", "min"])
                full = full[full["size"] >= k]
                least[full.index.to_numpy()] = full["min"].to_numpy()
            row, query = np.nonzero((dots > 0) & (scores >= least))
            more = pd.DataFrame(
                {"query": query, "doc": names.iloc[row + left].to_numpy(), "score": scores[row, query]}
            )
            both = more if best is None else pd.concat([best, more], ignore_index=True)
            both = both.sort_values(["query", "score", "doc"], ascending=[True, False, True], na_position="first")
            best = both[both.groupby("query").cumcount() < k]
        return best


def top_k(
    scores: DataFrame,
    k: int = 2,
    *,
    queries: DataFrame | None = None,
    docs: DataFrame | None = None,
    min_score: float | None = None,
    query_id: str = "query_id",
    doc_id: str = "doc_id",
) -> DataFrame:
    """(query_id, rank, doc_id, score), ties by doc_id.

    Without `min_score` a query with fewer than k scoring documents is filled
    up with documents of score 0, for which `queries` and `docs` are needed.
    """
    best_first = Window.partitionBy(query_id).orderBy(F.desc("score"), doc_id)

    def leaders(pairs: DataFrame) -> DataFrame:
        return pairs.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)

    if min_score is not None:
        return leaders(scores.where(F.col("score") >= min_score)).select(query_id, "rank", doc_id, "score")
    if queries is None or docs is None:
        raise ValueError("filling up with zero scores needs queries and docs")
    # Of the first 2k documents at least k score 0 for a query with fewer than k hits.
    first = [row[0] for row in docs.select(doc_id).orderBy(doc_id).limit(2 * k).collect()]
    padding = queries.select(
        query_id,
        F.explode(F.array(*[F.lit(d) for d in first]).cast(f"array<{docs.schema[doc_id].dataType.simpleString()}>")).alias(doc_id),
        F.lit(0.0).alias("score"),
    )
    pairs = leaders(scores).drop("rank").unionByName(padding)
    return leaders(pairs.groupBy(query_id, doc_id).agg(F.max("score").alias("score"))).select(
        query_id, "rank", doc_id, "score"
    )


def build_prompts(
    hits: DataFrame,
    queries: DataFrame,
    docs: DataFrame,
    *,
    query_id: str = "query_id",
    doc_id: str = "doc_id",
    text: str = "text",
    template: str = PROMPT,
) -> DataFrame:
    """(query_id, prompt): the question and its hits in rank order."""
    hits = hits.select(query_id, "rank", doc_id)
    width = F.lit(ROW_BYTES)
    for name in (query_id, doc_id):
        width = width + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    staged, n_bytes = stage(hits, "hits", width)
    staged, _ = broadcast_if_small(staged, n_bytes // ROW_BYTES, n_bytes)
    context = (
        docs.select(doc_id, F.col(text).alias("_hit")).join(staged, doc_id)
        .groupBy(query_id)
        .agg(F.array_sort(F.collect_list(F.struct("rank", "_hit"))).alias("_hits"))
        .select(query_id, F.expr("array_join(transform(_hits, h -> concat('- ', h._hit)), '\n')").alias("_context"))
    )
    head, rest = template.split("{question}")
    middle, tail = rest.split("{context}")
    return queries.join(context, query_id, "left").select(
        query_id,
        F.concat(
            F.lit(head), F.col(text), F.lit(middle), F.coalesce("_context", F.lit("")), F.lit(tail)
        ).alias("prompt"),
    )
