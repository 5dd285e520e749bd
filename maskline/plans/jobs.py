"""Ready-made jobs: a corpus, retrieval, subject-access delivery, customer files."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskline.catalog import Detector, detectors
from maskline.operators import retrieve as R
from maskline.operators.detect import look_alikes
from maskline.operators.audit import rejected
from maskline.operators.known import KNOWN, attach_known
from maskline.operators.tokenize import Tokenized, restore, round_trip_differences, tokenize
from maskline.sources.mapping_store import export_json, import_json, save_to_vault
from maskline.sources.staging import stage


@dataclass(frozen=True)
class Batch:
    documents: DataFrame
    mapping: DataFrame
    restored: DataFrame
    differences: DataFrame


def batch(
    docs: DataFrame, rows: Iterable[Detector], *, key: Sequence[str] = ("doc_id",), lang: Column | str = "lang"
) -> Batch:
    """Tokenize a corpus into one mapping, save that as JSON, restore from the saved form, compare."""
    result = tokenize(docs, rows, key=key, lang=lang)
    written, _ = stage(result.table, "documents")
    saved, _ = stage(export_json(result.mapping), "mapping-json")
    mapping = import_json(saved)
    restored = restore(written, mapping, key=key, columns=["text"])
    return Batch(written, mapping, restored, round_trip_differences(docs, restored, key, ["text"]))


@dataclass(frozen=True)
class Retrieval:
    index: DataFrame
    mapping: DataFrame
    questions: DataFrame
    hits: DataFrame
    prompts: DataFrame


def retrieval(
    docs: DataFrame,
    queries: DataFrame,
    rows: Iterable[Detector],
    *,
    k: int = 2,
    min_score: float | None = None,
    lang: Column | str = "lang",
    query_lang: Column | str = "lang",
) -> Retrieval:
    """Tokenize at ingest, tokenize the questions alike, rank, build prompts without raw values."""
    rows = list(rows)
    ingested = tokenize(docs, rows, lang=lang)
    index, _ = stage(ingested.table, "index")
    mapping, _ = stage(ingested.mapping, "mapping")
    asked = tokenize(queries, rows, key=["query_id"], lang=query_lang, mapping=mapping)
    questions, _ = stage(asked.table, "questions")
    scores = R.leading_scores(questions, index, k)
    hits = R.top_k(scores, k, queries=questions, docs=index, min_score=min_score)
    return Retrieval(index, asked.mapping, questions, hits, R.build_prompts(hits, questions, index))


def answers(replies: DataFrame, mapping: DataFrame, *, key: Sequence[str] = ("query_id",)) -> DataFrame:
    """Replies to the prompts, with values back in place for the reader."""
    return restore(replies, mapping, key=key, columns=["text"])


def deliver_to_subjects(
    docs: DataFrame,
    subject_values: DataFrame,
    known_names: DataFrame,
    rows: Iterable[Detector],
    *,
    lang: Column | str = "lang",
    vault: str | None = None,
) -> Tokenized:
    """Subject-access copies: a case's subject stays visible, everybody else is tokenized.

    `docs` has case_id, doc_id, text; `subject_values` case_id, value, pii_type;
    `known_names` case_id, name, seq. Every document has a mapping of its own,
    which goes to the vault if one is named.
    """
    names = known_names.select(
        "case_id", F.col("name").alias("value"), F.lit("PERSON").alias("pii_type"), "seq"
    )
    listed = attach_known(docs, names, ["case_id"], spread=["doc_id"])
    result = tokenize(
        listed,
        rows,
        key=["case_id", "doc_id"],
        lang=lang,
        scope=case_scope(),
        known=KNOWN,
        visible=subject_values.select("case_id", "pii_type", "value").distinct(),
        keep_visible_on=["case_id", "pii_type", "value"],
    )
    if vault is not None:
        save_to_vault(result.mapping, vault)
    return Tokenized(result.table.drop(KNOWN), result.mapping, result.spans, result.new)


def case_scope() -> Column:
    """case/doc; slashes and backslashes inside and nulls are spelled so that no two pairs read alike."""

    def part(name: str) -> Column:
        spelled = F.replace(F.replace(F.col(name).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("/"), F.lit("\\/"))
        return F.coalesce(spelled, F.lit("\\0"))

    return F.concat(part("case_id"), F.lit("/"), part("doc_id"))


def subject_access_artifacts(docs: DataFrame, delivered: DataFrame) -> DataFrame:
    """The unredacted copy for internal review beside the copy for the subject."""
    columns = ["case_id", "doc_id", "text"]
    return (
        docs.select(F.lit("internal_review").alias("artifact"), *columns)
        .unionByName(delivered.select(F.lit("external_delivery").alias("artifact"), *columns))
    )


@dataclass(frozen=True)
class CustomerFiles:
    documents: DataFrame
    mapping: DataFrame
    refused: DataFrame
    differences: DataFrame


def customer_files(docs: DataFrame, *, key: Sequence[str] = ("doc_id",), lang: Column | str = "lang") -> CustomerFiles:
    """Know-your-customer documents: all Polish detectors, refused numbers, round trip."""
    rows = detectors(["pl"], include_opt_in=True)
    result = tokenize(docs, rows, key=key, lang=lang)
    written, _ = stage(result.table, "documents")
    mapping, _ = stage(result.mapping, "mapping")
    restored = restore(written, mapping, key=key, columns=["text"])
    return CustomerFiles(
        written,
        mapping,
        rejected(look_alikes(docs, rows, key=key, lang=lang)),
        round_trip_differences(docs, restored, key, ["text"]),
    )
