"""A corpus from raw documents to token ids: five stages, each one operator.

Every stage but the last returns the columns it was given. Null texts are texts
without words: they pass the filters, have no near-duplicates and no secrets, and end
with no tokens. Empty tables pass through. Extra columns are carried to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskline.llm import bpe, decontaminate, secrets, superminhash, toxicity
from maskline.llm.common import staged
from maskline.llm.queries import byte_bpe, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learnt from the labels, scores below one half.

    As in the query of the operator, labels of the held-out fifth of keys are not used.
    """
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id"), 5, 0))
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (least doc_id) of each group linked by 0.8 of their five-word shingles."""
    return superminhash.keep_one(docs, words=5, num=80, den=100)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced by a mark; n_chars is counted anew."""
    clean = secrets.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars")))
    return clean


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and the digests of ids and of the decoded text."""
    return bpe.encode(docs, byte_bpe(), decoded=True).select(
        "doc_id",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("bpe", token_ids),
]

# Learnt scores, signatures and token ids are not for SQL; tests/llm holds the stages
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
