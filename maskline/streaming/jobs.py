"""The same work on streams: detect, tokenize with a growing mapping, restore.

One query may write a mapping store at a time: a second one that allocated from the same
state gets an error before it writes any text, and starts its batch again from the new state.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from maskline.catalog import Detector
from maskline.operators.detect import detect
from maskline.operators.tokenize import restore, tokenize
from maskline.sources.token_store import TokenStore


def detect_stream(
    messages: DataFrame,
    rows: Iterable[Detector],
    out: str,
    checkpoint: str,
    *,
    key: Sequence[str] = ("doc_id",),
    lang: Column | str = "lang",
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Findings of a message stream, appended to a Parquet folder. Stateless.

    `options` go to `detect`. Unless they say otherwise, a message in a language without
    detectors is searched with the common ones: an error would end the stream for good.
    """
    options.setdefault("unknown_lang", "cross")
    return (
        detect(messages, rows, key=key, lang=lang, **options)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stored_mapping(spark: SparkSession, store: str) -> DataFrame:
    """The mapping a stream has written."""
    return TokenStore(spark, store).entries()


def tokenize_batch(
    messages: DataFrame, batch_id: int, rows: Sequence[Detector], store: str, out: str, **options
) -> None:
    """One micro-batch. A replay sees the same earlier mapping, so it writes the same tokens.

    Only the buckets of the mapping that hold the batch's values are read.
    """
    kept = TokenStore(messages.sparkSession, store)
    earlier, version = kept.extend(batch_id, out)
    result = tokenize(messages, rows, mapping=earlier, **options)
    kept.commit(result.new, version, writer=out, batch=batch_id)
    result.table.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")


def tokenize_stream(
    messages: DataFrame,
    rows: Iterable[Detector],
    store: str,
    out: str,
    checkpoint: str,
    *,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Tokenize a stream; each batch commits its new entries before its texts.

    `trigger` holds the arguments of the writer's trigger (default: all there is, then stop).
    """
    rows = list(rows)
    return (
        messages.writeStream.foreachBatch(
            lambda batch, batch_id: tokenize_batch(batch, batch_id, rows, store, out, **options)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def restore_stream(
    replies: DataFrame,
    store: str,
    out: str,
    checkpoint: str,
    *,
    key: Sequence[str] = ("doc_id",),
    columns: Sequence[str] = ("text",),
    scope: Column | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Restore a stream of replies; every batch looks its tokens up in the mapping as it is by then."""

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        mapping = TokenStore(batch.sparkSession, store)
        restore(batch, mapping, key=key, columns=columns, scope=scope).write.mode("overwrite").parquet(
            f"{out}/batch_id={batch_id}"
        )

    return (
        replies.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
