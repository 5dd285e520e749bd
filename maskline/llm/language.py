"""Language by multinomial naive Bayes over hashed character n-grams (operator 7).

N-grams of one to four characters of the lower-cased text, with every run of
non-letters as one space, are hashed into BUCKETS. Counts cover all training texts;
what reaches the driver and is broadcast is one log-probability per language and
bucket. Languages beyond MAX_LANGUAGES are an error, so the table has a bound.
The n-grams of a batch of texts lie in one array, so a batch is scored by one gather for
each language and sums over the texts' stretches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskline.llm.common import map_rows, rows_of, ship

ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 16  # as many as the 16 bits kept of a hash
MAX_LANGUAGES = 300
SMOOTHING = 0.5
NO_LANGUAGE = "und"
# Texts are hashed in pieces of so many characters.
PIECE = 100_000
# From so many n-grams on, a text's counts are multiplied instead of gathered one by one.
DENSE = 2 * BUCKETS
# So many n-grams are scored at a time.
BATCH = 1 << 18

_SPACE = 32
_SALTS = {n: np.uint64(0x9E3779B97F4A7C15 * n & 0xFFFFFFFFFFFFFFFF) for n in range(1, 9)}
_letters = np.array([chr(c).isalpha() for c in range(0x30000)])


def _pieces(text: str):
    """Buckets of a text's n-grams, piece after piece; nothing if it has no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters[np.minimum(codes, len(_letters) - 1)]
    if not letter.any():
        return
    keep = letter | np.concatenate([[True], letter[:-1]])
    clean = np.where(letter, codes, _SPACE)[keep].astype(np.uint64)
    clean = np.concatenate([[_SPACE] * bool(letter[0]), clean, [_SPACE] * bool(letter[-1])]).astype(np.uint64)
    longest = max(ORDERS)
    for at in range(0, len(clean), PIECE):
        piece = clean[at : at + PIECE + longest - 1]
        starts, out, state = min(PIECE, len(piece)), [], np.zeros(len(piece), np.uint64)
        for n in range(1, longest + 1):
            m = len(piece) - n + 1
            if m <= 0:
                break
            # state[i]: hash of the n characters from i on
            state = state[:m] * np.uint64(0x100000001B3) + piece[n - 1 :]
            if n in ORDERS:
                out.append(((state[:starts] + _SALTS[n]) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48))
        yield np.concatenate(out).astype(np.int64)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    table: np.ndarray  # log-probability by bucket (row) and language (column)
    prior: np.ndarray


def fit(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> Model:
    """Learn from every row with a language and a text that has a letter."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )

    def count(batches):
        seen: dict[str, np.ndarray] = {}
        texts_of: dict[str, int] = {}
        waiting: dict[str, list] = {}
        for langs, texts in rows_of(batches):
            for name, t in zip(langs, texts):
                for number, piece in enumerate(_pieces(t)):
                    if name not in seen:
                        seen[name], texts_of[name], waiting[name] = np.zeros(BUCKETS, np.int64), 0, []
                        if len(seen) > MAX_LANGUAGES:
                            raise ValueError(f"more than {MAX_LANGUAGES} languages")
                    texts_of[name] += number == 0
                    waiting[name].append(piece)
            for name, found in waiting.items():
                if found:
                    seen[name] += np.bincount(np.concatenate(found), minlength=BUCKETS)
                    found.clear()
        for name, found in seen.items():
            at = np.flatnonzero(found)
            buckets = np.concatenate([[-1], at]).astype(np.int32)
            values = np.concatenate([[texts_of[name]], found[at]])
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(buckets)), pa.array(buckets), pa.array(values)], names=["lang", "bucket", "n"]
            )

    counted = rows.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    names = counted.where("bucket = -1").select("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(r["lang"] for r in names)
    found = counted.toArrow()
    column = {name: i for i, name in enumerate(languages)}
    where = np.array([column[x] for x in found["lang"].to_pylist()], np.int64)
    bucket, n = found["bucket"].to_numpy(), found["n"].to_numpy()
    counts, prior = np.full((BUCKETS, len(languages)), SMOOTHING), np.zeros(len(languages))
    counts[bucket[bucket >= 0], where[bucket >= 0]] += n[bucket >= 0]
    prior[where[bucket < 0]] = n[bucket < 0]
    table = np.log(counts / counts.sum(axis=0)) if languages else counts
    return Model(languages, table.astype(np.float32), np.log(prior / prior.sum()) if languages else prior)


def log_posteriors(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """One row of log prior + log likelihood per text, and whether the text has a letter."""
    like = np.repeat(model.prior[None, :], len(texts), axis=0)
    some = np.zeros(len(texts), bool)
    waiting: list[np.ndarray] = []
    rows: list[int] = []

    def settle():
        if waiting:
            grams = np.concatenate(waiting)
            starts = np.cumsum([0] + [len(w) for w in waiting[:-1]])
            for j in range(len(model.languages)):
                sums = np.add.reduceat(model.table[:, j][grams], starts, dtype=np.float64)
                np.add.at(like[:, j], rows, sums)
            waiting.clear()
            rows.clear()

    size = 0
    for i, t in enumerate(texts):
        for found in _pieces(t) if t else ():
            some[i] = True
            if len(found) >= DENSE:
                like[i] += np.bincount(found, minlength=BUCKETS) @ model.table.astype(np.float64)
                continue
            waiting.append(found)
            rows.append(i)
            size += len(found)
            if size >= BATCH:
                settle()
                size = 0
    settle()
    return like, some


def predict(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, lang_pred and score of every row.

    score is the language's share of the posterior. Null texts and texts without a
    letter are NO_LANGUAGE with score 0; so is everything if nothing was learnt. Ties go
    to the first language by name. Rows are kept one to one; other columns are not carried.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_type = rows.schema["key"].dataType.simpleString()

    def run(keys, texts):
        m = shared.value
        if not m.languages:
            return keys, [NO_LANGUAGE] * len(texts), [0.0] * len(texts)
        like, some = log_posteriors(texts, m)
        best = like.argmax(axis=1)
        top = like[np.arange(len(texts)), best]
        scores = np.where(some, 1 / np.exp(like - top[:, None]).sum(axis=1), 0.0)
        names = [m.languages[b] if s else NO_LANGUAGE for b, s in zip(best, some)]
        return keys, names, scores.tolist()

    return map_rows(rows, run, f"key {key_type}, lang_pred string, score double").withColumnRenamed("key", key)
