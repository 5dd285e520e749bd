"""BPE encoding and decoding through a table of distinct words (operator 9).

A text's ids are its words' ids, so each word needs the tokenizer only once:

1. Every task splits its texts and lists the distinct words of a chunk (about
   CHUNK_CHARS characters), dealt by word hash into shards of the word table.
2. A shard meets the lists of all chunks, encodes each distinct word once, and
   answers every list with the ids in the list's own order.
3. The answers of a chunk meet its texts, kept as word positions, and ids are
   joined back by position.

Texts themselves are never shuffled, only compressed positions and distinct words.
A frequent word costs one entry per chunk, not one per occurrence. Chunks are
recognized by a digest of their words: if the input came back in another order
between the two readings (a source that is no stable table), the job fails
instead of mixing texts up; stage such an input first.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from maskline.llm.common import rows_of, ship
from maskline.llm.pretokens import codec, tokenizer_source

CHUNK_CHARS = 4_000_000
_ROW = pa.schema([("chunk", pa.string()), ("part", pa.int32()), ("payload", pa.binary())])


def _pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays, each as byte planes, compressed; 8 bytes of length before each."""
    raw = b"".join(
        np.int64(a.size).tobytes() + a.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for a in arrays
    )
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(data: bytes) -> list[np.ndarray]:
    raw, out, at = zstandard.ZstdDecompressor().decompress(data), [], 0
    while at < len(raw):
        n = int(np.frombuffer(raw, np.int64, 1, at)[0])
        planes = np.frombuffer(raw, np.uint8, 4 * n, at + 8).reshape(4, n)
        out.append(np.ascontiguousarray(planes.T).view("<u4").reshape(-1))
        at += 8 + 4 * n
    return out


def _pack_words(words: list[bytes]) -> bytes:
    lengths = np.array([len(w) for w in words], "<u4")
    raw = np.int64(len(words)).tobytes() + lengths.tobytes() + b"".join(words)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack_words(data: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    ends = (8 + 4 * n + np.cumsum(np.frombuffer(raw, "<u4", n, 8).astype(np.int64))).tolist()
    return [raw[a:b] for a, b in zip([8 + 4 * n, *ends[:-1]], ends)]


def _chunks(batches):
    """(keys, texts) of about CHUNK_CHARS characters, in the order of the partition."""
    keys, texts, total = [], [], 0
    for some_keys, some_texts in rows_of(batches):
        for key, text in zip(some_keys, some_texts):
            keys.append(key)
            texts.append(text or "")
            total += len(texts[-1])
            if total >= CHUNK_CHARS:
                yield keys, texts
                keys, texts, total = [], [], 0
    if keys:
        yield keys, texts


def _shards(words, parts: int) -> list[list[bytes]]:
    """Distinct words dealt to shards by hash, sorted inside each."""
    shards: list[list[bytes]] = [[] for _ in range(parts)]
    for word in words:
        data = word.encode("utf-8")
        shards[zlib.crc32(data) % parts].append(data)
    for shard in shards:
        shard.sort()
    return shards


def _name(number: int, shards: list[list[bytes]]) -> str:
    digest = 0
    for words in shards:
        digest = zlib.crc32(b" ".join(words), digest)
    return f"{TaskContext.get().partitionId()}-{number}-{digest:08x}"


def _text_of(ids: np.ndarray, pieces: list[bytes]) -> str:
    """Ids joined to their pieces; ids outside the table yield nothing, bytes that are no UTF-8 become U+FFFD."""
    if ids.size and ids.max() >= len(pieces):
        ids = ids[ids < len(pieces)]
    return b"".join([pieces[i] for i in ids.tolist()]).decode("utf-8", "replace")


def encode(
    docs: DataFrame,
    tokenizer: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    parts: int | None = None,
    decoded: bool = False,
) -> DataFrame:
    """Token ids of every text: key, n_tokens (long), ids (binary).

    `tokenizer` is the path of a byte-level BPE file. `ids` holds little-endian
    unsigned 32-bit integers. Special tokens are not added; their strings in a text
    are encoded as that token. One row per input row, repeated and null keys
    included; null and empty texts have no ids. Other columns are not carried.
    With `decoded` the column decoded holds the ids' text as `decode` gives it, made
    where the ids are put together, so that they need not be passed on once more.
    """
    spark = docs.sparkSession
    ship(spark)
    source = spark.sparkContext.broadcast(tokenizer_source(tokenizer))
    own = codec(source.value)  # an unsupported file fails here, not in a task
    pieces = spark.sparkContext.broadcast(own.pieces()) if decoded else None
    n_parts = parts or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_type = rows.schema["key"].dataType.simpleString()

    def ask(batches):
        words_of = codec(source.value).words
        for number, (_, texts) in enumerate(_chunks(batches)):
            distinct = {}
            for t in texts:
                distinct.update(dict.fromkeys(words_of(t)))
            shards = _shards(distinct, n_parts)
            name, packed = _name(number, shards), [_pack_words(s) for s in shards]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * n_parts), pa.array(range(n_parts), pa.int32()), pa.array(packed, pa.binary())],
                schema=_ROW,
            )

    def answer(batches):
        ids_of, known = codec(source.value).ids, {}
        for batch in batches:
            out = []
            for data in batch.column(2).to_pylist():
                answers = []
                for word in _unpack_words(data):
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = np.array(ids_of(word.decode("utf-8")), "<u4")
                    answers.append(ids)
                lengths = np.array([len(a) for a in answers], "<u4")
                out.append(_pack(lengths, np.concatenate(answers) if answers else lengths))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], schema=_ROW)

    def place(batches):
        words_of = codec(source.value).words
        for number, (keys, texts) in enumerate(_chunks(batches)):
            index, at, counts = {}, [], []
            for t in texts:
                words = words_of(t)
                at.append(np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words)))
                counts.append(len(words))
            shards = _shards(index, n_parts)
            order = np.fromiter((index[w.decode("utf-8")] for s in shards for w in s), np.int64, len(index))
            rank = np.empty(len(index), np.int64)
            rank[order] = np.arange(len(index))
            payload = _pack(np.array(counts, "<u4"), rank[np.concatenate(at)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_name(number, shards)]),
                    pa.array([-1], pa.int32()),
                    pa.array([payload], pa.binary()),
                    pa.array([keys], placed_schema.field("keys").type),
                ],
                schema=placed_schema,
            )

    def join_back(table: pa.Table) -> pa.Table:
        order = table.sort_by("part")
        parts_seen = order["part"].to_pylist()
        if parts_seen != [-1, *range(n_parts)]:
            raise RuntimeError("the texts changed between two readings; stage the input of encode() first")
        payloads = order["payload"].to_pylist()
        counts, at = _unpack(payloads[0])
        answers = [_unpack(p) for p in payloads[1:]]
        lengths = np.concatenate([a[0] for a in answers]).astype(np.int64)
        flat = np.concatenate([a[1] for a in answers])
        starts = np.cumsum(lengths) - lengths
        ends = np.cumsum(counts.astype(np.int64))
        ids, totals, texts, begin = [], [], [], 0
        for end in ends.tolist():
            own = at[begin:end]
            size = lengths[own]
            shift = starts[own] - (np.cumsum(size) - size)
            took = np.repeat(shift, size) + np.arange(int(size.sum()))
            own_ids = flat[took]
            ids.append(own_ids.tobytes())
            if decoded:
                texts.append(_text_of(own_ids, pieces.value))
            totals.append(len(took))
            begin = end
        keys = order["keys"].slice(0, 1).combine_chunks().flatten()
        columns = {key: keys, "n_tokens": pa.array(totals, pa.int64()), "ids": pa.array(ids, pa.binary())}
        return pa.table(columns | ({"decoded": pa.array(texts, pa.string())} if decoded else {}))

    plain = "chunk string, part int, payload binary"
    placed = f"{plain}, keys array<{key_type}>"
    placed_schema = to_arrow_schema(StructType.fromDDL(placed))
    answered = rows.mapInArrow(ask, plain).repartition(n_parts, "part").mapInArrow(answer, plain)
    chunks = rows.mapInArrow(place, placed).unionByName(answered, allowMissingColumns=True)
    schema = f"`{key}` {key_type}, n_tokens bigint, ids binary" + ", decoded string" * decoded
    return chunks.groupBy("chunk").applyInArrow(join_back, schema)


def unpacked(ids) -> F.Column:
    """Packed `ids` as array<bigint>."""
    words = F.filter(F.split(F.hex(ids), "(?<=\\G.{8})"), lambda x: x != "")
    order = (7, 5, 3, 1)
    return F.transform(
        words, lambda w: F.conv(F.concat(*[F.substring(w, k, 2) for k in order]), 16, 10).cast("bigint")
    )


def decode(encoded: DataFrame, tokenizer: str, *, key: str = "doc_id", ids: str = "ids", keep: tuple = ()) -> DataFrame:
    """Texts of packed ids: key, decoded (string), and the columns named in `keep`.

    The id-to-piece table has one entry per vocabulary id (its size is the
    tokenizer's, whatever the data), so it is broadcast and joined where the ids
    are. Ids outside the vocabulary yield nothing; bytes that are no UTF-8 become
    U+FFFD. Null ids give a null text.
    """
    spark = encoded.sparkSession
    ship(spark)
    pieces = spark.sparkContext.broadcast(codec(tokenizer_source(tokenizer)).pieces())
    rows = encoded.select(key, *keep, F.col(ids).alias("_ids"))
    schema = rows.drop("_ids").withColumn("decoded", F.lit("")).schema

    arrow = to_arrow_schema(schema)

    def run(batches):
        table = pieces.value
        for *kept, packed in rows_of(batches, "_ids"):
            texts = [None if data is None else _text_of(np.frombuffer(data, "<u4"), table) for data in packed]
            columns = [*kept, texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow
            )

    return rows.mapInArrow(run, schema)
