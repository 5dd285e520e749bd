"""Token counts that follow edits (operator 8).

A text's pre-tokens are the leaves of a segment tree whose nodes hold the characters
and tokens below. An edit walks down to the leaf it touches, splits anew from two
characters before it (the pattern looks no farther ahead; special tokens widen that)
until the new words meet an old word's beginning again, encodes only words of that
stretch, and corrects the sums on the way up. Words before and after keep their counts.

Trees are kept: `build` encodes texts once and gives a table of them, `edit` turns such a
table and edits into the next one. A kept tree is its leaves, a length and a token count
for each word; the sums above them are added up again when it is opened, which needs
neither splitting nor encoding. Leaves are cut evenly then, so that many edits in one
place do not leave a tree lopsided.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskline.llm.common import map_rows
from maskline.llm.pretokens import Codec, codec, tokenizer_source

LEAF_WORDS = 64

Edit = tuple[int, int, str]  # start, end, what comes in place


class WordCounts(dict):
    """Tokens of a word, encoded once while it stays in the table."""

    LIMIT = 500_000

    def __init__(self, own: Codec):
        super().__init__()
        self.own = own

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = len(self.own.ids(word))
        return value


class CountTree:
    """Characters and tokens of a text, by runs of words. A leaf holds its piece of the text."""

    def __init__(self, text: str, counts: WordCounts, lengths: np.ndarray | None = None, tokens: np.ndarray | None = None):
        """From a text alone, or from the leaves that `saved` gave for it."""
        self.counts, self.encoded = counts, 0
        if lengths is None or tokens is None:
            words = counts.own.words(text)
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            tokens = np.fromiter(map(counts.__getitem__, words), np.int64, len(words))
        bounds = np.concatenate([[0], np.cumsum(lengths)]).tolist()
        n, own, ids = len(lengths), lengths.tolist(), tokens.tolist()
        self.leaves = [
            (text[bounds[i] : bounds[min(i + LEAF_WORDS, n)]], own[i : i + LEAF_WORDS], ids[i : i + LEAF_WORDS])
            for i in range(0, n, LEAF_WORDS)
        ] or [("", [], [])]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.sums = np.zeros((2, 2 * self.width), np.int64)
        for i, (piece, _, below) in enumerate(self.leaves):
            self.sums[:, self.width + i] = len(piece), sum(below)
        level = self.width
        while level > 1:
            below = self.sums[:, level : 2 * level]
            self.sums[:, level // 2 : level] = below[:, ::2] + below[:, 1::2]
            level //= 2
        self.reach = 2 + max(map(len, counts.own.special), default=0)

    @property
    def n_tokens(self) -> int:
        return int(self.sums[1, 1])

    @property
    def n_chars(self) -> int:
        return int(self.sums[0, 1])

    @property
    def text(self) -> str:
        return "".join(piece for piece, _, _ in self.leaves)

    def saved(self) -> tuple[bytes, bytes]:
        """The words' lengths and token counts, packed."""
        return tuple(_pack(np.fromiter((x for leaf in self.leaves for x in leaf[part]), np.int64)) for part in (1, 2))

    def _leaf_at(self, offset: int) -> tuple[int, int]:
        """The leaf that holds a character, and where that leaf begins."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if offset >= begin + self.sums[0, node] and self.sums[0, node + 1]:
                begin += int(self.sums[0, node])
                node += 1
        return node - self.width, begin

    def _set(self, leaf: int, piece: str, lengths: list[int], tokens: list[int]) -> None:
        self.leaves[leaf] = (piece, lengths, tokens)
        node = self.width + leaf
        change = np.array([len(piece), sum(tokens)]) - self.sums[:, node]
        while node:
            self.sums[:, node] += change
            node //= 2

    def _window(self, first: int, begin: int) -> Iterator[tuple[int, str, int]]:
        """Longer and longer stretches of the text from a leaf on: leaves read, their text, where it ends."""
        pieces, last, size = [], first, 1
        while True:
            pieces += [piece for piece, _, _ in self.leaves[last : last + size]]
            last, size = min(last + size, len(self.leaves)), 2 * size
            pieces = ["".join(pieces)]
            yield last, pieces[0], begin + len(pieces[0])

    def replace(self, start: int, end: int, new: str) -> None:
        """Put `new` in place of the characters from start to end, as they are before this edit."""
        if not 0 <= start <= end <= self.n_chars:
            raise ValueError("the edit lies outside the text")
        first, begin = self._leaf_at(max(0, start - self.reach))
        at, stay = begin, 0
        # words that end early enough to be out of the edit's reach stay
        for length in self.leaves[first][1]:
            if at + length > start - self.reach:
                break
            at, stay = at + length, stay + 1
        for last, old, stop in self._window(first, begin):
            whole = last == len(self.leaves)
            if stop < end or (stop < end + 2 * self.reach and not whole):
                continue
            # the stretch from `at` on as it is to be; behind the edit, places are `gap` off
            stretch = old[at - begin : start - begin] + new + old[end - begin :]
            gap = len(new) - (end - start) - at
            bounds, x = {}, begin  # an old word's beginning in the stretch: its leaf, word and place in the leaf
            for leaf in range(first, last):
                place = 0
                for word, length in enumerate(self.leaves[leaf][1]):
                    if x >= end + self.reach:
                        bounds[x + gap] = (leaf, word, place)
                    x, place = x + length, place + length
            safe = len(stretch) if whole else len(stretch) - self.reach
            position, taken, met = 0, [], None
            for word in self.counts.own.words(stretch):
                if position in bounds and position <= safe:
                    met = bounds[position]
                    break
                taken.append(word)
                position += len(word)
            if met is not None or whole:
                break
        self.encoded += position
        piece, lengths, tokens = self.leaves[first]
        piece = piece[: at - begin] + "".join(taken)
        lengths = lengths[:stay] + list(map(len, taken))
        tokens = tokens[:stay] + list(map(self.counts.__getitem__, taken))
        gone, rest = len(self.leaves), ("", [], [])
        if met is not None:
            gone, word, place = met
            rest = (self.leaves[gone][0][place:], self.leaves[gone][1][word:], self.leaves[gone][2][word:])
        if gone == first:
            self._set(first, piece + rest[0], lengths + rest[1], tokens + rest[2])
            return
        self._set(first, piece, lengths, tokens)
        for leaf in range(first + 1, gone):
            self._set(leaf, "", [], [])
        if gone < len(self.leaves):
            self._set(gone, *rest)


def _pack(numbers: np.ndarray) -> bytes:
    """How many, each in a byte (255: listed behind, in 32 bits), compressed."""
    large = numbers[numbers >= 255].astype("<u4")
    flat = np.minimum(numbers, 255).astype(np.uint8)
    return zlib.compress(len(numbers).to_bytes(4, "little") + flat.tobytes() + large.tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    raw = zlib.decompress(packed)
    end = 4 + int.from_bytes(raw[:4], "little")
    numbers = np.frombuffer(raw[4:end], np.uint8).astype(np.int64)
    numbers[numbers == 255] = np.frombuffer(raw[end:], "<u4")
    return numbers


def _listed(edits: list[dict] | None) -> list[Edit]:
    return [(e["start"], e["end"], e["new"] or "") for e in edits or []]


def _apply(tree: CountTree, edits: list[Edit]) -> int:
    """Carry out a text's edits, the last first; their number."""
    wanted = sorted(edits, key=lambda e: e[:2])
    if any(a[1] > b[0] for a, b in zip(wanted, wanted[1:])):
        raise ValueError("edits of a text overlap")
    for start, end, new in reversed(wanted):
        tree.replace(start, end, new)
    return len(wanted)


def _counter(spark: SparkSession, tokenizer: str) -> Callable[[], WordCounts]:
    """The table of word counts of a Python worker."""
    source = spark.sparkContext.broadcast(tokenizer_source(tokenizer))
    codec(source.value)
    held: list[WordCounts] = []

    def counts() -> WordCounts:
        if not held:
            held.append(WordCounts(codec(source.value)))
        return held[0]

    return counts


def build(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The trees of texts: key, text, lengths and tokens (of each word, packed), n_tokens.

    Every text is encoded once and whole. Null texts are empty. Rows are kept one to one,
    repeated and null keys too; other columns are not carried. The table is meant to be
    written, and given to `edit` whenever its texts change.
    """
    counts = _counter(docs.sparkSession, tokenizer)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    key_type = rows.schema["key"].dataType.simpleString()

    def run(keys, texts):
        saved, n = [], []
        for t in texts:
            tree = CountTree(t, counts())
            saved.append(tree.saved())
            n.append(tree.n_tokens)
        return keys, texts, *zip(*saved), n

    schema = f"key {key_type}, text string, lengths binary, tokens binary, n_tokens bigint"
    return map_rows(rows, run, schema).withColumnRenamed("key", key)


def edit(
    trees: DataFrame, tokenizer: str, *, key: str = "doc_id", edits: str | Callable[[str], list[Edit]] = "edits"
) -> DataFrame:
    """The trees after their edits, with n_tokens_before, n_edits and n_encoded (code points encoded again).

    `trees` is a table of `build` or of this function with a column of edits beside: an
    array of (start, end, new), code points of the text as it is kept, end exclusive. Instead
    of the column's name, `edits` may be a function that lists the edits of a text.
    Edits must not overlap (ValueError); edits at the same place apply in their order.
    Null edits are none, a null `new` deletes. Only words near an edit are split and
    encoded; trees without edits are not opened. Rows are kept one to one, repeated and
    null keys too; other columns are not carried.
    """
    counts = _counter(trees.sparkSession, tokenizer)
    find = edits if callable(edits) else None
    listed = F.lit(None) if find else F.col(edits)
    kept = trees.select(F.col(key).alias("key"), "text", "lengths", "tokens", "n_tokens", listed.alias("edits"))
    key_type = kept.schema["key"].dataType.simpleString()

    def run(keys, texts, lengths, tokens, before, changes):
        out = []
        for t, own, ids, n, wanted in zip(texts, lengths, tokens, before, changes):
            wanted = find(t) if find else _listed(wanted)
            if not wanted:
                out.append((t, own, ids, n, 0, 0))
                continue
            tree = CountTree(t, counts(), _unpack(own), _unpack(ids))
            done = _apply(tree, wanted)
            out.append((tree.text, *tree.saved(), tree.n_tokens, done, tree.encoded))
        texts, lengths, tokens, after, n_edits, encoded = zip(*out)
        return keys, texts, lengths, tokens, before, after, n_edits, encoded

    schema = (
        f"key {key_type}, text string, lengths binary, tokens binary, "
        "n_tokens_before bigint, n_tokens bigint, n_edits bigint, n_encoded bigint"
    )
    return map_rows(kept, run, schema).withColumnRenamed("key", key)


def count_edited(
    docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", edits: str = "edits"
) -> DataFrame:
    """Token counts of texts before and after their edits, without keeping the trees.

    Texts are as in `build`, edits as in `edit`. Columns: key, n_tokens_before, n_tokens,
    n_edits (long), n_encoded (code points that were encoded again). Rows are kept one to
    one, repeated and null keys too; other columns are not carried.
    """
    counts = _counter(docs.sparkSession, tokenizer)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(edits).alias("edits"))
    key_type = rows.schema["key"].dataType.simpleString()

    def run(keys, texts, changes):
        before, after, n_edits, encoded = [], [], [], []
        for t, wanted in zip(texts, changes):
            tree = CountTree(t or "", counts())
            before.append(tree.n_tokens)
            n_edits.append(_apply(tree, _listed(wanted)))
            after.append(tree.n_tokens)
            encoded.append(tree.encoded)
        return keys, before, after, n_edits, encoded

    schema = f"key {key_type}, n_tokens_before bigint, n_tokens bigint, n_edits bigint, n_encoded bigint"
    return map_rows(rows, run, schema).withColumnRenamed("key", key)
