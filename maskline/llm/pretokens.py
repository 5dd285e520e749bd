"""Splitting texts into the words of a byte-level BPE tokenizer, and the word's ids.

Only files of that kind are accepted (no normalizer, byte-level splitting by the
usual pattern without a leading space): there a text's ids are the ids of its words,
one after another, whatever stands around them.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

# Letters, numbers and white space below U+0250, and further characters
# that are none of the three, written as ranges of a character class.
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPACES = "\t-\r \x85\xa0"
PLAIN = "\x00-ɏ‐-‧‰-›€™"

# The tokenizer's pattern for texts made of PLAIN characters only.
WORD = re.compile(
    rf" ?[{LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{NUMBERS}]+"
    rf"| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
ONLY_PLAIN = re.compile(f"[{PLAIN}]*")


def byte_symbols() -> list[str]:
    """The visible character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [""] * 256, 0x100
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


class Codec:
    """Words, ids and pieces of one tokenizer file."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        spec = json.loads(source)
        split = spec.get("pre_tokenizer") or {}
        model = spec["model"]
        decoder = (spec.get("decoder") or {}).get("type")
        if (
            spec.get("normalizer")
            or split.get("type") != "ByteLevel"
            or split.get("add_prefix_space")
            or not split.get("use_regex", True)
            or model.get("type") != "BPE"
            or model.get("dropout")
            or decoder != "ByteLevel"
        ):
            raise ValueError("only plain byte-level BPE tokenizer files are supported")
        added = spec.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens that strip or need word bounds are not supported")
        self.tokenizer = Tokenizer.from_str(source)
        self.model = self.tokenizer.model
        self.special = {t["content"]: t["id"] for t in added}
        names = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.symbols = {b: ord(s) for b, s in enumerate(byte_symbols())}
        self.byte_of = {s: b for b, s in enumerate(byte_symbols())}
        self.n_ids = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1

    def _split(self, text: str) -> list[str]:
        if ONLY_PLAIN.fullmatch(text):
            return WORD.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def words(self, text: str | None) -> list[str]:
        """The text in words; joined they give the text again."""
        if not text:
            return []
        if self.special_pattern is None or not self.special_pattern.search(text):
            return self._split(text)
        out = []
        for part in self.special_pattern.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                out += self._split(part)
        return out

    def ids(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        shown = word.encode("utf-8").decode("latin-1").translate(self.symbols)
        return [t.id for t in self.model.tokenize(shown)]

    def pieces(self) -> list[bytes]:
        """The id-to-piece table: the bytes of each id, empty for ids that stand for nothing."""
        out = [b""] * self.n_ids
        for piece, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            try:
                out[i] = bytes(self.byte_of[c] for c in piece)
            except KeyError:
                out[i] = piece.encode("utf-8")
        return out


@lru_cache(maxsize=4)
def codec(source: str) -> Codec:
    """The codec of a tokenizer file's content, made once per Python worker."""
    return Codec(source)


def tokenizer_source(path: str) -> str:
    """The content of a tokenizer file, read where the query is built."""
    with open(path, encoding="utf-8") as file:
        return file.read()
