"""Public tokenizer vocabularies inside tasks.

The driver reads a vocabulary file (a few MB, as large for any input) and
broadcasts its content; workers build the tokenizer from it once and keep it.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

#: Fixed value: code points with the Unicode property White_Space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
WORDS = re.compile(f"[^{WHITE_SPACE}]+")
_NOT_UNICODE_SPACE = re.compile("[\x1c-\x1f]")


def split(text: str) -> list[str]:
    """The text's words, parted by White_Space (str.split also parts at four control characters)."""
    return WORDS.findall(text) if _NOT_UNICODE_SPACE.search(text) else text.split()


#: White space stays with the word that follows it.
SPACED_WORDS = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")

#: Fixed value: a pre-tokenizer's pattern with this part takes letters and nothing else together.
LETTERS = "[\\\\p{L}]+|[\\\\p{N}]|[^\\\\s\\\\p{L}\\\\p{N}]+"

_LOADED: dict = {}


def read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def share(spark, content):
    return spark.sparkContext.broadcast(content)


def tokenizer(content: str):
    """The tokenizers library's tokenizer, without truncation and padding, one per worker."""
    key = hash(content)
    if key not in _LOADED:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(content)
        t.no_truncation()
        t.no_padding()
        _LOADED[key] = t
    return _LOADED[key]


class WordEncoder:
    """Ids of words as little-endian integers, each distinct word encoded once.

    Words are encoded many at a time, parted by a special token that the
    tokenizer cuts out of the text before anything else; a word that holds
    such a token's text itself is encoded alone. ``lower``: the vocabulary
    lower-cases and parts letters from punctuation, so words are encoded without
    case and trailing punctuation.
    """

    def __init__(self, content: str, dtype: str = "<u2", keep: int = 1_500_000, lower: bool = False):
        self.tok, self.dtype, self.keep = tokenizer(content), np.dtype(dtype), keep
        special = [t for t in json.loads(content)["added_tokens"] if t["special"] and not t["normalized"]]
        self.lower = lower
        self.parts = [t["content"] for t in special]
        self.id = special[0]["id"] if special else None
        self.known: dict[str, bytes] = {}

    def _one(self, word: str) -> bytes:
        return np.array(self.tok.encode(word, add_special_tokens=False).ids, self.dtype).tobytes()

    def learn(self, words) -> dict[str, bytes]:
        """``known`` with all of ``words`` in it; it is emptied when it has more than ``keep`` words."""
        if len(self.known) > self.keep:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        if self.lower:  # "Word," is "word" and ","; no token goes over a letter's edge with full stops and commas
            cores = {w: (w.rstrip(".,"), w) for w in new}
            cores = {w: (c.lower() if c.isascii() else c, w[len(c) :]) for w, (c, _) in cores.items() if c and c[-1].isalpha() and "<" not in c}
            cores = {w: (c, tail) for w, (c, tail) in cores.items() if c != w}
            need = {x for both in cores.values() for x in both if x and x not in self.known}
            self._encode([*need, *(w for w in new if w not in cores and w not in need)])
            for w, (c, tail) in cores.items():
                self.known[w] = self.known[c] + (self.known[tail] if tail else b"")
        else:
            self._encode(new)
        return self.known

    def _encode(self, new) -> None:
        plain = [w for w in new if self.id is not None and not any(p in w for p in self.parts)]
        for w in set(new) - set(plain):
            self.known[w] = self._one(w)
        for i in range(0, len(plain), 1000):
            some = plain[i : i + 1000]
            ids = np.array(self.tok.encode(self.parts[0].join(some), add_special_tokens=False).ids, np.int64)
            cut = np.flatnonzero(ids == self.id)
            if len(cut) != len(some) - 1:
                raise ValueError("the separator is not cut out as one token")
            raw, size = np.where(ids == self.id, 0, ids).astype(self.dtype).tobytes(), self.dtype.itemsize
            for w, a, b in zip(some, [0, *(cut + 1).tolist()], [*cut.tolist(), len(ids)], strict=True):
                self.known[w] = raw[a * size : b * size]


def encoder(content: str, dtype: str) -> WordEncoder:
    key = (hash(content), dtype)
    if key not in _LOADED:
        j = json.loads(content)
        kinds = str(j.get("normalizer")), str(j.get("pre_tokenizer"))
        lower = "'Lowercase'" in kinds[0] and LETTERS in kinds[1]
        _LOADED[key] = WordEncoder(content, dtype, lower=lower)
    return _LOADED[key]


def id_type(content: str) -> str:
    """The narrowest unsigned type that holds every id."""
    j = json.loads(content)
    top = max([*j["model"]["vocab"].values(), *(t["id"] for t in j["added_tokens"])])
    return "<u2" if top < 2**16 else "<u4"


def byte_pieces(content: str) -> list[bytes]:
    """Bytes of every id of a byte-level vocabulary, the special tokens as their text."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    j = json.loads(content)
    special = {t["id"]: t["content"].encode() for t in j["added_tokens"]}
    vocab = j["model"]["vocab"]
    pieces = [b""] * (max([*vocab.values(), *special]) + 1)
    for piece, i in vocab.items():
        pieces[i] = special[i] if i in special else bytes(byte[c] for c in piece)
    for i, piece in special.items():
        pieces[i] = piece
    return pieces
