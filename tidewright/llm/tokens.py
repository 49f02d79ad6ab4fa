"""Token ids of whole texts with a public tokenizer file.

The tokenizer splits at white space before anything else and drops it, so the
ids of a text are those of its words in order. Each task therefore encodes a
word once and keeps its ids; ``test_tokens.py`` holds the result against the
library's own encoding of whole texts.
"""

from __future__ import annotations

import string
from array import array
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

# What a task keeps the ids of, about 200 bytes each: pieces, which are dear to split (runs
# of letters, and other words), and words, which are made of them.
KEPT_PIECES, KEPT_WORDS = 400_000, 80_000
_MARKS = string.punctuation.encode()

# The 256 characters that stand for bytes in byte-level vocabularies.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: chr(b) for b in _PRINTED} | {
    b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in _PRINTED)
}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Known(dict):
    """Ids by key, made on demand by ``make`` and bounded in number: when half of them
    are new, those not used since the last such time are forgotten."""

    def __init__(self, make, most):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        if len(self) >= self.most // 2:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class Encoder:
    """Encodes texts with the tokenizer of one file."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.model = self.tokenizer.model
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.words = _Known(self._word, KEPT_WORDS)
        self.letters = _Known(self._letters, KEPT_PIECES)
        self.others = _Known(self._others, KEPT_PIECES)

    def _packed(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _letters(self, word: bytes) -> bytes:
        return self._packed([t.id for t in self.model.tokenize("".join(map(_BYTE_CHARS.get, word)))])

    def _word(self, word: bytes) -> bytes:
        # A run of Latin-1 letters is one piece, which only has to be lower-cased, and
        # the marks behind it are another.
        body = word.rstrip(_MARKS)
        if body.isalpha():  # of ASCII
            ids = self.letters[body.lower()]
        else:
            text = body.decode("utf-8", "replace")
            if not (text.isalpha() and max(text) < "Ā"):
                return self.others[word]
            ids = self.letters[text.lower().encode()]
        return ids if len(body) == len(word) else ids + self.others[word[len(body) :]]

    def _others(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def packed(self, text: bytes) -> bytes:
        """The ids of a text, as little-endian integers of ``kind``."""
        return b"".join(map(self.words.__getitem__, text.split()))

    def count(self, text: bytes) -> int:
        return len(self.packed(text)) // self.kind.itemsize


@lru_cache(maxsize=4)
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def encoder(path: str) -> Encoder:
    """An encoder for one task: the file is read once a process, but the words that
    are kept go with the task, as a Python worker outlives many."""
    return Encoder(path)
