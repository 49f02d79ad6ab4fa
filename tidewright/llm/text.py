"""Vectorised words and Karp-Rabin hashes over the byte buffers of Arrow text columns.

All hashes are 64 bits. Each place in a word has a pseudo-random odd factor of its
own, so that no pattern of letters makes words collide, as some do with the powers
of one base modulo 2**64. Words that collide under one key can be computed, so
operators whose result rests on hashes draw a key for each run; two given different
words then collide with a chance of about 2**-64.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Python workers live on between tasks, several to a core. Arrays of 2 MB and
# more are mapped by themselves (M_MMAP_THRESHOLD), so that the system has them back
# when they are freed; else the C library would keep the largest ones.
with contextlib.suppress(OSError, AttributeError):
    ctypes.CDLL(None).mallopt(-3, 2 << 20)

_libc = None
with contextlib.suppress(OSError, AttributeError):
    _libc = ctypes.CDLL(None)
    _libc.malloc_trim.argtypes = [ctypes.c_size_t]


def give_back() -> None:
    """Returns freed memory, small objects' too, to the system."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def returning(work):
    """A function for mapInArrow that gives its memory back when its task ends."""

    @functools.wraps(work)
    def run(batches):
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def of_group(work):
    """A function for applyInArrow that gives its memory back after each group."""

    @functools.wraps(work)
    def run(table):
        found = work(table)
        give_back()
        return found

    return run


# The white space that ends a word: blank and 0x09-0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Bytes of texts handled at a time (a longer text is handled alone).
CHUNK = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_WINDOW_BASE = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def binary(column: pa.Array) -> pa.Array:
    """A text column as bytes, null as empty."""
    if column.null_count:
        column = column.fill_null("")
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``limit`` bytes."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def fresh_key() -> int:
    """A key for the hashes of one run; the driver draws it, so that all tasks and
    their repetitions use the same one."""
    return secrets.randbits(64)


class Words:
    """The words of some texts: where each starts and ends, whose it is, its hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE):
        inside = ~separators[data]
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        starts[heads] = inside[heads]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | starts[1:]
        self.data, self.inside = data, inside
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        # words of text t: first[t] to first[t + 1]
        self.first = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.start)

    def texts(self) -> np.ndarray:
        """For each word, the text it belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self, key: int = 0) -> np.ndarray:
        """A hash of each word's bytes and its length: a sum of products by place."""
        lengths = self.end - self.start
        if not len(lengths):
            return np.zeros(0, np.uint64)
        # A factor for each place: odd, and without a relation to the others.
        seeds = np.arange(1, int(lengths.max()) + 1, dtype=np.uint64) * _WINDOW_BASE
        factors = mixed(seeds + mixed(np.full(1, key, np.uint64))) | np.uint64(1)
        begin = np.cumsum(lengths) - lengths
        kind = np.int32 if len(self.data) < 1 << 31 else np.int64
        place = np.arange(int(lengths.sum()), dtype=kind)
        place -= np.repeat(begin.astype(kind), lengths)
        # Word bytes, one after the other; in place, as these are the largest arrays.
        terms = _VALUES[self.data[self.inside]]
        terms *= factors[place]
        return mixed(np.add.reduceat(terms, begin) + lengths.astype(np.uint64))


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of the ``size`` words from each place on (by doubling)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total, done, block, width = None, 0, words, 1
    base = int(_WINDOW_BASE)
    while True:
        if size & width:
            piece = block[done : done + n]
            total = piece.copy() if total is None else total * np.uint64(pow(base, width, 1 << 64)) + piece
            done += width
        if done == size:
            return mixed(total)
        block = block[: len(block) - width] * np.uint64(pow(base, width, 1 << 64)) + block[width:]
        width *= 2


def whole_windows(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the windows that lie within one text."""
    found = windows(hashes, size)
    owner = words.texts()
    places = np.flatnonzero(owner[: len(found)] == owner[size - 1 : size - 1 + len(found)])
    return places, found[places]


def split_by(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """An order that groups rows by key (0 to n - 1), and where each key begins in it."""
    kind = np.uint16 if n <= 1 << 16 else np.uint32
    order = np.argsort(keys.astype(kind), kind="stable")
    return order, np.concatenate(([0], np.cumsum(np.bincount(keys, minlength=n))))


def slice_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """The slice of each hash: equal ranges of its upper 32 bits."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
