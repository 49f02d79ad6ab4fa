"""Benchmark decontamination by greedy string tiling.

Words are runs of letters and digits, in lower case. Documents and benchmark
items are joined on seeds: windows of ``LEAST`` words with the same Karp-Rabin
hash. For each document and item that share seeds, the longest common run of
words that overlaps no tile is marked as a tile, again and again, until no run of
``LEAST`` words is left; runs are found by running the window hash along the
diagonals of the seeds. The share of the item's words under tiles is its
coverage. As tiles may come in any order, a passage whose sentences were
reordered is covered as well. A document is contaminated where an item's coverage
reaches ``COVERAGE``.

The benchmark is taken in blocks of about ``BLOCK_WORDS`` words, each sent to all
tasks; every document meets every block. Documents are not shuffled.

Cases: a null or empty text is not contaminated, and null or empty items, and
items of fewer than ``LEAST`` words, contaminate nothing. Of equally covered
items the smallest id is named. Each row is judged alone, whatever its id. An
empty table gives an empty result, an empty benchmark no contamination.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import id_and_text
from tidewright.llm.text import LOWER, Words, chunks, returning, whole_windows

LEAST = 5
COVERAGE = 0.5
BLOCK_WORDS = 400_000

# Words end at ASCII characters other than letters and digits.
MARKS = np.ones(256, bool)
MARKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes in lower case: A-Z, and the letters À to Þ in UTF-8."""
    out = LOWER[data]
    accented = np.flatnonzero((out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)) + 1
    out[accented] += 0x20
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    words = Words(lowered(data), offsets, MARKS)
    return words, words.hashes()


def runs_of(pairs: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(length, place in the item, place in the document) of the longest runs that
    the seeds (document place, item place) make up on their diagonals."""
    diagonal = pairs[:, 0] - pairs[:, 1]
    order = np.lexsort((pairs[:, 1], diagonal))
    pairs, diagonal = pairs[order], diagonal[order]
    new = np.append(True, (diagonal[1:] != diagonal[:-1]) | (pairs[1:, 1] != pairs[:-1, 1] + 1))
    heads = np.flatnonzero(new)
    lengths = np.diff(np.append(heads, len(pairs))) + least - 1
    return [(int(n), int(pairs[h, 1]), int(pairs[h, 0])) for h, n in zip(heads, lengths)]


def tiles_of(pairs: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from the seeds of a document and an item: tiles
    (length, place in the item, place in the document), longest first; of equal
    lengths, those with the smallest places."""
    queue = [(-n, p, d) for n, p, d in runs_of(pairs, least)]
    heapq.heapify(queue)
    in_item: set[int] = set()
    in_doc: set[int] = set()
    tiles = []
    while queue:
        n, p, d = heapq.heappop(queue)
        free = [p + k not in in_item and d + k not in in_doc for k in range(-n)]
        if all(free):
            tiles.append((-n, p, d))
            in_item.update(range(p, p - n))
            in_doc.update(range(d, d - n))
            continue
        # What earlier tiles have left of the run goes back to the queue.
        start = 0
        for k in range(-n + 1):
            if k == -n or not free[k]:
                if k - start >= least:
                    heapq.heappush(queue, (start - k, p + start, d + start))
                start = k + 1
    return tiles


class Index:
    """The seeds of a block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], least: int):
        items = [(i, t or "") for i, t in sorted(items, key=lambda x: (x[0] is None, x[0] or 0))]
        data = "\n".join(t for _, t in items).encode()
        sizes = np.array([len(t.encode()) + 1 for _, t in items], np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        offsets[-1] = len(data)
        words, hashes = word_hashes(np.frombuffer(data, np.uint8), offsets)
        self.least = least
        self.ids = [i for i, _ in items]
        self.sizes = np.diff(words.first)
        places, seeds = whole_windows(words, hashes, least)
        owner = words.texts()[places]
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.item = seeds[order], owner[order]
        self.place = (places - words.first[owner])[order]
        # Most windows of documents are no seed; one look into this table tells.
        self.bits = np.zeros(1 << 22, bool)
        self.bits[self.seeds >> np.uint64(42)] = True

    def hits(self, seeds: np.ndarray) -> np.ndarray:
        """The places of windows that are seeds of some item."""
        near = np.flatnonzero(self.bits[seeds >> np.uint64(42)])
        if not len(self.seeds) or not len(near):
            return near[:0]
        at = np.minimum(np.searchsorted(self.seeds, seeds[near]), len(self.seeds) - 1)
        return near[self.seeds[at] == seeds[near]]

    def best(self, doc_places: np.ndarray, seeds: np.ndarray) -> tuple[float, int | None, list]:
        """(coverage, item, tiles) of the item that covers a document best."""
        low = np.searchsorted(self.seeds, seeds, "left")
        many = np.searchsorted(self.seeds, seeds, "right") - low
        at = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        item, pairs = self.item[at], np.stack([np.repeat(doc_places, many), self.place[at]], axis=1)
        order = np.argsort(item, kind="stable")
        item, pairs = item[order], pairs[order]
        bounds = np.append(np.flatnonzero(np.append(True, item[1:] != item[:-1])), len(item))
        found: tuple[float, int | None, list] = (0.0, None, [])
        for a, b in zip(bounds[:-1], bounds[1:]):
            size = int(self.sizes[item[a]])
            # The places under seeds are an upper bound of those under tiles.
            seeded = len(np.unique(pairs[a:b, 1][:, None] + np.arange(self.least)))
            if seeded / size <= found[0]:
                continue
            tiles = tiles_of(pairs[a:b], self.least)
            covered = sum(t[0] for t in tiles) / size
            if covered > found[0]:
                found = covered, self.ids[item[a]], tiles
        return found


def _judged(index: Index, column: pa.Array) -> list[tuple[float, int | None, list]]:
    out = []
    for row, end, data, offsets in chunks(column):
        words, hashes = word_hashes(data, offsets)
        places, seeds = whole_windows(words, hashes, index.least)
        hits = index.hits(seeds)
        found = [(0.0, None, [])] * (end - row)
        texts = words.texts()[places[hits]]
        for t in np.unique(texts):
            some = hits[texts == t]
            found[t] = index.best(places[some] - words.first[t], seeds[some])
        out += found
    return out


def indexes(benchmark: DataFrame, id_column: str, text_column: str, least: int, block_words: int) -> Iterator[Index]:
    """The benchmark's blocks; only one at a time is on the driver."""
    items = id_and_text(benchmark, id_column, text_column)
    words = items.agg(F.sum(F.size(F.split("text", r"[\x20\x09-\x0D]+")))).first()[0] or 0
    blocks = max(1, -(-words // block_words))
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)) == k)
        yield Index([(r.doc_id, r.text) for r in block.collect()], least)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    *,
    item_column: str = "item_id",
    item_text: str = "text",
    least: int = LEAST,
    coverage: float = COVERAGE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document: doc_id, contaminated, coverage, item_id, n_tiles, tiles
    (words, place in the item, place in the document)."""
    kind = "array<struct<words:int,item_place:int,doc_place:int>>"
    source = id_and_text(docs, id_column, text_column)
    state = "doc_id bigint, text string, covered double, item bigint, tiles array<array<int>>"
    current = source.select("doc_id", "text", F.lit(0.0).alias("covered"), F.lit(None).cast("bigint").alias("item"),
                            F.lit(None).cast("array<array<int>>").alias("tiles"))
    for index in indexes(benchmark, item_column, item_text, least, block_words):

        def judge(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                best = [
                    max(
                        (new, (old, item, tiles)),
                        key=lambda x: (x[0], -(x[1] if x[1] is not None else 1 << 63)),
                    )
                    for new, old, item, tiles in zip(
                        _judged(index, batch.column("text")),
                        *(batch.column(c).to_pylist() for c in ("covered", "item", "tiles")),
                    )
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("text"),
                        pa.array([b[0] for b in best], pa.float64()),
                        pa.array([b[1] for b in best], pa.int64()),
                        pa.array([[list(t) for t in b[2] or ()] for b in best], pa.list_(pa.list_(pa.int32()))),
                    ],
                    ["doc_id", "text", "covered", "item", "tiles"],
                )

        current = current.mapInArrow(returning(judge), state)
    tiles = F.expr(
        "transform(tiles, t -> named_struct('words', t[0], 'item_place', t[1], 'doc_place', t[2]))"
    ).cast(kind)
    return current.select(
        "doc_id",
        (F.col("covered") >= coverage).alias("contaminated"),
        F.col("covered").alias("coverage"),
        F.col("item").alias("item_id"),
        F.size("tiles").cast("bigint").alias("n_tiles"),
        tiles.alias("tiles"),
    )


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text", *, least: int = LEAST, coverage: float = COVERAGE
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    for index in indexes(benchmark, "item_id", "text", least, BLOCK_WORDS):

        def keep(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [c < coverage for c, _, _ in _judged(index, batch.column(text_column))]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(returning(keep), docs.schema)
    return docs
