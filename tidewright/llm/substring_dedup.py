"""Removal of repeated word windows, by Rabin-Karp hashes counted in Spark.

Every window of ``WINDOW`` consecutive words of a document is hashed. A window
whose word sequence also starts earlier (smaller id, or earlier in the same
document) is removed; overlapping removals merge into maximal intervals.

Counting has two steps, so that most windows never leave their task. Within
each window, the ``GRAM`` words with the smallest hash are its anchor: windows of
equal words have equal anchors. Anchors (about a seventh of all places) are
counted first. A window whose anchor occurs once in the corpus occurs once
itself; only the others are shuffled and compared. Occurrences repeated within a
block of texts are decided there, so a passage that a third of all documents
share sends one occurrence per block.

Cases: a null text has no words. A null id is larger than any other. Rows with
one id and one text are the same document and treated alike. Empty tables give
empty results; other columns are not read. Hashes have 64 bits, so two of n
different windows are taken for equal with a chance of about n*n / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm.occurrences import BLOCK, KNOWN, OPEN, ROWS, Occurrences, decided, keyed, pack, places_of
from tidewright.llm.text import Words, chunks, fresh_key, whole_windows

WINDOW = 20
GRAM = 8  # at least 5 below WINDOW and at most 15

RESULT = "doc_id bigint, kept_text string, n_words bigint, n_removed bigint, intervals array<struct<start:bigint,end:bigint>>"


def _deal(n: int, hashes, texts, places, ranks, tags, first: bool) -> Iterator[pa.RecordBatch]:
    """One open occurrence for each hash of the block, and what is known of the
    others: that they are repeated (``first`` False), or not the first."""
    order = np.lexsort((places, tags[texts], ranks[texts], tags[texts] >> 31, hashes))
    sorted_hashes = hashes[order]
    heads = np.append(True, sorted_hashes[1:] != sorted_hashes[:-1])[: len(order)]
    if first:
        lead = order[heads][np.cumsum(heads) - 1]
        known = (
            (ranks[texts[order]] != ranks[texts[lead]])
            | (tags[texts[order]] != tags[texts[lead]])
            | (places[order] != places[lead])
        )
    else:
        again = ~heads
        known = again | np.append(again[1:], False)[: len(order)]
    for kind, rows in ((OPEN, order[heads]), (KNOWN, order[known])):
        rows = np.sort(rows)
        yield from pack(
            n, kind, hashes[rows], texts[rows], places[rows], ranks, tags,
            by=None if kind == OPEN else ranks[texts[rows]].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15),
        )


def _anchor_places(words: Words, hashes: np.ndarray, window: int, gram: int):
    """(window starts, their hashes, the place of each window's anchor, hashes of all grams)."""
    starts, found = whole_windows(words, hashes, window)
    places, values = whole_windows(words, hashes, gram)
    grams = np.zeros(len(hashes), np.uint64)
    grams[places] = values
    # The offset in the low bits makes the leftmost of equal grams the smallest.
    high = grams & ~np.uint64(15)
    best = high[starts]
    for k in range(1, window - gram + 1):
        np.minimum(best, high[starts + k] + np.uint64(k), out=best)
    return starts, found, starts + (best & np.uint64(15)).astype(np.int64), grams


def _anchors(n: int, window: int, gram: int, key: int):
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranks, tags = (batch.column(c).to_numpy() for c in ("rank", "tag"))
            for row, end, data, offsets in chunks(batch.column("text"), BLOCK):
                words = Words(data, offsets)
                if len(words) < window:
                    continue
                _, _, places, grams = _anchor_places(words, words.hashes(key), window, gram)
                places = np.unique(places)
                texts = words.texts()[places]
                yield from _deal(
                    n, grams[places], texts, places - words.first[texts], ranks[row:end], tags[row:end], False
                )

    return anchors


def _open_windows(n: int, window: int, gram: int, key: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranks, tags = (batch.column(c).to_numpy() for c in ("rank", "tag"))
            marks = batch.column("places")
            for row, end, data, offsets in chunks(batch.column("text"), BLOCK):
                words = Words(data, offsets)
                marked = np.zeros(len(words) + 1, bool)
                for t in range(end - row):
                    marked[words.first[t] + places_of(marks[row + t].as_py())] = True
                starts, values, anchors, _ = _anchor_places(words, words.hashes(key), window, gram)
                starts, values = starts[marked[anchors]], values[marked[anchors]]
                if not len(starts):
                    continue
                texts = words.texts()[starts]
                yield from _deal(
                    n, values, texts, starts - words.first[texts], ranks[row:end], tags[row:end], True
                )

    return found


def _remove(window: int):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, removed, intervals = [], [], [], []
            for text, places in zip(batch.column("text"), batch.column("places")):
                words, starts, spans = text.as_py().encode().split(), places_of(places.as_py()), []
                if len(starts):
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, starts, 1)
                    np.add.at(change, starts + window, -1)
                    inside = np.diff(np.concatenate([[0], np.cumsum(change[:-1]) > 0, [0]]).astype(np.int8))
                    spans = list(zip(np.flatnonzero(inside == 1).tolist(), np.flatnonzero(inside == -1).tolist()))
                n = len(words)
                for a, b in reversed(spans):
                    del words[a:b]
                kept.append(b" ".join(words).decode())
                sizes.append(n)
                removed.append(n - len(words))
                intervals.append([{"start": a, "end": b} for a, b in spans])
            pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(kept, pa.string()),
                    pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(intervals, pa.list_(pair)),
                ],
                ["doc_id", "kept_text", "n_words", "n_removed", "intervals"],
            )

    return remove


def substring_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    *,
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """Per row: doc_id, kept_text (words joined by a blank), n_words, n_removed,
    intervals (the word ranges removed, end exclusive)."""
    n, key = _blocks(docs.sparkSession), fresh_key()
    source = keyed(docs, id_column, text_column)
    # The texts are dealt by their keys once; both joins read the same exchange.
    placed = source.repartition("rank", "tag")
    repeated = decided(source.mapInArrow(_anchors(n, window, gram, key), ROWS), Occurrences.repeated, n)
    again = placed.join(repeated, ["rank", "tag"]).mapInArrow(_open_windows(n, window, gram, key), ROWS)
    later = decided(again, Occurrences.not_first, n)
    marked = placed.join(later, ["rank", "tag"], "left")
    return marked.select("doc_id", "text", "places").mapInArrow(_remove(window), RESULT)


def _blocks(spark: SparkSession) -> int:
    """Slices of the hashes: one for each shuffle partition."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
