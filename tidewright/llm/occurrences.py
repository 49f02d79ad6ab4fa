"""Occurrences of hashes in documents, packed so that Spark shuffles blocks of them.

A row holds the occurrences of one block of texts whose hashes fall in one slice:
the hashes, the place of each in its text, and for each run of occurrences of one
text its key (null id, rank, tag). Rows of kind ``KNOWN`` have been decided within
their block and only pass through. A text's key is its id and a hash of its
bytes; rows that repeat both are one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import id_and_text
from tidewright.llm.text import mixed, slice_of, split_by

OPEN, KNOWN = 0, 1
# Bytes of texts in a block.
BLOCK = 2 << 20

ROWS = "slice int, kind int, hashes binary, places binary, runs binary, ranks binary, tags binary"
BLOCKS = "bucket int, places binary, runs binary, ranks binary, tags binary"
PLACES = "rank bigint, tag bigint, places binary"
_SCHEMA = pa.schema(
    [("slice", pa.int32()), ("kind", pa.int32())]
    + [(c, pa.binary()) for c in ("hashes", "places", "runs", "ranks", "tags")]
)
_BLOCKS = pa.schema(
    [("bucket", pa.int32())] + [(c, pa.binary()) for c in ("places", "runs", "ranks", "tags")]
)
_NULL_ID = 1 << 31


def keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """doc_id, text, and the key (rank, tag) of each row. The tag's top bit marks
    a null id, whose rank is a hash of the text."""
    source = id_and_text(docs, id_column, text_column).withColumn("text", F.coalesce("text", F.lit("")))
    rank, tag = row_key(F.col("doc_id"), F.col("text"))
    return source.select("doc_id", "text", rank.alias("rank"), tag.alias("tag"))


def row_key(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """The key of a row with this id and text (not null)."""
    tag = F.xxhash64(text, F.lit(1)).bitwiseAND(F.lit(_NULL_ID - 1))
    marked = F.when(doc_id.isNull(), tag.bitwiseOR(F.lit(_NULL_ID))).otherwise(tag)
    return F.coalesce(doc_id, F.xxhash64(text)), marked


def pack(n, kind, hashes, texts, places, ranks, tags, *, by=None) -> Iterator[pa.RecordBatch]:
    """Rows for occurrences in the order of their texts; ``ranks`` and ``tags`` are
    those of the block's texts, ``texts`` the text of each occurrence."""
    order, bounds = split_by(slice_of(hashes if by is None else by, n), n)
    rows = {c: [] for c in _SCHEMA.names}
    for k in np.flatnonzero(np.diff(bounds)):
        some = order[bounds[k] : bounds[k + 1]]
        owner = texts[some]
        heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        values = (
            int(k),
            kind,
            hashes[some].tobytes(),
            places[some].astype(np.uint32).tobytes(),
            np.diff(np.append(heads, len(owner))).astype(np.uint32).tobytes(),
            ranks[owner[heads]].tobytes(),
            tags[owner[heads]].astype(np.uint32).tobytes(),
        )
        for c, v in zip(_SCHEMA.names, values):
            rows[c].append(v)
    if rows["slice"]:
        yield pa.RecordBatch.from_pydict(rows, _SCHEMA)


class Occurrences:
    """The occurrences of some rows, as arrays."""

    def __init__(self, table: pa.Table):
        read = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
        runs = read("runs", np.uint32)
        self.hashes = read("hashes", np.uint64) if "hashes" in table.column_names else None
        self.places = read("places", np.uint32)
        self.ranks = np.repeat(read("ranks", np.int64), runs)
        self.tags = np.repeat(read("tags", np.uint32), runs)

    def take(self, rows: np.ndarray) -> Occurrences:
        for c in ("hashes", "places", "ranks", "tags"):
            if getattr(self, c) is not None:
                setattr(self, c, getattr(self, c)[rows])
        return self

    def repeated(self) -> Occurrences:
        """Those whose hash occurs more than once, in the order of their hashes."""
        self.take(np.argsort(self.hashes))
        same = self.hashes[1:] == self.hashes[:-1]
        return self.take(np.flatnonzero(np.append(same, False) | np.insert(same, 0, False)[: len(self.hashes)]))

    def not_first(self) -> Occurrences:
        """Those with an earlier occurrence of the same hash (smaller id, or the
        same text and an earlier place)."""
        self.repeated()
        null = self.tags >= _NULL_ID
        self.take(np.lexsort((self.places, self.tags, self.ranks, null, self.hashes)))
        if not len(self.hashes):
            return self
        heads = np.flatnonzero(np.append(True, self.hashes[1:] != self.hashes[:-1]))
        first = np.repeat(heads, np.diff(np.append(heads, len(self.hashes))))
        same = (
            (self.ranks == self.ranks[first]) & (self.tags == self.tags[first]) & (self.places == self.places[first])
        )
        return self.take(np.flatnonzero(~same))

    def by_text(self) -> np.ndarray:
        """Sorts by text and place; where each text begins."""
        self.take(np.lexsort((self.places, self.tags, self.ranks)))
        change = (self.ranks[1:] != self.ranks[:-1]) | (self.tags[1:] != self.tags[:-1])
        return np.flatnonzero(np.append(True, change)[: len(self.ranks)])

    def blocks(self, n: int) -> pa.Table:
        """A row for each of ``n`` buckets of texts."""
        heads = self.by_text()
        runs = np.diff(np.append(heads, len(self.ranks)))
        bucket = bucket_of(self.ranks[heads], self.tags[heads], n)
        order, bounds = split_by(np.repeat(bucket, runs), n)
        texts, text_bounds = split_by(bucket, n)
        rows = []
        for k in np.flatnonzero(np.diff(bounds)):
            some, of = order[bounds[k] : bounds[k + 1]], texts[text_bounds[k] : text_bounds[k + 1]]
            rows.append(
                {
                    "bucket": int(k),
                    "places": self.places[some].tobytes(),
                    "runs": runs[of].astype(np.uint32).tobytes(),
                    "ranks": self.ranks[heads[of]].tobytes(),
                    "tags": self.tags[heads[of]].tobytes(),
                }
            )
        return pa.Table.from_pylist(rows, _BLOCKS)

    def texts(self) -> pa.Table:
        """A row for each text: rank, tag, places."""
        heads = self.by_text()
        offsets = (np.append(heads, len(self.ranks)) * 4).astype(np.int64)
        data = np.ascontiguousarray(self.places)
        places = pa.Array.from_buffers(
            pa.large_binary(), len(heads), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        )
        return pa.table(
            {
                "rank": pa.array(self.ranks[heads], pa.int64()),
                "tag": pa.array(self.tags[heads].astype(np.int64), pa.int64()),
                "places": places.cast(pa.binary()),
            }
        )


def bucket_of(ranks: np.ndarray, tags: np.ndarray, n: int) -> np.ndarray:
    """The bucket of texts, by a hash of their keys."""
    return slice_of(mixed(ranks.view(np.uint64) ^ (tags.astype(np.uint64) << np.uint64(32))), n)


def decided(rows: DataFrame, choose, n: int) -> DataFrame:
    """Per text (rank, tag) the places that ``choose`` keeps of each slice's open
    occurrences, and the known ones. Blocks of texts are dealt to ``n`` buckets."""

    def reduce(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_numpy()
        parts = [choose(Occurrences(table.filter(pa.array(kinds == OPEN)))).blocks(n)]
        if (kinds == KNOWN).any():
            parts.append(Occurrences(table.filter(pa.array(kinds == KNOWN))).blocks(n))
        return pa.concat_tables(parts)

    def gather(table: pa.Table) -> pa.Table:
        return Occurrences(table).texts()

    blocks = rows.groupBy("slice").applyInArrow(reduce, BLOCKS)
    return blocks.groupBy("bucket").applyInArrow(gather, PLACES)


def places_of(places: bytes | None) -> np.ndarray:
    """The sorted places of a text."""
    return np.unique(np.frombuffer(places or b"", np.uint32)).astype(np.int64)
