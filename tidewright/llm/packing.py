"""Best-fit packing of token sequences into bins, under conflicts.

A bin takes ``capacity`` tokens, at most one document of a duplicate cluster and,
unless told otherwise, at most one of a source. Documents are dealt by a hash
into groups of about ``GROUP_TOKENS`` tokens each, and each group is packed by
one task: pieces in decreasing size, each into the tightest bin that fits and has
no conflict. Open bins are kept in the order of their residual space and carry
bitmaps of the sources and clusters they hold; the search starts at the first
bin that fits and goes on to its successors until one is compatible. The number
of groups follows from a global sum, so a group's size does not grow with the
data, and a source with a third of all rows is spread over all groups.

A document longer than a bin fills bins of its own and leaves one rest, which
is packed. Lengths count the end token.

Cases: a null or empty text has the end token alone. A null source conflicts
with nothing, as do texts equal to no other. Repeated rows are packed each, in
different bins, as their texts are equal. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm import tokens
from tidewright.llm.common import prepare, written
from tidewright.llm.exact_dedup import normalised
from tidewright.llm.text import binary, of_group, returning

CAPACITY = 2048
GROUP_TOKENS = 1 << 20

RESULT = "doc_id bigint, piece bigint, start bigint, n_tokens bigint, bin_id bigint, offset bigint"
_RESULT = pa.schema([(c.split()[0], pa.int64()) for c in RESULT.split(", ")])
_SHIFT = 32


def _sizes(tokenizer: str | None):
    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(tokenizer or tokens.default_path())
        for batch in batches:
            texts = [t.as_py() for t in binary(batch.column("text"))]
            clusters = [
                int.from_bytes(hashlib.sha256(normalised(t)).digest()[:8], "big", signed=True) for t in texts
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    batch.column("source"),
                    pa.array(clusters, pa.int64()),
                    pa.array([encode.count(t) + 1 for t in texts], pa.int64()),
                ],
                ["row", "doc_id", "source", "cluster", "size"],
            )

    return returning(sizes)


def sizes(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Per row: row (a number of its own), doc_id, source, cluster (of equal
    texts), size in tokens."""
    prepare(docs.sparkSession)
    source = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("bigint"),
        F.col("source").cast("string"),
        F.col("text").cast("string"),
    )
    return source.mapInArrow(
        _sizes(tokenizer), "row bigint, doc_id bigint, source string, cluster bigint, size bigint"
    )


def _bits(values: list) -> list[int]:
    """A bit for each value that occurs more than once, 0 for the others: they
    conflict with nothing."""
    counts = Counter(v for v in values if v is not None)
    bit = {v: 1 << k for k, v in enumerate(v for v, n in counts.items() if n > 1)}
    return [bit.get(v, 0) for v in values]


def best_fit(pieces: list[tuple[int, int, int]], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) for each piece (size, source bits, cluster bits), in order."""
    open_bins: list[int] = []  # residual and number of each open bin, in order
    sources: list[int] = []
    clusters: list[int] = []
    placed = []
    for size, source, cluster in pieces:
        at = bisect_left(open_bins, size << _SHIFT)
        while at < len(open_bins):
            k = open_bins[at] & ((1 << _SHIFT) - 1)
            if not (sources[k] & source or clusters[k] & cluster):
                residual = open_bins.pop(at) >> _SHIFT
                break
            at += 1
        else:
            k, residual = len(sources), capacity
            sources.append(0)
            clusters.append(0)
        placed.append((k, capacity - residual))
        sources[k] |= source
        clusters[k] |= cluster
        if residual > size:
            insort(open_bins, (residual - size) << _SHIFT | k)
    return placed


def pack_group(rows: list[dict], capacity: int, one_per_source: bool) -> list[dict]:
    """The pieces of one group's documents, with local bin numbers."""
    rows = sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["row"]))
    source_bits = _bits([r["source"] if one_per_source else None for r in rows])
    cluster_bits = _bits([r["cluster"] for r in rows])
    out, rests = [], []
    for r, source, cluster in zip(rows, source_bits, cluster_bits):
        full, rest = divmod(r["size"], capacity)
        for piece in range(full):
            out.append({"doc_id": r["doc_id"], "piece": piece, "start": piece * capacity, "n_tokens": capacity,
                        "bin_id": len(out), "offset": 0})
        if rest:
            rests.append((rest, source, cluster, r["doc_id"], full))
    rests.sort(key=lambda p: -p[0])
    bins = len(out)
    for (size, _, _, doc, piece), (k, offset) in zip(rests, best_fit([p[:3] for p in rests], capacity)):
        out.append({"doc_id": doc, "piece": piece, "start": piece * capacity, "n_tokens": size,
                    "bin_id": bins + k, "offset": offset})
    return out


def pack_sizes(
    rows: DataFrame, *, capacity: int = CAPACITY, one_per_source: bool = True, group_tokens: int = GROUP_TOKENS
) -> DataFrame:
    """Packs a written table of ``sizes``; its ``cluster`` may be any clustering."""
    prepare(rows.sparkSession)
    total = rows.agg(F.sum("size")).first()[0] or 0
    groups = max(1, -(-total // group_tokens))

    def pack(table: pa.Table) -> pa.Table:
        group = table.column("group")[0].as_py()
        out = pack_group(table.drop_columns(["group"]).to_pylist(), capacity, one_per_source)
        for r in out:
            r["bin_id"] |= group << _SHIFT
        return pa.Table.from_pylist(out, _RESULT)

    group = F.pmod(F.xxhash64("doc_id", "row"), F.lit(groups)).alias("group")
    return rows.select("*", group).groupBy("group").applyInArrow(of_group(pack), RESULT)


def pack_documents(docs: DataFrame, *, tokenizer: str | None = None, **options) -> DataFrame:
    """One row per piece: doc_id, piece, start (its first token in the document),
    n_tokens, bin_id, offset (its first token in the bin)."""
    return pack_sizes(written(sizes(docs, tokenizer), "sizes"), **options)
