"""Exact de-duplication by counting quotient filters and byte verification.

1. Every row's normalised text gets a fingerprint of 64 bits, split into a
   quotient (upper bits: the slot) and a remainder (stored in the slot).
2. Each task builds a counting quotient filter per slice of fingerprints: an
   occupied bit per quotient, a run-end bit per stored remainder, the
   remainders in sorted order, and a counter for each.
3. The filters of a slice are merged without loss: as both quotients and
   remainders are sorted, a merge is a merge of sorted lists that adds counters.
4. Only rows whose fingerprint has a count above one are compared by bytes: they
   are grouped by the whole normalised text (with map-side partial counts, so a
   text with a third of all rows sends one row per task).

Cases: a null text counts as empty, and empty texts equal each other. Of equal
texts the row with the smallest id stays; a null id is larger than any other;
of rows with one id and equal texts exactly one stays. An empty table gives an
empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import free_name, id_and_text, id_order, slices, small_side, written
from tidewright.llm.text import binary, returning

_WHITE = b" \t\n\v\f\r"
BLANKS = r"[\x20\x09-\x0D]+"


def normalised(text: bytes) -> bytes:
    """The text with every run of white space as one blank."""
    words = text.split()
    if not words:
        return text[:1] and b" "
    return (
        (b" " if text[0] in _WHITE else b"") + b" ".join(words) + (b" " if text[-1] in _WHITE else b"")
    )


def _sha(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()


def _fingerprint(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big", signed=True)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = [_sha(normalised(t.as_py())) for t in binary(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                batch.column("doc_id"),
                pa.array([_fingerprint(d) for d in digests], pa.int64()),
                pa.array([d.hex() for d in digests], pa.string()),
            ],
            ["row", "doc_id", "fingerprint", "text_sha256"],
        )


def _normalised_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [normalised(t.as_py()) for t in binary(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([_fingerprint(_sha(t)) for t in texts], pa.int64()), pa.array(texts, pa.binary())],
            ["fingerprint", "body"],
        )


# Counting quotient filters


def build_filter(fingerprints: np.ndarray) -> dict:
    """A filter of these 64-bit fingerprints, with about one quotient for each."""
    values, counts = np.unique(fingerprints, return_counts=True)
    bits = max(1, int(len(values)).bit_length())
    quotients = values >> np.uint64(64 - bits)
    occupied = np.zeros(1 << bits, bool)
    occupied[quotients] = True
    run_ends = np.append(quotients[1:] != quotients[:-1], True)[: len(values)]
    return {
        "quotient_bits": bits,
        "occupied": np.packbits(occupied).tobytes(),
        "run_ends": np.packbits(run_ends).tobytes(),
        "remainders": (values << np.uint64(bits)).tobytes(),
        "counts": counts.astype(np.uint32).tobytes(),
    }


def read_filter(f: dict) -> tuple[np.ndarray, np.ndarray]:
    """(sorted fingerprints, counts): quotient and remainder put together again."""
    bits = f["quotient_bits"]
    remainders = np.frombuffer(f["remainders"], np.uint64)
    ends = np.unpackbits(np.frombuffer(f["run_ends"], np.uint8))[: len(remainders)].astype(bool)
    quotients = np.flatnonzero(np.unpackbits(np.frombuffer(f["occupied"], np.uint8))).astype(np.uint64)
    run = np.cumsum(ends) - ends
    return (
        (quotients[run] << np.uint64(64 - bits)) | (remainders >> np.uint64(bits)),
        np.frombuffer(f["counts"], np.uint32).astype(np.int64),
    )


def merge_filters(filters: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints of all filters, in order, with their counters added."""
    parts = [read_filter(f) for f in filters]
    values = np.concatenate([v for v, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(values, kind="stable")  # timsort: a merge of sorted runs
    values, counts = values[order], counts[order]
    heads = np.flatnonzero(np.append(True, values[1:] != values[:-1])[: len(values)])
    return values[heads], np.add.reduceat(counts, heads) if len(heads) else counts


_FILTER = (
    "slice int, quotient_bits int, occupied binary, run_ends binary, remainders binary, counts binary"
)


def _filters(n: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One filter for a batch and slice: memory is bounded by the batch.
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            where = values % np.uint64(n)
            for k in np.unique(where):
                yield pa.RecordBatch.from_pylist(
                    [{"slice": int(k), **build_filter(values[where == k])}], _filter_schema()
                )

    return build


def _filter_schema() -> pa.Schema:
    return pa.schema(
        [("slice", pa.int32()), ("quotient_bits", pa.int32())]
        + [(c, pa.binary()) for c in ("occupied", "run_ends", "remainders", "counts")]
    )


def _repeated(table: pa.Table) -> pa.Table:
    values, counts = merge_filters(table.to_pylist())
    return pa.table({"fingerprint": pa.array(values[counts > 1].view(np.int64), pa.int64())})


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    source = id_and_text(docs, id_column, text_column)
    rows = written(
        source.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
            _fingerprints, "row bigint, doc_id bigint, fingerprint bigint, text_sha256 string"
        ),
        "fingerprints",
    )
    filters = rows.select("fingerprint").mapInArrow(returning(_filters(slices(spark))), _FILTER)
    repeated = small_side(
        written(filters.groupBy("slice").applyInArrow(_repeated, "fingerprint bigint"), "repeated")
    )
    # Byte verification: groups of equal bytes among the rows of repeated fingerprints.
    classes = (
        source.select("text")
        .mapInArrow(returning(_normalised_rows), "fingerprint bigint, body binary")
        .join(repeated, "fingerprint", "left_semi")
        .groupBy("body")
        .agg(F.count("*").alias("group_size"))
        .where("group_size > 1")
        .select(F.sha2("body", 256).alias("text_sha256"), "group_size")
    )
    winners = (
        rows.join(repeated, "fingerprint", "left_semi")
        .groupBy("text_sha256")
        .agg(F.min(F.struct(id_order().alias("rank"), "row", "doc_id")).alias("winner"))
        .join(classes, "text_sha256")
    )
    # Written, so that both sides of the join are plain exchanges, whose hot texts
    # Spark can split, where the classes are too many to broadcast.
    winners = small_side(written(winners, "winners"))
    return rows.join(winners, "text_sha256", "left").select(
        "doc_id",
        F.when(F.col("winner").isNull(), F.col("doc_id")).otherwise(F.col("winner.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (F.col("winner").isNull() | (F.col("winner.row") == F.col("row"))).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    sha, id_, again, stays = (free_name(docs, c) for c in ("sha__", "id__", "again__", "stays__"))
    # Ids and texts with a row to drop: all rows of it go, or all but one.
    pairs = written(
        exact_dedup(docs, id_column, text_column)
        .where("group_size > 1")
        .groupBy(F.col("doc_id").alias(id_), F.col("text_sha256").alias(again))
        .agg(F.max("kept").alias(stays), F.count("*").alias("n"))
        .where(f"not {stays} or n > 1")
        .drop("n"),
        "copies",
    )
    body = F.regexp_replace(F.coalesce(F.col(f"`{text_column}`"), F.lit("")), BLANKS, " ")
    marked = docs.withColumn(sha, F.sha2(body.cast("binary"), 256)).join(
        small_side(pairs),
        F.col(f"`{id_column}`").cast("bigint").eqNullSafe(F.col(id_)) & (F.col(sha) == F.col(again)),
        "left",
    )
    names = [F.col(f"`{c}`") for c in docs.columns]
    kept = marked.where(F.col(stays).isNull()).select(*names)
    if pairs.where(stays).isEmpty():
        return kept
    once = marked.where(stays).dropDuplicates([id_column, sha]).select(*names)
    return kept.unionByName(once)
