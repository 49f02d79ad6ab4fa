"""Token totals by source, language and tokenizer version, maintained from deltas.

A change of a document is a signed row: an insert adds its count, a delete takes
it away, and a revised count is both. A batch of changes is summed into one
small table per batch; totals are the sum over committed batches, so nothing
that was counted is ever read again. A batch counts once it is named in the
commit log, and a batch that is named there is not taken again: a batch that was
interrupted is written anew, and one that is replayed changes nothing.
Compaction folds batches into one, which remembers their names.

Cases: a null text has no tokens. A null source or language is a group of its
own. Groups whose documents have all been taken away are left out of the totals.
An empty batch is committed and adds nothing; totals of nothing are empty.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import tokens
from tidewright.llm.common import prepare, written
from tidewright.llm.text import binary, returning

KEYS = ("source", "lang", "tokenizer")
TOTALS = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"
LOG = "batch string, folder string, folds array<string>"

WORDS, BPE = "words/1", "word_bpe_49k/1"


def _counts(tokenizer: str | None):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(tokenizer or tokens.default_path())
        for batch in batches:
            texts = [t.as_py() for t in binary(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "source", "lang")]
                + [
                    pa.array([len(t.split()) for t in texts], pa.int64()),
                    pa.array([encode.count(t) for t in texts], pa.int64()),
                ],
                ["doc_id", "source", "lang", "n_words", "n_tokens"],
            )

    return returning(count)


def document_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Per row: doc_id, source, lang, n_words, n_tokens."""
    prepare(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("bigint"), *(F.col(c).cast("string") for c in ("source", "lang", "text"))
    ).mapInArrow(
        _counts(tokenizer), "doc_id bigint, source string, lang string, n_words bigint, n_tokens bigint"
    )


def signed(rows: DataFrame, tokenizer: str, count: str, sign: int) -> DataFrame:
    """The delta of adding (sign 1) or taking away (sign -1) these documents."""
    return rows.select(
        "source",
        "lang",
        F.lit(tokenizer).alias("tokenizer"),
        F.lit(sign).cast("bigint").alias("n_docs"),
        (F.col(count) * sign).cast("bigint").alias("n_tokens"),
    )


def inserted(rows: DataFrame, tokenizer: str, count: str) -> DataFrame:
    return signed(rows, tokenizer, count, 1)


def deleted(rows: DataFrame, tokenizer: str, count: str) -> DataFrame:
    return signed(rows, tokenizer, count, -1)


def revised(rows: DataFrame, old: tuple[str, str], new: tuple[str, str]) -> DataFrame:
    """Counts (tokenizer, column) replaced by others."""
    return deleted(rows, *old).unionByName(inserted(rows, *new))


def summed(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


class Rollup:
    """Totals kept in a shared folder; one writer at a time."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        if not self._exists():
            spark.createDataFrame([], LOG).write.mode("ignore").parquet(f"{folder}/log")

    def _exists(self) -> bool:
        try:
            return self.spark.read.schema(LOG).parquet(f"{self.folder}/log") is not None
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return False

    def _log(self) -> list:
        # Control data: one row for each batch.
        return self.spark.read.schema(LOG).parquet(f"{self.folder}/log").collect()

    def _record(self, batch: str, folder: str, folds: list[str]) -> None:
        row = self.spark.createDataFrame([(batch, folder, folds)], LOG)
        row.coalesce(1).write.mode("append").parquet(f"{self.folder}/log")

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Adds a batch of deltas; False, and no change, if it has been added before."""
        if any(r.batch == batch for r in self._log()):
            return False
        folder = f"{self.folder}/deltas/{uuid.uuid4().hex}"
        summed(deltas).write.parquet(folder)
        self._record(batch, folder, [])
        return True

    def _live(self) -> dict[str, str]:
        log = {r.batch: r for r in self._log()}
        folded = {b for r in log.values() for b in r.folds}
        return {b: r.folder for b, r in log.items() if b not in folded}

    def totals(self) -> DataFrame:
        folders = list(self._live().values())
        if not folders:
            return self.spark.createDataFrame([], TOTALS)
        rows = self.spark.read.schema(TOTALS).parquet(*folders)
        return summed(rows).where("n_docs <> 0 or n_tokens <> 0")

    def compact(self) -> None:
        """Folds all batches into one."""
        live = list(self._live())
        folder = f"{self.folder}/deltas/{uuid.uuid4().hex}"
        self.totals().coalesce(1).write.parquet(folder)
        self._record(f"fold-{uuid.uuid4().hex}", folder, live)


def maintained_counts(docs: DataFrame, folder: str, tokenizer: str | None = None) -> DataFrame:
    """The life of a corpus: all documents are inserted with counts of words, all
    are counted anew with a tokenizer, those without a token are deleted, and
    two batches are replayed."""
    counts = written(document_counts(docs, tokenizer), "counts")
    rollup = Rollup(docs.sparkSession, folder)
    rollup.commit("load", inserted(counts, WORDS, "n_words"))
    recount = revised(counts, (WORDS, "n_words"), (BPE, "n_tokens"))
    rollup.commit("recount", recount)
    rollup.compact()
    rollup.commit("load", inserted(counts, WORDS, "n_words"))
    rollup.commit("empty", deleted(counts.where("n_tokens = 0"), BPE, "n_tokens"))
    rollup.commit("recount", recount)
    return rollup.totals()
