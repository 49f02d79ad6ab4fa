"""A corpus pipeline: each stage writes its documents as Parquet, and the next reads them.

All stages but the last return the columns of ``documents``; the last returns
where the tokens of each document that stayed go: doc_id, piece, start, n_tokens,
bin_id, offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewright.llm.common import documents, written
from tidewright.llm.decontamination import without_contaminated
from tidewright.llm.exact_dedup import without_copies
from tidewright.llm.ngram_join import one_of_each
from tidewright.llm.packing import pack_documents
from tidewright.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar rejects go."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return without_copies(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest id stays."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark go."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of each document get places in bins."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Greedy tiling, a learned grammar and best-fit packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
