"""Helpers shared by the operators: names, written intermediates, checked broadcasts."""

from __future__ import annotations

import os
import pathlib
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.operators.joins import size_in_bytes
from tidewright.settings import fresh_folder

# A side of a join is broadcast only when it has been counted to have at most
# this many rows of a few numbers each; a larger one is joined by shuffle.
BROADCAST_ROWS = 100_000


# Bytes of an Arrow batch. A batch exists several times, in the JVM and in Python,
# for each core; Spark's default of 64 MB would take most of a small executor.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to ``BATCH_BYTES``, and makes this package
    importable in Python workers, which need not have the driver's path: once a
    session, unless PYTHONPATH names the package's folder."""
    if not 0 < size_in_bytes(spark.conf.get(_BATCH)) <= BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    root, context = pathlib.Path(__file__).resolve().parents[2], spark.sparkContext
    known = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if context.applicationId in _shipped or str(root) in known:
        return
    # Spark itself hands the archive from the driver to the executors.
    archive = f"{tempfile.mkdtemp(prefix='tidewright-')}/tidewright"
    context.addPyFile(shutil.make_archive(archive, "zip", root, "tidewright"))
    _shipped.add(context.applicationId)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, and read again
    from there whatever executors are lost."""
    spark = df.sparkSession
    prepare(spark)
    folder = fresh_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def small_side(table: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A written table, marked for broadcast if it has at most ``limit`` rows."""
    return F.broadcast(table) if table.count() <= limit else table


def slices(spark: SparkSession) -> int:
    """Into how many slices hashes are dealt: a few for each shuffle partition,
    so that a slice shrinks as the partitions are raised with the data."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores added until no column of the frame has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_and_text(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Only the two columns an operator reads, as bigint and string."""
    prepare(docs.sparkSession)
    return docs.select(
        F.col(f"`{id_column}`").cast("bigint").alias("doc_id"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )


def id_order(column: Column | str = "doc_id") -> Column:
    """An id as a sort key; null ids come last."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit((1 << 63) - 1))
