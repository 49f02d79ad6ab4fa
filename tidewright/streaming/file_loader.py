"""Load each file exactly once, with Structured Streaming.

The file source remembers in its checkpoint which paths it has read. Each
micro-batch overwrites a table partition of its own, named after the stream and
the batch: a batch that is replayed after a failure replaces its first attempt,
so neither a lost executor nor a lost driver loads a file twice.

A file is known by its path; changing it in place does not load it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewright.settings import LOAD_ID
from tidewright.sources.load_log import logged_loads
from tidewright.sources.tables import (
    add_missing_columns_to_table,
    create_table_if_not_exists,
    overwrite_partition,
)


def run_once(
    stream: DataFrame,
    checkpoint: str,
    each_batch: Callable[[DataFrame, str], None],
    started: Callable[[str], None] = lambda stream_id: None,
) -> list[str]:
    """Hand all files not seen under ``checkpoint`` to ``each_batch``, then stop.

    ``each_batch`` gets the rows and a name that is the same when the batch is
    replayed; it must be repeatable under that name. Returns the names.
    ``started`` gets the id that all names of this checkpoint begin with.
    """
    names: list[str] = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        name = f"{stream_id}-{batch_id:08d}"
        each_batch(batch, name)
        names.append(name)

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(handle)
        .start()
    )
    started(query.id)
    query.awaitTermination()
    return names


def prepare_staging_table(table_name: str, rows: StructType) -> None:
    """Create the table, partitioned by load, or give it the rows' new columns."""
    schema = StructType([*rows.fields, StructField(LOAD_ID, StringType())])
    if not create_table_if_not_exists(table_name, schema, partition_by=[LOAD_ID]):
        add_missing_columns_to_table(table_name, schema)


def load_new_files(
    stream: DataFrame,
    table_name: str,
    checkpoint: str,
    *,
    started: Callable[[str], None] = lambda stream_id: None,
) -> DataFrame | None:
    """Append the files not loaded yet to ``table_name``; returns the new rows,
    or None where no new file was found.

    The table is created, or given the stream's new columns, before the run.
    The frame returned reads only the partitions this run wrote.
    """
    prepare_staging_table(table_name, stream.schema)
    written = run_once(
        stream,
        checkpoint,
        lambda rows, name: overwrite_partition(rows, table_name, LOAD_ID, name),
        started,
    )
    if not written:
        return None
    # The batches were written by the stream's own copy of the session.
    spark = stream.sparkSession
    spark.catalog.refreshTable(table_name)
    return spark.table(table_name).where(F.col(LOAD_ID).isin(written))


class LoggedBatches:
    """Which batches of a stream have been logged.

    A batch may be committed by a run that ends before it can log it. What a run
    logs is therefore every batch in the table after the last one that is logged, be it
    its own or an earlier run's. They are logged as one load, named after the stream and
    its first and last batch, so that being logged and being marked as logged are one
    step. A replayed batch keeps its name, so it is not logged twice.
    """

    def __init__(self, spark: SparkSession, table_name: str, log_table: str):
        self.spark, self.table_name, self.log_table = spark, table_name, log_table
        self.stream_id: str | None = None

    def started(self, stream_id: str) -> None:
        self.stream_id = stream_id

    def missing(self) -> list[str]:
        """Names of the table's batches that are not logged."""
        if self.stream_id is None:
            return []
        self.spark.catalog.refreshTable(self.table_name)
        own = F.col(LOAD_ID).startswith(f"{self.stream_id}-")
        logged = logged_loads(self.spark, self.log_table).where(own)
        last = logged.agg(F.max(F.regexp_extract(LOAD_ID, r"-(\d+)$", 1))).first()[0]
        found = self.spark.sql(f"SHOW PARTITIONS {self.table_name}")
        names = found.select(F.regexp_extract("partition", f"^{LOAD_ID}=(.*)$", 1).alias(LOAD_ID)).where(own)
        if last is not None:
            names = names.where(F.col(LOAD_ID) > f"{self.stream_id}-{last}")
        return sorted(r[0] for r in names.collect())

    def rows_of(self, names: list[str]) -> DataFrame | None:
        return self.spark.table(self.table_name).where(F.col(LOAD_ID).isin(names)) if names else None

    def load_id(self, names: list[str]) -> str | None:
        """What the batches are logged under."""
        if not names:
            return None
        first, last = (n.rsplit("-", 1)[1] for n in (names[0], names[-1]))
        return f"{self.stream_id}-{first}-{last}"
