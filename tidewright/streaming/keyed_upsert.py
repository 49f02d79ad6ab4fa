"""Keyed upsert of a stream: every new row once, however often a batch is replayed.

Each micro-batch is an upsert. Within a batch the last row of a key by the stated
columns counts, and a row that arrives after a later one of an earlier batch changes
nothing. The rows carry the name of the batch that wrote them, and the table's
properties name the last batch applied of each stream: a batch at or before it is
skipped. A batch whose mark was lost is applied again; it writes the same values under
the same keys, and rows with a NULL in their key are left out if the table has those of
this batch.

One stream, or any other writer, may write to a table at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewright.operators import merge
from tidewright.operators.dedup import dedup_latest
from tidewright.operators.tasks import in_small_tasks
from tidewright.settings import quoted, sql_text
from tidewright.sources.key_buckets import known_key, layout_of
from tidewright.sources.tables import (
    add_missing_columns_to_table,
    insert_or_update_table,
    table_details,
)
from tidewright.streaming.file_loader import run_once

# Which batch last wrote a row: stream id and number of the batch.
APPLIED_BATCH = "applied_batch"
_PROPERTY = "applied_batch."


def last_applied(spark: SparkSession, table_name: str, stream_id: str) -> str | None:
    """The name of the stream's last batch in the table; names ascend with the batches."""
    if not spark.catalog.tableExists(table_name):
        return None
    props = spark.sql(f"SHOW TBLPROPERTIES {table_name}")
    found = props.where(F.col("key") == f"{_PROPERTY}{stream_id}").collect()
    return found[0]["value"] if found else None


@in_small_tasks
def apply_batch(
    batch: DataFrame,
    name: str,
    table_name: str,
    key_columns: Sequence[str],
    *,
    newest_by: Sequence[str],
    key_buckets: int | None = None,
    schema_evolution: bool = False,
) -> bool:
    """Upsert one named batch; False if the table has it. ``name`` is the stream's id, a
    dash and the batch's number with leading zeros."""
    spark, stream_id = batch.sparkSession, name.rsplit("-", 1)[0]
    applied = last_applied(spark, table_name, stream_id)
    if applied is not None and name <= applied:
        return False
    if not newest_by:
        raise ValueError("newest_by must name the columns that order the rows of a key.")
    merge.require_columns(batch, [*key_columns, *newest_by])
    rows = batch.withColumn(APPLIED_BATCH, F.lit(name))
    if spark.catalog.tableExists(table_name):
        spark.catalog.refreshTable(table_name)
        # Elsewhere the rows of a batch are not published together.
        if table_details(table_name).partition_columns and layout_of(table_name) is None:
            raise ValueError(f"{table_name}: a stream upserts into unpartitioned tables or key buckets.")
        add_missing_columns_to_table(table_name, StructType([StructField(APPLIED_BATCH, StringType())]))
        rows = _without_unkeyed_of(rows, spark.table(table_name), name, key_columns)
    order = [F.desc_nulls_last(quoted(c)) for c in newest_by]
    # Rows that are equal by these columns: a replay must choose the same one.
    order.append(F.xxhash64(F.to_json(F.struct("*"))))
    latest = dedup_latest(rows, key_columns, order)
    insert_or_update_table(
        latest,
        table_name,
        key_columns=key_columns,
        key_buckets=key_buckets,
        newest_by=newest_by,
        schema_evolution=schema_evolution,
    )
    mark = f"{sql_text(_PROPERTY + stream_id)} = {sql_text(name)}"
    spark.sql(f"ALTER TABLE {table_name} SET TBLPROPERTIES ({mark})")
    return True


def _without_unkeyed_of(
    rows: DataFrame, table: DataFrame, name: str, keys: Sequence[str]
) -> DataFrame:
    """The rows, without those that have no key where the table holds such of this batch:
    they are published together, so it then has all of them."""
    there = table.where(~known_key(keys) & (F.col(APPLIED_BATCH) == name))
    return rows if there.isEmpty() else rows.where(known_key(keys))


def upsert_stream(
    stream: DataFrame,
    table_name: str,
    key_columns: Sequence[str],
    checkpoint: str,
    *,
    newest_by: Sequence[str],
    key_buckets: int | None = None,
    schema_evolution: bool = False,
) -> list[str]:
    """Upsert what is new in the stream, then stop; the names of the batches run.

    ``newest_by`` orders the rows of a key, the last one counts; its later columns decide
    ties of the earlier ones. ``key_buckets`` lays out a table that is created, so that a
    batch rewrites only the buckets of its keys.
    """
    names = run_once(
        stream,
        checkpoint,
        lambda rows, name: apply_batch(
            rows,
            name,
            table_name,
            key_columns,
            newest_by=newest_by,
            key_buckets=key_buckets,
            schema_evolution=schema_evolution,
        ),
    )
    spark = stream.sparkSession
    if spark.catalog.tableExists(table_name):
        # The batches were written by the stream's own copy of the session.
        spark.catalog.refreshTable(table_name)
    return names
