"""From staging rows to a validated, keyed table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewright.functions.timezones import get_timestamp_columns, utc_instant
from tidewright.operators.dedup import dedup_latest
from tidewright.operators.definition import TableDefinition
from tidewright.operators.observed import Counts
from tidewright.operators.projections import conform, fill_audit, strip_suffix
from tidewright.settings import FAILED, INGEST_LOGS_TABLE, SUCCESS, quoted, scratch_folder
from tidewright.sources.key_buckets import known_key
from tidewright.sources.load_log import insert_ingestion_log
from tidewright.sources.tables import (
    add_missing_columns_to_table,
    create_table_if_not_exists,
    insert_or_update_table,
    overwrite_partition,
)

# Partition column of quarantine tables: a run that is repeated replaces its rows.
EXECUTION_ID = "execution_id"
DUPLICATE_KEY = "duplicate key"
NULL_KEY = "null key"
_ROW = "__row"


@dataclass(frozen=True)
class RefineResult:
    """Every row processed is kept, failed, or a duplicate of a row kept."""

    records_processed: int
    records_failed: int
    records_duplicate: int = 0
    replaced_location: str | None = None

    @property
    def records_kept(self) -> int:
        return self.records_processed - self.records_failed - self.records_duplicate


def refine(
    staged: DataFrame,
    definition: TableDefinition,
    *,
    quarantine_table: str,
    log_table: str = INGEST_LOGS_TABLE,
    execution_id: str | None = None,
    force_remove_duplicates: bool = False,
    order_by: Sequence[Column] = (),
    partition_by: Sequence[str] = (),
) -> RefineResult:
    """Conform, validate, upsert the valid rows on the key, put the others with
    their reasons into ``quarantine_table``, and log the counts, or the failure.

    Several valid rows of one key are refused. With ``force_remove_duplicates``
    the first by ``order_by`` is kept (any of them without an order), and the
    others are quarantined with the reason ``duplicate key``. A row with a NULL in its
    key is quarantined with the reason ``null key``.

    The staged rows are evaluated once, into a scratch folder. A table without
    ``partition_by`` is rewritten whole by every run, and its old folder is
    returned for removal. A run that is repeated under its ``execution_id``
    replaces what it quarantined and leaves the table's rows as they are, but for
    ``updated_at``.
    """
    start, execution_id = datetime.now(), execution_id or uuid.uuid4().hex
    log = {
        "execution_id": execution_id,
        "source_system": definition.table_name,
        "table_name": definition.table_name,
        "start_time": start,
        "log_table": log_table,
    }
    try:
        with scratch_folder(staged.sparkSession, "refine") as folder:
            result = _refine(
                staged, definition, quarantine_table, execution_id, folder,
                list(order_by) if force_remove_duplicates else None, partition_by,
            )
    except Exception as e:
        insert_ingestion_log(**log, status=FAILED, end_time=datetime.now(), message=f"Error: {e}")
        raise
    insert_ingestion_log(
        **log,
        status=SUCCESS,
        records_processed=result.records_processed,
        records_failed=result.records_failed + result.records_duplicate,
        end_time=datetime.now(),
        message=f"Quarantined: {result.records_failed} failing rows, {result.records_duplicate} duplicates.",
    )
    return result


def _refine(
    staged: DataFrame,
    definition: TableDefinition,
    quarantine_table: str,
    execution_id: str,
    folder: str,
    order_by: list[Column] | None,
    partition_by: Sequence[str],
) -> RefineResult:
    spark, seen = staged.sparkSession, Counts()
    rows = conform(strip_suffix(utc_columns_as_instants(staged)), definition.columns)
    judged = definition.validate_with_reasons(rows).withColumn(_ROW, F.monotonically_increasing_id())
    # A row without a key can be neither updated nor recognised when a run is repeated.
    unkeyed = F.when(F.col("is_row_valid") & ~known_key(definition.key_columns), F.array(F.lit(NULL_KEY)))
    judged = judged.withColumns(
        {
            "validation_errors": F.concat("validation_errors", F.coalesce(unkeyed, F.array().cast("array<string>"))),
            "is_row_valid": F.col("is_row_valid") & unkeyed.isNull(),
        }
    )
    judged = seen.of(
        judged, F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("is_row_valid")).alias("failed")
    )
    judged.write.parquet(f"{folder}/judged")
    judged = spark.read.schema(judged.schema).parquet(f"{folder}/judged")
    valid, failing = judged.where("is_row_valid"), judged.where("not is_row_valid")
    duplicates = 0
    if order_by is not None:
        losers = _losers(valid, definition.key_columns, order_by)
        dropped = Counts()
        dropped.of(losers, F.count(F.lit(1)).alias("rows")).write.parquet(f"{folder}/losers")
        duplicates = dropped["rows"] or 0
    if duplicates:
        losers = spark.read.schema(losers.schema).parquet(f"{folder}/losers")
        valid = valid.join(losers, _ROW, "left_anti")
        reason = F.array(F.lit(DUPLICATE_KEY))
        lost = judged.join(losers, _ROW, "left_semi").withColumns(
            {"validation_errors": reason, "is_row_valid": F.lit(False)}
        )
        failing = failing.unionByName(lost)
    failing = failing.drop(_ROW)
    # The quarantine is made ready before anything is committed.
    _prepare_quarantine(quarantine_table, failing.schema)
    definition.ensure_version_sync(partition_by=partition_by)
    clean = valid.drop(_ROW, "validation_errors", "is_row_valid")
    written = insert_or_update_table(
        fill_audit(clean) if definition.include_create_and_update else clean,
        definition.table_name,
        key_columns=definition.key_columns,
        schema_evolution=True,
        partition_by=partition_by,
    )
    overwrite_partition(failing, quarantine_table, EXECUTION_ID, execution_id)
    return RefineResult(seen["rows"] or 0, seen["failed"] or 0, duplicates, written.replaced_location)


def _losers(valid: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Numbers of the rows that are not the first of their key. A key's first row
    is found by partial aggregation, or below a group limit, so that a hot key sends
    one row per task."""
    known = valid.dropna(subset=list(keys))
    if order_by:
        firsts = dedup_latest(known, keys, [*order_by, F.col(_ROW)]).select(_ROW)
    else:
        firsts = known.groupBy(*[F.col(quoted(k)) for k in keys]).agg(F.min(_ROW).alias(_ROW)).select(_ROW)
    return known.select(_ROW).join(firsts, _ROW, "left_anti")


def _prepare_quarantine(table_name: str, rows: StructType) -> None:
    schema = StructType(
        [StructField(f.name, f.dataType) for f in rows.fields] + [StructField(EXECUTION_ID, StringType())]
    )
    if not create_table_if_not_exists(table_name, schema, partition_by=[EXECUTION_ID]):
        add_missing_columns_to_table(table_name, schema)


def utc_columns_as_instants(staged: DataFrame) -> DataFrame:
    """Zone-less ``_utc`` columns as TIMESTAMP: a later cast would read them as
    times of the session's zone."""
    names = [c for c in get_timestamp_columns(staged) if c.endswith("_utc")]
    return staged.withColumns({c: utc_instant(F.col(quoted(c))) for c in names}) if names else staged
