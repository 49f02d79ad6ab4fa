"""Registry-driven staging loads."""

from __future__ import annotations

import logging
import threading
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.timezones import apply_timezone_conversion
from tidewright.operators.aggregates import file_load_stats
from tidewright.operators.projections import (
    LINEAGE_COLUMNS,
    select_text,
    where_clauses,
    with_lineage,
)
from tidewright.settings import (
    FAILED,
    INGEST_LOGS_TABLE,
    LOAD_ID,
    SRC_DEFINITIONS_TABLE,
    shared_folder,
)
from tidewright.sources.files import scan, scan_stream, spark_format
from tidewright.sources.load_log import insert_ingestion_log, log_load
from tidewright.sources.registry import active_sources
from tidewright.sources.schema_ledger import folder_schema
from tidewright.sources.tables import overwrite_partition
from tidewright.streaming.file_loader import LoggedBatches, load_new_files, prepare_staging_table

logger = logging.getLogger(__name__)


def staged_rows(
    files: DataFrame,
    select_columns: str | None,
    *filters: str | None,
    source_timezone: str | None = None,
) -> DataFrame:
    """Filter, project, optionally shift times to UTC, and add lineage.

    Filters see the file's columns; only projected columns are converted.
    """
    rows = where_clauses(files, *filters)
    rows = select_text(with_lineage(rows), select_columns, also=LINEAGE_COLUMNS)
    if source_timezone:
        rows = apply_timezone_conversion(
            rows, source_timezone=source_timezone, also=LINEAGE_COLUMNS
        )
    return rows


def populate_stg_tables_from_storage(
    tg_table_names: str | Sequence[str],
    *,
    file_format: str = "parquet",
    filter_condition: str | None = None,
    timezone_to_utc: bool = False,
    source_timezone: str | None = None,
    csv_header: bool = False,
    csv_delimiter: str = ",",
    registry_table: str = SRC_DEFINITIONS_TABLE,
    log_table: str = INGEST_LOGS_TABLE,
    checkpoint_root: str | None = None,
    execution_id: str | None = None,
    schema: str | None = None,
    options: Mapping[str, str] | None = None,
    at_once: int = 4,
) -> dict[str, int]:
    """Load the new files of each named, active source; rows loaded per table.

    ``filter_condition`` applies together with the registry's. What has been
    loaded is remembered below ``checkpoint_root``, by default a folder in
    ``spark.checkpoint.dir``; it must outlive the job. ``options`` go to the
    file source; ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` sets the size
    of the batches a large first load is committed in. Up to ``at_once`` tables are
    loaded at the same time.
    """
    if timezone_to_utc and not source_timezone:
        raise ValueError("source_timezone is required when timezone_to_utc is set.")
    spark_format(file_format)
    spark = SparkSession.active()
    if not checkpoint_root and not spark.conf.get("spark.checkpoint.dir", None):
        raise ValueError("What has been loaded must be remembered: pass checkpoint_root or set spark.checkpoint.dir.")
    root = checkpoint_root or f"{shared_folder(spark)}/loaded-files"

    def load(source: Row, batches: list[LoggedBatches]) -> DataFrame | None:
        csv = {"csv_header": csv_header, "csv_delimiter": csv_delimiter}
        path = source["volume"]
        checkpoint = f"{root}/{source['stg_table']}/{source['source_system']}"
        known = schema or folder_schema(spark, path, file_format, f"{checkpoint}.schema", options=options, **csv)
        files = scan_stream(spark, path, known, file_format, options=options, **csv)
        rows = staged_rows(
            files,
            source["select_columns"],
            source["filter_condition"],
            filter_condition,
            source_timezone=source_timezone if timezone_to_utc else None,
        )
        logged = LoggedBatches(spark, source["stg_table"], log_table)
        batches.append(logged)
        return load_new_files(rows, source["stg_table"], checkpoint, started=logged.started)

    return _load_each(tg_table_names, load, registry_table, log_table, execution_id, at_once)


def populate_stg_tables_from_sql(
    tg_table_names: str | Sequence[str],
    *,
    filter_condition: str | None = None,
    registry_table: str = SRC_DEFINITIONS_TABLE,
    log_table: str = INGEST_LOGS_TABLE,
    execution_id: str | None = None,
    at_once: int = 4,
) -> dict[str, int]:
    """Append each named, active source's Parquet path as it is now, without
    remembering files: a second call appends the rows again."""
    spark = SparkSession.active()
    run = uuid.uuid4().hex

    def load(source: Row, batches: list[LoggedBatches]) -> DataFrame:
        rows = staged_rows(
            scan(spark, source["volume"]),
            source["select_columns"],
            source["filter_condition"],
            filter_condition,
        )
        table, name = source["stg_table"], f"{run}-{source['source_system']}"
        prepare_staging_table(table, rows.schema)
        overwrite_partition(rows, table, LOAD_ID, name)
        return spark.table(table).where(F.col(LOAD_ID) == name)

    return _load_each(tg_table_names, load, registry_table, log_table, execution_id, at_once)


def _load_each(
    names: str | Sequence[str],
    load: Callable[[Row, list[LoggedBatches]], DataFrame | None],
    registry_table: str,
    log_table: str,
    execution_id: str | None,
    at_once: int,
) -> dict[str, int]:
    """Load the sources, those of different tables at once, and log each load.

    A table has one writer at a time, so sources that feed one table follow each other. A
    failure leaves the other tables' loads alone; the first one is raised when all are
    done.
    """
    spark, execution_id = SparkSession.active(), execution_id or uuid.uuid4().hex
    # As many rows as the caller named tables: control data, not data.
    sources = active_sources(names, registry_table).collect()
    if not sources:
        logger.warning("No active source is registered for %s.", names)
    of_tables: dict[str, list[Row]] = {}
    for source in sources:
        of_tables.setdefault(source["stg_table"], []).append(source)
    logging_lock = threading.Lock()  # the log is a table with one writer, too

    @inheritable_thread_target(spark)
    def load_table(table: str) -> int:
        # A thread has no active session of its own. Where the session schedules fairly,
        # each table is a pool.
        spark._jvm.SparkSession.setActiveSession(spark._jsparkSession)
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"load-{table}")
        return sum(_load_one(s, load, log_table, execution_id, logging_lock) for s in of_tables[table])

    with ThreadPoolExecutor(max(1, min(at_once, len(of_tables)))) as pool:
        loads = {table: pool.submit(load_table, table) for table in of_tables}
    return {table: done.result() for table, done in loads.items()}


def _load_one(
    source: Row,
    load: Callable[[Row, list[LoggedBatches]], DataFrame | None],
    log_table: str,
    execution_id: str,
    logging_lock: threading.Lock,
) -> int:
    """Run ``load``, log it and its files, re-raise its failure; the rows loaded.

    The statistics come from the rows just written, never from a second
    evaluation of the source. Where batches are tracked, those that an earlier run
    committed and could not log are logged too, and those that this run commits
    before it fails are logged beside the failure.
    """
    table, start = source["stg_table"], datetime.now()
    batches: list[LoggedBatches] = []
    facts = {
        "execution_id": execution_id,
        "source_system": source["volume"],
        "table_name": table,
        "start_time": start,
        "log_table": log_table,
    }

    def log(rows: DataFrame | None, load_id: str | None = None) -> int:
        return log_load(None if rows is None else file_load_stats(rows), load_id=load_id, **facts)

    try:
        new_rows = load(source, batches)
        with logging_lock:
            if not batches:
                return log(new_rows)
            names = batches[0].missing()
            return log(batches[0].rows_of(names), batches[0].load_id(names))
    except Exception as e:
        with logging_lock:
            for b in batches:
                names = b.missing()
                if names:
                    log(b.rows_of(names), b.load_id(names))
            insert_ingestion_log(**facts, status=FAILED, end_time=datetime.now(), message=f"Error: {e}")
        raise
