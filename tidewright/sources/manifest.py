"""Once-only batch load with a manifest of files: path, size, time of change, load.

A listing of the folder, made by Spark without reading a byte of the files, is compared
with the manifest; neither passes through the driver. A file whose size or time has
changed under its old path is loaded again, and its former rows go.

Every load writes a partition of its own, in this order: its rows, its manifest entries,
then the former rows and entries of changed files are taken out. A load counts once the
manifest names it. What a lost driver left behind is put right by the next load:
partitions of loads the manifest does not name are dropped, and files it names twice are
finished. The names of a manifest's loads begin with its id, a property of its table, so
that other loads may write to the same staging table.

Files that vanish from the folder keep their rows; files without a byte are not listed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from tidewright.operators.aggregates import file_load_stats
from tidewright.operators.definition import TableDefinition
from tidewright.operators.projections import LINEAGE_COLUMNS, with_lineage
from tidewright.operators.tasks import in_small_tasks
from tidewright.settings import FAILED, LOAD_ID, quoted, scratch_folder, sql_text
from tidewright.sources.files import scan
from tidewright.sources.load_log import insert_ingestion_log, log_load, logged_loads
from tidewright.sources.rescue import misfit, rescued
from tidewright.sources.tables import (
    create_table_if_not_exists,
    overwrite_partition,
    replace_partitions,
)
from tidewright.streaming.file_loader import prepare_staging_table

_ID_PROPERTY = "manifest_id"
# Into how many pieces a task deals its rows of a load that is rewritten: they are sorted
# there, and a split of few bytes may hold millions of rows with the names of their files.
PARTS = 16
_FILE = [
    StructField("path", StringType()),
    StructField("size", LongType()),
    StructField("modified", TimestampType()),
]
MANIFEST = StructType([*_FILE, StructField(LOAD_ID, StringType())])


@dataclass(frozen=True)
class ManifestLoad:
    """``load_id`` is None where no file was loaded. Refused files are neither new nor
    changed ones; as the manifest does not name them, the next load tries them again."""

    load_id: str | None
    new_files: int = 0
    changed_files: int = 0
    rows: int = 0
    refused_files: int = 0


def listed_files(spark: SparkSession, path: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """(path, size, modified, location) of the files below a path; their content is not
    read. ``path`` is as in lineage columns, ``location`` as readers take it."""
    files = spark.read.format("binaryFile").options(**(options or {})).load(path)
    return files.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("path").alias("location"),
    )


@in_small_tasks
def load_by_manifest(
    path: str,
    table_name: str,
    manifest_table: str,
    *,
    file_format: str = "parquet",
    schema: str | StructType | None = None,
    options: Mapping[str, str] | None = None,
    transform: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    definition: TableDefinition | None = None,
    refuse_above: float | None = None,
    log_table: str | None = None,
    execution_id: str | None = None,
) -> ManifestLoad:
    """Load the files of a folder that are new or have changed, with lineage columns.

    ``transform`` maps the rows of the files before they are written and must keep the
    lineage columns. With a ``definition`` the rows take its columns and types, and what
    does not fit goes into a rescue column; a file is refused when the share of its rows
    with a value that does not fit is above ``refuse_above``; rows of its former version
    stay. ``options`` of the listing are ``recursiveFileLookup`` and ``pathGlobFilter``;
    all options go to the reader of the format.
    """
    spark, start = SparkSession.active(), datetime.now()
    execution_id = execution_id or uuid.uuid4().hex
    create_table_if_not_exists(manifest_table, MANIFEST, partition_by=[LOAD_ID])
    manifest_id = _manifest_id(manifest_table)
    recover(table_name, manifest_table)
    with scratch_folder(spark, "manifest") as folder:
        pending = _pending(spark, path, manifest_table, options, f"{folder}/pending")
        facts = pending.agg(
            F.count(F.lit(1)).alias("files"), F.count_if("changed").alias("changed"),
            F.min("modified").alias("first"), F.max("modified").alias("last"),
        ).first()
        load_id, files, changed = None, facts["files"], facts["changed"]
        if files:
            rows = transform(_rows_of(spark, path, pending, facts, file_format, schema, options))
            if definition is not None:
                wanted = definition.to_schema(include_audit=False)
                rows = rescued(rows, wanted, also=LINEAGE_COLUMNS)
                if refuse_above is not None:
                    rows, refused = _judged(rows, wanted, refuse_above, f"{folder}/judged")
                    pending = pending.join(refused, "path", "left_anti")
                    files, changed = pending.agg(F.count(F.lit(1)), F.count_if("changed")).first()
        if files:
            load_id = f"{manifest_id}-{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
            prepare_staging_table(table_name, rows.schema)
            overwrite_partition(rows, table_name, LOAD_ID, load_id)
            overwrite_partition(pending.select("path", "size", "modified"), manifest_table, LOAD_ID, load_id)
            if changed:
                _take_out_former(table_name, manifest_table)
    refused_files, records = facts["files"] - files, 0
    if load_id and log_table is None:
        records = spark.table(table_name).where(F.col(LOAD_ID) == load_id).count()
    if log_table is not None:
        log = {"execution_id": execution_id, "source_system": path, "table_name": table_name, "log_table": log_table}
        # This load, and one that was lost before it could be logged.
        named = spark.table(manifest_table).select(LOAD_ID).distinct()
        for row in named.join(logged_loads(spark, log_table), LOAD_ID, "left_anti").collect():
            stats = file_load_stats(spark.table(table_name).where(F.col(LOAD_ID) == row[0]))
            logged = log_load(stats, start_time=start, load_id=row[0], **log)
            records = logged if row[0] == load_id else records
        if load_id is None:
            log_load(None, start_time=start, **log)
        if refused_files:
            insert_ingestion_log(
                **log, status=FAILED, start_time=start, end_time=datetime.now(),
                message=f"{refused_files} files refused: too many rows do not fit.",
            )
    return ManifestLoad(load_id, files - changed, changed, records, refused_files)


def _pending(
    spark: SparkSession, path: str, manifest_table: str, options: Mapping[str, str] | None, folder: str
) -> DataFrame:
    """(path, size, modified, changed) of the files the manifest lacks, written once."""
    selection = {k: v for k, v in (options or {}).items() if k in ("recursiveFileLookup", "pathGlobFilter")}
    known, file = spark.table(manifest_table), ["path", "size", "modified"]
    found = listed_files(spark, path, selection).join(known.select(*file), file, "left_anti")
    before = known.select(F.col("path").alias("known_path")).distinct()
    found = found.join(before, F.col("path") == F.col("known_path"), "left")
    found.select(*file, F.col("known_path").isNotNull().alias("changed")).write.parquet(folder)
    return spark.read.parquet(folder)


def _judged(
    rows: DataFrame, schema: StructType, refuse_above: float, folder: str
) -> tuple[DataFrame, DataFrame]:
    """(rows of accepted files, paths of the refused ones). The rows are evaluated once,
    into the folder, and counted there."""
    rows.write.parquet(folder)
    staged = rows.sparkSession.read.schema(rows.schema).parquet(folder)
    counted = staged.groupBy(F.col("source_file_path").alias("path")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(misfit(schema)).alias("misfits")
    )
    refused = counted.where(F.col("misfits") > F.lit(refuse_above) * F.col("n")).select("path")
    same = F.col("source_file_path") == F.col("path")
    return staged.join(refused, same, "left_anti"), refused


def _rows_of(
    spark: SparkSession,
    path: str,
    pending: DataFrame,
    facts: Row,
    file_format: str,
    schema: str | StructType | None,
    options: Mapping[str, str] | None,
) -> DataFrame:
    """The rows of the pending files. The range of their times prunes the scan's files;
    the join then decides, also where a file has changed since it was listed."""
    rows = with_lineage(
        scan(spark, path, file_format, schema=schema, options=options).where(
            F.col("_metadata.file_modification_time").between(facts["first"], facts["last"])
        ).withColumn("__size", F.col("_metadata.file_size"))
    )
    same = (
        (F.col("source_file_path") == F.col("path"))
        & (F.col("source_file_modified_at") == F.col("modified"))
        & (F.col("__size") == F.col("size"))
    )
    names = [F.col(f"r.{quoted(c)}") for c in rows.columns if c != "__size"]
    return rows.alias("r").join(pending.alias("p"), same, "left_semi").select(*names)


def _manifest_id(manifest_table: str) -> str:
    """What the names of this manifest's loads begin with; set when it is first used."""
    spark = SparkSession.active()
    found = spark.sql(f"SHOW TBLPROPERTIES {manifest_table}").where(F.col("key") == _ID_PROPERTY).collect()
    if found:
        return found[0]["value"]
    own = uuid.uuid4().hex[:16]
    spark.sql(f"ALTER TABLE {manifest_table} SET TBLPROPERTIES ({sql_text(_ID_PROPERTY)} = {sql_text(own)})")
    return own


def recover(table_name: str, manifest_table: str) -> None:
    """Finish or undo what an interrupted load has left in the table."""
    spark = SparkSession.active()
    if not spark.catalog.tableExists(table_name):
        return
    shown = spark.sql(f"SHOW PARTITIONS {table_name}").select(
        F.regexp_extract(F.col("partition"), f"^{LOAD_ID}=(.*)$", 1).alias(LOAD_ID)
    )
    named = spark.table(manifest_table).select(LOAD_ID).distinct()
    shown = shown.where(F.col(LOAD_ID).startswith(f"{_manifest_id(manifest_table)}-"))
    # Loads that were not finished: one at most, unless recovery was interrupted too.
    for row in shown.join(named, LOAD_ID, "left_anti").collect():
        spark.sql(f"ALTER TABLE {table_name} DROP IF EXISTS PARTITION ({LOAD_ID} = {sql_text(row[0])})")
    _take_out_former(table_name, manifest_table)


def _take_out_former(table_name: str, manifest_table: str) -> None:
    """Of paths that the manifest has twice, take the rows and entries of earlier loads out.
    Only the partitions of those loads are rewritten."""
    spark = SparkSession.active()
    entries = spark.table(manifest_table)
    last = entries.groupBy("path").agg(F.max(LOAD_ID).alias("last"), F.count(F.lit(1)).alias("n"))
    former = entries.join(last.where("n > 1"), "path").where(F.col(LOAD_ID) < F.col("last"))
    with scratch_folder(spark, "former") as folder:
        former.select(F.col("path").alias("former_path"), F.col(LOAD_ID).alias("former_load")).write.parquet(folder)
        former = spark.read.parquet(folder)
        # One value for each earlier load with a file that has changed since.
        loads = former.select(F.col("former_load").alias(LOAD_ID)).distinct().collect()
        if not loads:
            return
        for name, column in ((table_name, "source_file_path"), (manifest_table, "path")):
            spark.catalog.refreshTable(name)
            current = spark.table(name).where(F.col(LOAD_ID).isin([r[0] for r in loads]))
            gone = (F.col(column) == F.col("former_path")) & (F.col(LOAD_ID) == F.col("former_load"))
            replace_partitions(current.join(former, gone, "left_anti"), name, loads, PARTS)
            spark.catalog.refreshTable(name)
