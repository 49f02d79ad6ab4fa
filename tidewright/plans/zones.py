"""The zones path: shapes with attributes and centroids, written and logged."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.geometry import centroid
from tidewright.operators.joins import join_lookup
from tidewright.operators.observed import Counts
from tidewright.settings import FAILED, INGEST_LOGS_TABLE, SUCCESS
from tidewright.sources.load_log import insert_ingestion_log
from tidewright.sources.tables import insert_or_update_table


def load_zones(
    zones: DataFrame,
    attributes: DataFrame,
    key: str,
    attribute_key: str,
    table_name: str,
    *,
    rings: str = "rings",
    log_table: str = INGEST_LOGS_TABLE,
    execution_id: str | None = None,
) -> int:
    """Join the attributes, replace the rings by the centroid, append, and log the
    load or its failure; returns the rows written, counted by the write."""
    start, seen = datetime.now(), Counts()
    log = {
        "execution_id": execution_id or uuid.uuid4().hex,
        "source_system": table_name,
        "table_name": table_name,
        "start_time": start,
        "log_table": log_table,
    }
    joined = join_lookup(zones, attributes, key, attribute_key)
    placed = joined.withColumn("__at", centroid(F.col(rings))).withColumns(
        {"longitude": F.col("__at.longitude"), "latitude": F.col("__at.latitude")}
    )
    rows = seen.of(placed.drop("__at", rings), F.count(F.lit(1)).alias("rows"))
    try:
        insert_or_update_table(rows, table_name, append_only=True)
    except Exception as e:
        insert_ingestion_log(**log, status=FAILED, end_time=datetime.now(), message=f"Error: {e}")
        raise
    written = seen["rows"] or 0
    insert_ingestion_log(
        **log, status=SUCCESS, records_processed=written, end_time=datetime.now(), message=f"{written} zones."
    )
    return written
