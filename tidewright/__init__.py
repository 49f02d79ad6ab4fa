"""Spark-first building blocks for table pipelines.

Load files once each into staging tables from a registry of sources, bring
zone-less timestamps to UTC, describe tables declaratively, validate rows with
reasons, and write tables by append and keyed upsert with a load log.
"""

from tidewright.operators.definition import (
    ColumnDefinition,
    TableDefinition,
    create_table_definition_from_dict,
)
from tidewright.plans.staging import (
    populate_stg_tables_from_sql,
    populate_stg_tables_from_storage,
)
from tidewright.sources.load_log import insert_ingestion_log
from tidewright.sources.registry import insert_or_update_process_table
from tidewright.sources.tables import (
    TableCreationError,
    add_missing_columns_to_table,
    create_table_if_not_exists,
    insert_or_update_table,
)

__all__ = [
    "ColumnDefinition",
    "TableDefinition",
    "TableCreationError",
    "add_missing_columns_to_table",
    "create_table_definition_from_dict",
    "create_table_if_not_exists",
    "insert_ingestion_log",
    "insert_or_update_process_table",
    "insert_or_update_table",
    "populate_stg_tables_from_sql",
    "populate_stg_tables_from_storage",
]
