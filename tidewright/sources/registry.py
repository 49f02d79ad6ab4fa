"""The source registry: which path, projection and filter feed which table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.operators.definition import ColumnDefinition, TableDefinition
from tidewright.operators.projections import fill_audit
from tidewright.settings import SRC_DEFINITIONS_TABLE
from tidewright.sources.tables import UpsertResult, insert_or_update_table

REGISTRY_KEYS = ("source_system", "stg_table")


def src_definitions(table_name: str = SRC_DEFINITIONS_TABLE) -> TableDefinition:
    names = ("source_system", "volume", "stg_table", "select_columns", "filter_condition")
    return TableDefinition(
        table_name=table_name,
        columns=[ColumnDefinition(n, "string") for n in names],
        key_columns=list(REGISTRY_KEYS),
    )


def insert_or_update_process_table(
    table_name: str,
    df: DataFrame,
    key_columns: Sequence[str] | None = None,
    force_remove_duplicates: bool = False,
    schema_evolution: bool = True,
) -> UpsertResult | None:
    """Upsert with audit columns: created_at survives re-loads, updated_at
    moves, is_active returns to true."""
    return insert_or_update_table(
        fill_audit(df),
        table_name,
        key_columns=key_columns,
        force_remove_duplicates=force_remove_duplicates,
        schema_evolution=schema_evolution,
    )


def active_sources(
    names: str | Sequence[str], registry_table: str = SRC_DEFINITIONS_TABLE
) -> DataFrame:
    """Active registry rows of the named staging tables."""
    listed = [names] if isinstance(names, str) else list(names)
    registry = SparkSession.active().table(registry_table)
    return registry.where(F.col("stg_table").isin(listed) & F.col("is_active"))
