"""Dependent datasets, each materialised under a name the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame


def materialize(df: DataFrame, table_name: str) -> DataFrame:
    """Write ``df`` as the table ``table_name`` and return the table."""
    df.write.mode("overwrite").saveAsTable(table_name)
    return df.sparkSession.table(table_name)
