"""Grouped statistics; each is one partial and one final hash aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def file_load_stats(staged: DataFrame) -> DataFrame:
    """Rows and latest modification time per loaded file.

    Files are told apart by their paths: those of one name in several folders
    are several files.
    """
    return (
        staged.groupBy("source_file_name", "source_file_path")
        .agg(
            F.count("*").alias("row_count"),
            F.max("source_file_modified_at").alias("file_modified_at"),
        )
        .orderBy("source_file_name", "source_file_path")
    )


def grouped_sum(
    df: DataFrame, key: str, value: str, alias: str, *, exact: tuple[int, int] | None = None
) -> DataFrame:
    """Sum of ``value`` per ``key``.

    Values are summed as they are. With ``exact`` = (precision, scale) they are
    summed as decimals of that type, so that the order of rows cannot change the
    last digits; a value that does not fit it raises, and digits beyond the scale
    are rounded.
    """
    if exact is None:
        return df.groupBy(key).agg(F.sum(value).alias(alias))
    return df.groupBy(key).agg(F.sum(F.col(value).cast(f"decimal({exact[0]},{exact[1]})")).alias(alias))
