"""Zone-less timestamps: detection, shift to UTC, cast to zoned timestamps.

``convert_timezone`` maps TIMESTAMP_NTZ to TIMESTAMP_NTZ and, unlike
``to_utc_timestamp``, does not pass through the session's zone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from tidewright.settings import quoted


def get_timestamp_columns(
    df: DataFrame, include_ntz: bool = True, include_tz: bool = False
) -> list[str]:
    """Names of the timestamp columns, from the schema alone."""
    kinds = (TimestampNTZType,) * include_ntz + (TimestampType,) * include_tz
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def utc(value: Column, source_timezone: str) -> Column:
    """A zone-less time of ``source_timezone`` as a zone-less UTC time."""
    return F.convert_timezone(F.lit(source_timezone), F.lit("UTC"), value)


def utc_instant(value: Column) -> Column:
    """A zone-less UTC time as TIMESTAMP, whatever the session's zone is."""
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, value))


def apply_timezone_conversion(
    df: DataFrame,
    *,
    source_timezone: str | None = None,
    select_columns: str | Sequence[str] | None = None,
    convert_to_utc: bool = True,
    also: Sequence[str] = (),
) -> DataFrame:
    """Shift the chosen zone-less columns to UTC and pass the other chosen ones.

    A shifted column is named ``{column}_utc``, or keeps its name when
    ``convert_to_utc`` is false. ``also`` columns pass without conversion.
    """
    if not source_timezone:
        raise ValueError("source_timezone is required to convert to UTC.")
    chosen = _names(select_columns) or [c for c in df.columns if c not in also]
    zoneless = {c.lower() for c in get_timestamp_columns(df)}
    columns = [F.col(quoted(c)) for c in chosen]
    for i, name in enumerate(chosen):
        if name.lower() in zoneless:
            shifted = f"{name}_utc" if convert_to_utc else name
            columns[i] = utc(columns[i], source_timezone).alias(shifted)
    return df.select(*columns, *[F.col(quoted(c)) for c in also])


def cast_timestamps(
    df: DataFrame, columns: str | Sequence[str], timestamp_columns: Sequence[str]
) -> DataFrame:
    """Select ``columns``, casting those in ``timestamp_columns`` to TIMESTAMP
    in the session's zone, under their own names and without a shift."""
    wanted = {c.lower() for c in timestamp_columns}
    return df.select(
        *[
            F.col(quoted(c)).cast("timestamp").alias(c) if c.lower() in wanted else F.col(quoted(c))
            for c in _names(columns) or df.columns
        ]
    )


def _names(columns: str | Sequence[str] | None) -> list[str]:
    if columns is None or columns == "*":
        return []
    parts = columns.split(",") if isinstance(columns, str) else columns
    return [c.strip() for c in parts]
