"""Rescue column: rows that do not fit a schema are loaded, and what did not fit is kept.

Values that do not convert to the defined type, and columns that are not defined, go as
text, by their names, into one map column. It is NULL where a row fits. A column the rows
lack is NULL. Nothing is shuffled, and no value is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewright.settings import quoted

RESCUED = "rescued"
_TYPE = "array<struct<name:string,value:string>>"


def rescued(
    rows: DataFrame, schema: StructType, *, also: Sequence[str] = (), column: str = RESCUED
) -> DataFrame:
    """The rows under the schema's names, types and order, then the columns ``also`` as
    they are, then the rescue column."""
    have = {f.name.lower(): f for f in rows.schema.fields}
    kept = {c.lower() for c in also}
    if column.lower() in kept | {f.name.lower() for f in schema.fields}:
        raise ValueError(f"The column name {column} is taken by the rescue column.")
    values, misfits = [], []
    for field in schema.fields:
        found = have.get(field.name.lower())
        if found is None:
            values.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif found.dataType == field.dataType:
            values.append(F.col(quoted(found.name)).alias(field.name))
        else:
            value = F.col(quoted(found.name))
            converted = _converted(rows, value, field.dataType)
            values.append(converted.alias(field.name))
            misfits.append(_entry(field.name, value, value.isNotNull() & converted.isNull()))
    defined = {f.name.lower() for f in schema.fields} | kept
    for key, found in have.items():
        if key not in defined:
            value = F.col(quoted(found.name))
            misfits.append(_entry(found.name, value, value.isNotNull()))
    # Constant arrays and concat stay in generated code, a filter of an array does not.
    entries = F.concat(*misfits) if misfits else F.array().cast(_TYPE)
    kept_columns = [F.col(quoted(have[c.lower()].name)) for c in also]
    named = F.when(F.size(entries) > 0, F.map_from_entries(entries)).cast("map<string,string>")
    return rows.select(*values, *kept_columns, named.alias(column))


def _converted(rows: DataFrame, value: Column, wanted) -> Column:
    attempt = value.try_cast(wanted)
    try:
        rows.select(attempt).schema
    except AnalysisException:
        # Spark knows no conversion between the two types: every value is rescued.
        return F.lit(None).cast(wanted)
    return attempt


def _entry(name: str, value: Column, misfit: Column) -> Column:
    entry = F.array(F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))).cast(_TYPE)
    return F.when(misfit, entry).otherwise(F.array().cast(_TYPE))


def misfit(schema: StructType, column: str = RESCUED) -> Column:
    """True where a value of a defined column was rescued; columns that are not defined
    do not count."""
    names = F.array(*[F.lit(f.name) for f in schema.fields])
    return F.coalesce(F.arrays_overlap(F.map_keys(column), names), F.lit(False))


def rescue_summary(rows: DataFrame, column: str = RESCUED) -> DataFrame:
    """(column_name, rescued_values); counted in each task before the shuffle."""
    names = rows.select(F.explode(F.map_keys(column)).alias("column_name"))
    return names.groupBy("column_name").agg(F.count(F.lit(1)).alias("rescued_values"))
