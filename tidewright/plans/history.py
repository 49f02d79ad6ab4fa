"""Upsert into a table that keeps the history of its rows."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewright.operators.definition import TableDefinition
from tidewright.operators.history import VALID_FROM, history
from tidewright.operators.merge import aligned, require_columns
from tidewright.operators.observed import Counts
from tidewright.settings import quoted, scratch_folder
from tidewright.sources.key_buckets import known_key
from tidewright.sources.tables import (
    add_missing_columns_to_table,
    create_key_buckets,
    create_table_if_not_exists,
    rewrite_by_key,
)


def upsert_history(
    changes: DataFrame,
    definition: TableDefinition,
    *,
    as_of: str,
    key_buckets: int | None = None,
    repeats: bool = False,
) -> int:
    """Bring the changes into the definition's table, which has ``valid_from`` and
    ``valid_to``; returns how many changes there were. ``as_of`` names the changes' column
    with the time from which they hold.

    The same changes again, or changes that say nothing new, leave the table's rows as they
    are; ``repeats`` keeps these, too (see ``operators.history``). With ``key_buckets`` only the buckets of the changes' keys are rewritten. Rows with
    a NULL in their key or time have no place in a history and are refused.
    """
    if not definition.include_valid_from_valid_to or not definition.key_columns:
        raise ValueError("A history needs key columns and valid_from/valid_to in its definition.")
    keys, schema = list(definition.key_columns), definition.to_schema()
    require_columns(changes, [*keys, as_of])
    # The time and the values, under the definition's types.
    changes = changes.withColumn(VALID_FROM, F.col(quoted(as_of)))
    if as_of.lower() not in {f.name.lower() for f in schema.fields}:
        changes = changes.drop(as_of)
    nullable = StructType([f for f in schema.fields if f.name.lower() in {c.lower() for c in changes.columns}])
    changes = aligned(changes, nullable)
    with scratch_folder(changes.sparkSession, "history") as folder:
        seen, known = Counts(), known_key([*keys, VALID_FROM])
        seen.of(changes, F.count(F.lit(1)).alias("rows"), F.count_if(~known).alias("unknown")).write.parquet(folder)
        if seen["unknown"]:
            raise ValueError(f"{seen['unknown']} changes have a NULL in their key or time.")
        staged = changes.sparkSession.read.schema(changes.schema).parquet(folder)
        if key_buckets:
            create_key_buckets(definition.table_name, schema, keys, key_buckets)
        else:
            create_table_if_not_exists(definition.table_name, schema)
        add_missing_columns_to_table(definition.table_name, schema)
        if seen["rows"]:
            rewrite_by_key(staged, definition.table_name, keys, partial(history, repeats=repeats))
        return seen["rows"] or 0
