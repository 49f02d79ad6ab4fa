"""Bring a catalog table to its definition: columns, types, comments, version.

New columns and comments are changes of the catalog alone. File tables cannot change a
column's type, so a type that only becomes wider takes a staged rewrite: the rows go into
a new table with the definition's types and version stamp, which then takes the old one's
name. A run that is lost on the way is repeated: before the names change the table is as
it was, and the new table is made anew; between the two changes of names the next run
makes the second one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StructField, StructType

from tidewright.operators.ddl import create_table_text
from tidewright.operators.definition import TableDefinition
from tidewright.operators.merge import aligned, missing_fields
from tidewright.settings import quoted, sql_text
from tidewright.sources.key_buckets import KEY_BUCKET, layout_of, with_bucket
from tidewright.sources.tables import add_missing_columns_to_table, table_details

# Types by name, each of which holds every value of those before it in its row.
_WIDER = (
    ("tinyint", "smallint", "int", "bigint"),
    ("float", "double"),
    ("tinyint", "smallint", "int", "double"),
    ("date", "timestamp_ntz"),
)
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


@dataclass
class Migration:
    """What was changed. ``replaced_table`` holds the rows as they were, for removal."""

    added: list[str] = field(default_factory=list)
    widened: list[str] = field(default_factory=list)
    commented: list[str] = field(default_factory=list)
    replaced_table: str | None = None


def widens(old: DataType, new: DataType) -> bool:
    """Whether every value of the old type is one of the new type."""
    if isinstance(new, DecimalType):
        if isinstance(old, DecimalType):
            return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
        return new.precision - new.scale >= _DIGITS.get(old.simpleString(), 99)
    names = (old.simpleString(), new.simpleString())
    return any(
        all(n in row for n in names) and row.index(names[0]) < row.index(names[1]) for row in _WIDER
    )


def migrate_table(definition: TableDefinition) -> Migration:
    """Bring the definition's table, created if absent, to its columns, types, comments and
    version. A column the definition lacks stays as it is; a type that does not become
    wider, and a version below the table's, are refused before anything is changed."""
    spark, name = SparkSession.active(), definition.table_name
    staged = f"{name}__migrated"
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(staged):
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")  # a run was lost between the names
    done, wanted = Migration(), definition.to_schema()
    if not spark.catalog.tableExists(name):
        definition.ensure_version_sync()
        done.added = [f.name for f in wanted.fields]
        return done
    definition.refuse_downgrade()
    current = spark.table(name).schema
    have = {f.name.lower(): f for f in current.fields}
    changed = [f for f in wanted.fields if f.name.lower() in have and have[f.name.lower()].dataType != f.dataType]
    narrower = [f.name for f in changed if not widens(have[f.name.lower()].dataType, f.dataType)]
    if narrower:
        raise ValueError(f"{name}: the types of {narrower} do not become wider.")
    if changed:
        done.added = [f.name for f in missing_fields(current, wanted)]
        done.widened = [f.name for f in changed]
        done.replaced_table = _rewritten(spark, definition, staged, current)
    else:
        done.added = add_missing_columns_to_table(name, wanted)
        definition.ensure_version_sync()
    done.commented = _commented(spark, name, wanted)
    return done


def _rewritten(spark: SparkSession, definition: TableDefinition, staged: str, current: StructType) -> str:
    """The rows under the new types in a table of the same layout, which takes the name."""
    name = definition.table_name
    wanted, details, layout = definition.to_schema(), table_details(name), layout_of(name)
    types = {f.name.lower(): f for f in wanted.fields}
    partitions = [p.lower() for p in details.partition_columns]
    fields = [types.get(f.name.lower(), f) for f in current.fields if f.name.lower() not in partitions]
    fields += missing_fields(current, wanted)
    fields += [types.get(f.name.lower(), f) for f in current.fields if f.name.lower() in partitions]
    # Rows of the old version have no value for a new column.
    schema = StructType([StructField(f.name, f.dataType, True, f.metadata) for f in fields])
    kept = spark.sql(f"SHOW TBLPROPERTIES {name}").where(~F.col("key").startswith("transient_")).collect()
    properties = {r["key"]: r["value"] for r in kept if r["key"] != "schema_version"}
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    spark.sql(
        create_table_text(
            staged, schema, details.provider, partition_by=details.partition_columns,
            version=definition.version, properties=properties,
        )
    )
    rows: DataFrame = spark.table(name)
    if layout is not None:
        # Keys of another type have other hashes.
        rows = with_bucket(rows, schema, layout)
    rows = aligned(rows, spark.table(staged).schema)
    if details.partition_columns:
        rows = rows.hint("rebalance", *details.partition_columns)
    rows.write.insertInto(staged, overwrite=True)
    before = f"{name}__before_{definition.version.replace('.', '_')}"
    spark.sql(f"DROP TABLE IF EXISTS {before}")
    spark.sql(f"ALTER TABLE {name} RENAME TO {before}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    spark.catalog.refreshTable(name)
    return before


def _commented(spark: SparkSession, name: str, wanted: StructType) -> list[str]:
    """Give the columns the definition's comments where they differ."""
    comments = {f.name.lower(): f.metadata.get("comment") for f in spark.table(name).schema.fields}
    changed = []
    for f in wanted.fields:
        comment = f.metadata.get("comment")
        if comment and f.name.lower() != KEY_BUCKET and comments.get(f.name.lower()) != comment:
            spark.sql(f"ALTER TABLE {name} ALTER COLUMN {quoted(f.name)} COMMENT {sql_text(comment)}")
            changed.append(f.name)
    return changed
