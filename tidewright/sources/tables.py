"""Catalog table writes: create, evolve, append, keyed upsert.

Tables whose provider has row-level operations are merged in place. Plain file
tables are rewritten:

* unpartitioned: the new version goes to a new folder and one ALTER TABLE ..
  SET LOCATION publishes it, so readers see the old or the new version. The
  old folder is left for readers still on it and is returned for removal.
* partitioned: only partitions the upsert touches are rewritten.
* laid out by key (``key_buckets``): only the buckets of the source's keys are.

A table must have one writer at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewright.operators import merge
from tidewright.operators.ddl import create_table_text
from tidewright.operators.dedup import dedup_keys, dedup_latest
from tidewright.operators.observed import Counts
from tidewright.operators.quality import refuse
from tidewright.operators.tasks import in_small_tasks
from tidewright.settings import quoted, scratch_folder, sql_text
from tidewright.sources.key_buckets import (
    KEY_BUCKET,
    UNKEYED,
    Layout,
    bucketed_schema,
    known_key,
    layout_of,
    with_bucket,
)

if TYPE_CHECKING:
    from tidewright.operators.definition import TableDefinition

# Providers whose tables take MERGE.
ROW_LEVEL_PROVIDERS = ("delta", "iceberg", "hudi", "paimon")
# Partitions dropped by one statement.
_DROPPED_AT_ONCE = 500


class TableCreationError(Exception):
    """The catalog refused a new table; the cause says why."""


@dataclass(frozen=True)
class UpsertResult:
    source_rows: int
    replaced_location: str | None = None


def create_table_if_not_exists(
    table_name: str,
    schema: StructType,
    *,
    partition_by: Sequence[str] = (),
    table_format: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> bool:
    """Create an empty table; True if created, False if it was there."""
    spark = SparkSession.active()
    if spark.catalog.tableExists(table_name):
        return False
    table_format = table_format or spark.conf.get("spark.sql.sources.default")
    text = create_table_text(
        table_name, schema, table_format, partition_by=partition_by, properties=properties
    )
    try:
        spark.sql(text)
    except Exception as e:
        raise TableCreationError(f"No table {table_name} with columns {schema.simpleString()}: {e}") from e
    return True


def add_missing_columns_to_table(table_name: str, source_schema: StructType) -> list[str]:
    """Add source-only columns: business columns first, audit columns last.

    A metadata change only; older rows read NULL. Does nothing for a table that
    does not exist yet. Returns the names added; a failure is raised.
    """
    spark = SparkSession.active()
    if not spark.catalog.tableExists(table_name):
        return []
    fields = merge.missing_fields(spark.table(table_name).schema, source_schema)
    if fields:
        specs = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"ALTER TABLE {table_name} ADD COLUMNS ({specs})")
    return [f.name for f in fields]


def append_rows(df: DataFrame, table_name: str, *, schema_evolution: bool = False) -> None:
    """Append by column name; without evolution unknown columns are refused."""
    if schema_evolution:
        add_missing_columns_to_table(table_name, df.schema)
    schema, partitions = df.sparkSession.table(table_name).schema, table_details(table_name).partition_columns
    layout = layout_of(table_name) if partitions == [KEY_BUCKET] else None
    if layout is not None:
        df = with_bucket(df, schema, layout)
    _gathered(merge.aligned(df, schema), partitions).write.insertInto(table_name)


def _gathered(rows: DataFrame, partitions: Sequence[str], parts: int = 1) -> DataFrame:
    """Rows of one table partition brought together, so that not every task
    writes a file into every partition; AQE splits a large partition again, though not
    what one task has sent: ``parts`` deals that out too."""
    if not partitions:
        return rows
    if parts == 1:
        return rows.hint("rebalance", *partitions)
    # Spark hashes no maps.
    plain = [F.col(quoted(f.name)) for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    dealt = rows.withColumn("__part", F.pmod(F.xxhash64(*plain), F.lit(parts)))
    return dealt.hint("rebalance", *partitions, "__part").drop("__part")


# Partition column of tables that are appended to by named, repeatable writes.
APPEND_ID = "append_id"


def append_once(
    df: DataFrame, table_name: str, writer: str, sequence: int, *, schema_evolution: bool = False
) -> None:
    """Append the rows as write number ``sequence`` of ``writer``: repeated under the same
    name, as after a lost driver, the write replaces its own rows and no others.

    The table is created with the partition column ``append_id``, which names each row's
    write; one that exists must have it.
    """
    schema = StructType([*df.schema.fields, StructField(APPEND_ID, StringType())])
    if not create_table_if_not_exists(table_name, schema, partition_by=[APPEND_ID]):
        if table_details(table_name).partition_columns != [APPEND_ID]:
            raise ValueError(f"{table_name} must be partitioned by {APPEND_ID}.")
        if schema_evolution:
            add_missing_columns_to_table(table_name, df.schema)
    overwrite_partition(df, table_name, APPEND_ID, f"{writer}-{sequence:012d}")
    df.sparkSession.catalog.refreshTable(table_name)


def overwrite_partition(df: DataFrame, table_name: str, column: str, value: str) -> None:
    """Replace one partition by the frame; other partitions are not touched.

    The partition is named in the statement, so the rows need no sort by it.
    """
    spark = df.sparkSession
    fields = [f for f in spark.table(table_name).schema.fields if f.name != column]
    listed = ", ".join(quoted(f.name) for f in fields)
    spark.sql(
        f"INSERT OVERWRITE TABLE {table_name} PARTITION ({quoted(column)} = {sql_text(value)}) "
        f"SELECT {listed} FROM {{rows}}",
        rows=merge.aligned(df, StructType(fields)),
    )


@in_small_tasks
def insert_or_update_table(
    df: DataFrame,
    table_name: str,
    *,
    key_columns: Sequence[str] | None = None,
    force_remove_duplicates: bool = False,
    schema_evolution: bool = False,
    append_only: bool = False,
    partition_by: Sequence[str] = (),
    order_by: Sequence[Column] = (),
    gate: TableDefinition | None = None,
    key_buckets: int | None = None,
    newest_by: Sequence[str] = (),
) -> UpsertResult | None:
    """Append to, or upsert by key into, a table that is created when absent.

    Several source rows of one key are refused, unless
    ``force_remove_duplicates`` keeps one of them: the first by ``order_by``, or
    an arbitrary one. With a ``gate`` nothing is written when the rows lack or
    mistype a column of the definition or violate its constraints: violations are
    counted while the rows are staged, and the staged rows are what is written. ``key_buckets`` lays a new table out by that
    many buckets of its key. With ``newest_by`` a row does not replace one that is
    greater by these columns, so that rows may arrive late.
    """
    if not key_columns and (force_remove_duplicates or key_buckets or not append_only):
        raise ValueError("key_columns are required, except for a plain append.")
    if key_buckets and partition_by:
        raise ValueError("A table laid out by key buckets has no other partitions.")
    if force_remove_duplicates:
        df = dedup_latest(df, key_columns, order_by) if order_by else dedup_keys(df, key_columns)

    def create() -> None:
        if key_buckets:
            create_key_buckets(table_name, df.schema, key_columns, key_buckets)
        else:
            create_table_if_not_exists(table_name, df.schema, partition_by=partition_by)

    if gate is not None:
        gate.reject_schema(df)
    if append_only and gate is None:
        create()
        append_rows(df, table_name, schema_evolution=schema_evolution)
        return None
    keys = list(key_columns or ())
    merge.require_columns(df, keys)
    # The rows are read several times below. Evaluating them once fixes the arbitrary
    # choices of a de-duplication and what the gate has seen, and their file sizes
    # tell Spark whether it may broadcast them.
    with scratch_folder(df.sparkSession, "upsert-source") as folder:
        source, count, unkeyed = _staged(df, folder, keys, gate)
        create()
        if append_only:
            append_rows(source, table_name, schema_evolution=schema_evolution)
            return None
        if not force_remove_duplicates:
            _refuse_repeated(source, keys)
        if schema_evolution:
            add_missing_columns_to_table(table_name, source.schema)
        replaced = _apply(source, table_name, keys, schema_evolution, unkeyed, newest_by) if count else None
        return UpsertResult(count, replaced)


def create_key_buckets(table_name: str, schema: StructType, keys: Sequence[str], buckets: int) -> None:
    """Create a table laid out by its key; one that is there must have this layout."""
    layout = Layout(tuple(keys), buckets)
    created = create_table_if_not_exists(
        table_name, bucketed_schema(schema), partition_by=[KEY_BUCKET], properties=layout.properties()
    )
    if not created:
        existing = layout_of(table_name)
        if existing is None:
            raise ValueError(f"{table_name} exists without key buckets.")
        existing.require(layout.keys, layout.buckets)


def _staged(
    df: DataFrame, folder: str, keys: Sequence[str], gate: TableDefinition | None
) -> tuple[DataFrame, int, int]:
    """(the rows written to the folder, how many, how many with a NULL in their key),
    refused where the gate counts violations among them."""
    seen = Counts()
    broken = gate.broken_constraints(df) if gate is not None else {}
    unkeyed = F.count_if(~known_key(keys)) if keys else F.lit(0)
    counters = [F.count_if(rule).alias(f"broken_{i}") for i, rule in enumerate(broken.values())]
    seen.of(df, F.count(F.lit(1)).alias("rows"), unkeyed.alias("unkeyed"), *counters).write.parquet(folder)
    refuse({name: seen[f"broken_{i}"] for i, name in enumerate(broken)})
    return df.sparkSession.read.schema(df.schema).parquet(folder), seen["rows"] or 0, seen["unkeyed"] or 0


@dataclass(frozen=True)
class TableDetails:
    provider: str
    location: str
    partition_columns: list[str]


def table_details(table_name: str) -> TableDetails:
    """What the catalog says, read with one DESCRIBE."""
    described = SparkSession.active().sql(f"DESCRIBE TABLE EXTENDED {table_name}").collect()
    facts: dict[str, str] = {}
    columns: list[str] = []
    section = ""
    for row in described:
        name = row["col_name"]
        if name.startswith("# ") and name != "# col_name":
            section = name
        elif section == "# Detailed Table Information":
            facts[name] = row["data_type"]
        elif section == "# Partition Information" and name and name != "# col_name":
            columns.append(name)
    return TableDetails(facts.get("Provider", "").lower(), facts.get("Location", ""), columns)


def _apply(
    source: DataFrame, table_name: str, keys: list[str], evolve: bool, unkeyed: int, newest_by: Sequence[str]
) -> str | None:
    """Upsert a staged source; the folder the table no longer uses, if any."""
    target, details = source.sparkSession.table(table_name), table_details(table_name)
    if details.provider in ROW_LEVEL_PROVIDERS:
        _merge_into(source, table_name, target, keys, evolve, newest_by)
        return None
    layout = layout_of(table_name) if details.partition_columns == [KEY_BUCKET] else None
    if layout is not None:
        layout.require(keys)
        _rewrite_buckets(target, source, table_name, layout, unkeyed, newest_by)
        return None
    if details.partition_columns:
        _rewrite_partitions(target, source, table_name, keys, details.partition_columns, newest_by)
        return None
    if target.isEmpty():
        append_rows(source, table_name)
        return None
    return _publish(merge.merged(target, source, keys, newest_by), table_name, details)


def rewrite_by_key(
    source: DataFrame,
    table_name: str,
    keys: Sequence[str],
    after: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame],
) -> str | None:
    """Replace the table's rows by ``after(rows, source, keys)``, which may change and add
    rows of the source's keys only and leaves none of them out. ``source`` is staged and
    its keys are not NULL. With key buckets only those of its keys are rewritten; returns
    the folder that the table no longer uses otherwise."""
    target, details = source.sparkSession.table(table_name), table_details(table_name)
    layout = layout_of(table_name) if details.partition_columns == [KEY_BUCKET] else None
    if layout is not None:
        layout.require(keys)
        arriving = with_bucket(source, target.schema, layout)
        # At most as many numbers as the table has buckets.
        touched = sorted(r[0] for r in arriving.select(KEY_BUCKET).distinct().collect())
        current = target.where(F.col(KEY_BUCKET).isin(touched))
        _overwrite_partitions(after(current, arriving, layout.keys), table_name, [KEY_BUCKET])
        return None
    if details.partition_columns:
        raise ValueError(f"{table_name} is partitioned, but not by its key.")
    return _publish(after(target, source, keys), table_name, details)


def _rewrite_buckets(
    target: DataFrame, source: DataFrame, table_name: str, layout: Layout, unkeyed: int, newest_by: Sequence[str]
) -> None:
    """Upsert into the buckets of the source's keys. Rows without a key are appended,
    after the others: an upsert that is repeated after a failure adds them once."""
    arriving = with_bucket(source, target.schema, layout)
    keyed = arriving.where(F.col(KEY_BUCKET) != UNKEYED)
    # At most as many numbers as the table has buckets.
    touched = sorted(r[0] for r in keyed.select(KEY_BUCKET).distinct().collect())
    if touched:
        current = target.where(F.col(KEY_BUCKET).isin(touched))
        after = merge.merged(current, keyed, layout.keys, newest_by)
        _overwrite_partitions(after, table_name, [KEY_BUCKET])
    if unkeyed:
        rows = merge.aligned(arriving.where(F.col(KEY_BUCKET) == UNKEYED), target.schema)
        _gathered(rows, [KEY_BUCKET]).write.insertInto(table_name)


def _refuse_repeated(source: DataFrame, keys: Sequence[str]) -> None:
    example = merge.repeated_keys(source, keys).limit(1).collect()
    if example:
        raise ValueError(f"Several source rows for one key, for example {example[0].asDict()}.")


def _merge_into(
    source: DataFrame,
    table_name: str,
    target: DataFrame,
    keys: Sequence[str],
    evolve: bool,
    newest_by: Sequence[str],
) -> None:
    """MERGE in the table's own provider; not exercised by the tests here, as
    no such provider is installed."""
    incoming = merge.aligned(source, target.schema, fill_missing=False).alias("source")
    same = [F.col(f"{table_name}.{quoted(k)}") == F.col(f"source.{quoted(k)}") for k in keys]
    fixed = {k.lower() for k in keys} | set(merge.KEPT_ON_UPDATE)
    values = {c: F.col(f"source.{quoted(c)}") for c in incoming.columns}
    changes = {c: v for c, v in values.items() if c.lower() not in fixed}
    writer = incoming.mergeInto(table_name, reduce(and_, same))
    if changes and newest_by:
        sides = [
            F.struct(*[F.col(f"{side}.{quoted(c)}").alias(f"o{i}") for i, c in enumerate(newest_by)])
            for side in ("source", table_name)
        ]
        writer = writer.whenMatched(sides[0] >= sides[1]).update(changes)
    elif changes:
        writer = writer.whenMatched().update(changes)
    writer = writer.whenNotMatched().insert(values)
    (writer.withSchemaEvolution() if evolve else writer).merge()


def _publish(df: DataFrame, table_name: str, details: TableDetails) -> str:
    """Write the table's next version beside the current one and switch to it.

    The version is written through a table made like this one, so that it has
    the same storage options (a csv separator, a compression codec).
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    base = re.sub(r"__v-[0-9a-f]{32}$", "", details.location.rstrip("/"))
    folder, like = f"{base}__v-{version}", f"{_database_of(table_name)}next_version_{version}"
    spark.sql(f"CREATE TABLE {like} LIKE {table_name} LOCATION {sql_text(folder)}")
    try:
        df.write.insertInto(like)
    finally:
        # An external table: its files stay.
        spark.sql(f"DROP TABLE {like}")
    spark.sql(f"ALTER TABLE {table_name} SET LOCATION {sql_text(folder)}")
    spark.catalog.refreshTable(table_name)
    return details.location


def _database_of(table_name: str) -> str:
    """What stands before the last part of a table's name, with its dot."""
    return re.match(r"((?:(?:`(?:[^`]|``)*`|[^.`]+)\.)*)", table_name)[1]


def _rewrite_partitions(
    target: DataFrame,
    source: DataFrame,
    table_name: str,
    keys: Sequence[str],
    partitions: Sequence[str],
    newest_by: Sequence[str],
) -> None:
    """Upsert into the touched partitions only: those the source names, and
    those that hold a matched key now, which may move."""
    have = {c.lower() for c in source.columns}
    given = [p for p in partitions if p.lower() in have]
    arriving = merge.aligned(source.select(*given), target.select(*partitions).schema)
    touched = arriving
    if not set(partitions) <= set(keys):
        touched = arriving.unionByName(merge.matched_rows(target, source, keys).select(*partitions))
    # One row per touched partition, as many as the catalog tracks.
    values = touched.distinct().collect()
    after = merge.merged(target.where(_in_partitions(values)), source, keys, newest_by)
    replace_partitions(after, table_name, values)


def replace_partitions(after: DataFrame, table_name: str, values: Sequence[Row], parts: int = 1) -> None:
    """Replace the partitions named by ``values`` by the rows, of which none may belong to
    another; a partition that gets no row is dropped. Where partitions are large, ``parts``
    deals the rows of each to that many shuffle partitions."""
    spark, partitions = after.sparkSession, list(values[0].__fields__)
    # A dynamic overwrite leaves a partition alone when no row is left for it, so
    # the write itself notes which partitions it had rows for.
    filled = Counts()
    named = F.struct(*[F.col(quoted(p)) for p in partitions])
    after = filled.of(after, F.collect_set(named).alias("partitions"))
    _overwrite_partitions(after, table_name, partitions, parts)
    emptied = set(values) - {tuple(r) for r in filled["partitions"] or ()}
    specs = [
        "PARTITION (" + ", ".join(f"{quoted(c)} = {_partition_literal(row[c])}" for c in partitions) + ")"
        for row in emptied
    ]
    for first in range(0, len(specs), _DROPPED_AT_ONCE):
        listed = ", ".join(specs[first : first + _DROPPED_AT_ONCE])
        spark.sql(f"ALTER TABLE {table_name} DROP IF EXISTS {listed}")


def _overwrite_partitions(
    rows: DataFrame, table_name: str, partitions: Sequence[str], parts: int = 1
) -> None:
    """Replace just the partitions the rows belong to, which may be derived from
    them: a dynamic overwrite swaps partitions only after all rows are written.
    """
    conf, setting = rows.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    mode = conf.get(setting)
    conf.set(setting, "dynamic")
    try:
        _gathered(rows, partitions, parts).write.insertInto(table_name, overwrite=True)
    finally:
        conf.set(setting, mode)


def _in_partitions(values: Sequence[Row]) -> Column:
    """A predicate on partition columns alone, so that the scan is pruned: the
    values of the last column as a list for each of the columns before it."""
    return _in_tuples(values[0].__fields__, [tuple(r) for r in values])


def _in_tuples(names: Sequence[str], tuples: Sequence[tuple]) -> Column:
    column = F.col(quoted(names[0]))
    if len(names) == 1:
        listed = sorted({t[0] for t in tuples if t[0] is not None})
        tests = [column.isin(listed)] if listed else []
        return _any_of(tests + [column.isNull()] * any(t[0] is None for t in tuples))
    below: dict = {}
    for t in tuples:
        below.setdefault(t[0], []).append(t[1:])
    return _any_of([column.eqNullSafe(F.lit(v)) & _in_tuples(names[1:], rest) for v, rest in below.items()])


def _any_of(tests: Sequence[Column]) -> Column:
    """A balanced OR: its depth grows with the logarithm of the tests."""
    if len(tests) == 1:
        return tests[0]
    half = len(tests) // 2
    return _any_of(tests[:half]) | _any_of(tests[half:])


def _partition_literal(value) -> str:
    return "NULL" if value is None else sql_text(str(value))
