"""One query per operator; each runs over whole tables of ``sf_dir``.

Queries that write keep their tables in a database of their own inside the
shared folder, so that they can be repeated and run side by side.
"""

from __future__ import annotations

import re
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.geometry import centroid, ring
from tidewright.functions.timezones import apply_timezone_conversion, cast_timestamps
from tidewright.operators import projections
from tidewright.operators.aggregates import file_load_stats, grouped_sum
from tidewright.operators.dedup import dedup_keys, dedup_latest
from tidewright.operators.definition import ColumnDefinition, TableDefinition
from tidewright.operators.joins import join_lookup, rows_of_active_sources
from tidewright.operators.merge import merged
from tidewright.operators.tasks import ROW_GROUP, TASK_BYTES
from tidewright.plans.datasets import materialize
from tidewright.plans.history import upsert_history
from tidewright.plans.migrate import migrate_table
from tidewright.plans.refine import refine
from tidewright.plans.zones import load_zones
from tidewright.plans.staging import (
    populate_stg_tables_from_sql,
    populate_stg_tables_from_storage,
    staged_rows,
)
from tidewright.settings import fresh_folder, sql_text
from tidewright.sources.files import scan, scan_stream
from tidewright.sources.load_log import log_load
from tidewright.sources.manifest import load_by_manifest
from tidewright.sources.rescue import rescue_summary
from tidewright.sources.registry import insert_or_update_process_table
from tidewright.sources.tables import append_once, insert_or_update_table
from tidewright.streaming.file_loader import load_new_files
from tidewright.streaming.keyed_upsert import apply_batch, upsert_stream

NEW_YORK = "America/New_York"

# Rows of a file that is written to be read in one piece.
FILE_ROWS = 100_000

# Rules used by the validation queries.
LINEITEM = TableDefinition(
    table_name="lineitem_rules",
    columns=[
        ColumnDefinition("l_orderkey", "bigint"),
        ColumnDefinition("l_quantity", "double", False, min_value=5),
        ColumnDefinition("l_discount", "double", False, custom_condition="l_discount > 0"),
        ColumnDefinition("l_tax", "double", False, max_value=0.06),
    ],
    include_is_active=False,
    include_create_and_update=False,
)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan(spark, f"{sf_dir}/{name}.parquet")


def _database(spark: SparkSession) -> str:
    name = f"q_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION {sql_text(fresh_folder(spark, name))}")
    return name


def _at(text: str) -> Column:
    """A constant zone-less time, for audit values an oracle can state."""
    return F.to_timestamp_ntz(F.lit(text))


# Scans and sources


def scan_parquet_select(spark, sf_dir):
    return projections.select_text(
        _read(spark, sf_dir, "lineitem").where("l_quantity > 10 AND l_returnflag = 'R'"),
        "l_orderkey, l_linenumber, l_quantity, cast(l_quantity * 2 AS decimal(10, 2)) AS twice",
    ).withColumn("twice", F.col("twice").cast("double"))


def filter_clauses(spark, sf_dir):
    rows = projections.where_clauses(
        _read(spark, sf_dir, "lineitem"), "l_quantity > 10; l_returnflag = 'R'", None
    )
    return rows.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


def scan_table(spark, sf_dir):
    name = f"{_database(spark)}.orders"
    location = sql_text(f"{sf_dir}/orders.parquet")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION {location}")
    return spark.table(name)


def scan_formats(spark, sf_dir):
    """Customers through every format that needs no extra package. Files of some formats
    are read by one task each, so their rows are bounded."""
    customers = _read(spark, sf_dir, "customer")
    folder, tagged = fresh_folder(spark, "formats"), []
    for name in ("parquet", "orc", "json", "csv", "xml"):
        options = {"rowTag": "customer"} if name == "xml" else {}
        customers.write.format(name).option("maxRecordsPerFile", FILE_ROWS).options(**options).save(f"{folder}/{name}")
        schema = None if name in ("parquet", "orc") else customers.schema
        rows = scan(spark, f"{folder}/{name}", name.upper(), schema=schema, options=options)
        tagged.append(rows.select(F.lit(name).alias("file_format"), *customers.columns))
    lines = customers.select(F.to_json(F.struct("*")).alias("value"))
    lines.write.option("maxRecordsPerFile", FILE_ROWS).text(f"{folder}/text")
    parsed = scan(spark, f"{folder}/text", "text").select(
        F.lit("text").alias("file_format"), F.from_json("value", customers.schema).alias("c")
    )
    tagged.append(parsed.select("file_format", "c.*"))
    result = tagged[0]
    for rows in tagged[1:]:
        result = result.unionByName(rows)
    return result


def scan_csv_options(spark, sf_dir):
    """Customers through a csv with header and delimiter, read back as text."""
    folder = fresh_folder(spark, "csv")
    customers = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    customers.write.csv(folder, header=True, sep="|")
    return scan(spark, folder, "csv", csv_header=True, csv_delimiter="|")


def registry_active_sources(spark, sf_dir):
    registry = spark.createDataFrame(
        [("click", True), ("view", True), ("error", False)], "event_type string, is_active boolean"
    )
    return rows_of_active_sources(_read(spark, sf_dir, "events"), registry, ["event_type"]).select(
        "event_id", "event_type", "value"
    )


def load_new_files_once(spark, sf_dir):
    """Orders land in two steps; four runs must load each file once."""
    orders, db = _read(spark, sf_dir, "orders"), _database(spark)
    landing, checkpoint = fresh_folder(spark, "landing"), fresh_folder(spark, "loaded")

    def run():
        stream = staged_rows(scan_stream(spark, landing, orders.schema), "*")
        load_new_files(stream, f"{db}.orders", checkpoint)

    pending = F.col("o_orderstatus") == "P"
    orders.where(~pending).write.parquet(landing)
    run()
    run()
    orders.where(pending).write.mode("append").parquet(landing)
    run()
    run()
    return spark.table(f"{db}.orders").select(*orders.columns)


def _put(spark, rows, path):
    """Write the rows as one file of a stated name, in place of one that is there. Its one
    task gets the rows from those that read and filter the table."""
    folder, hadoop = fresh_folder(spark, "one-file"), spark.sparkContext._jvm.org.apache.hadoop.fs
    rows.repartition(1).write.option(ROW_GROUP, TASK_BYTES).parquet(folder)
    fs = hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    [file] = fs.globStatus(hadoop.Path(f"{folder}/part-*"))
    fs.mkdirs(hadoop.Path(path).getParent())
    fs.delete(hadoop.Path(path), False)
    fs.rename(file.getPath(), hadoop.Path(path))


def load_by_manifest_twice(spark, sf_dir):
    """Two files land, then a third, while one of the former is rewritten under its name:
    the second load takes these two, and the former rows of the rewritten file go."""
    orders, db = _read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), _database(spark)
    landing, third = fresh_folder(spark, "landing"), F.col("o_orderkey") % 3
    names = (f"{db}.orders", f"{db}.files")

    def load():
        done = load_by_manifest(landing, *names, schema=orders.schema, log_table=f"{db}.ingest_logs")
        return F.lit(f"{done.new_files} new, {done.changed_files} changed, {done.rows} rows")

    _put(spark, orders.where(third == 0), f"{landing}/0.parquet")
    _put(spark, orders.where(third == 1), f"{landing}/1.parquet")
    outcomes = [load()]
    _put(spark, orders.where(third == 2), f"{landing}/2.parquet")
    _put(spark, orders.where((third == 1) & (F.col("o_orderkey") % 2 == 0)).withColumn("o_totalprice", -F.col("o_totalprice")), f"{landing}/1.parquet")
    outcomes += [load(), load()]
    rows = spark.table(names[0]).select("o_orderkey", "o_totalprice", "source_file_name")
    none = F.lit(None)
    for i, outcome in enumerate(outcomes):
        rows = rows.union(spark.range(1).select(F.lit(-i).cast("bigint"), none.cast("double"), outcome))
    return rows


def load_rescued(spark, sf_dir):
    """Three files of text in the wrong shape: a column that is not defined, prices that
    are no numbers, and in the third one so many of them that it is refused."""
    db, landing = _database(spark), fresh_folder(spark, "landing")
    orders, key = _read(spark, sf_dir, "orders"), F.col("o_orderkey")
    bad = (key % 3 == 2) | (key % 7 == 0)
    texts = orders.select(
        "o_orderkey",
        F.when(bad, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(key % 5 == 0, F.lit("?")).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(key % 2 == 0, F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    for n in range(3):
        _put(spark, texts.where(key % 3 == n), f"{landing}/{n}.parquet")
    columns = [("o_orderkey", "bigint"), ("o_totalprice", "double"), ("o_custkey", "bigint"), ("o_comment", "string")]
    definition = TableDefinition(f"{db}.orders", [ColumnDefinition(*c) for c in columns])
    done = load_by_manifest(landing, f"{db}.orders", f"{db}.files", definition=definition, refuse_above=0.5)
    rows = spark.table(f"{db}.orders")
    counts = rows.agg(
        F.count("*").alias("rows"), F.count("o_totalprice").alias("prices"), F.count("o_comment").alias("comments")
    ).select(F.expr("stack(3, 'rows', rows, 'prices', prices, 'comments', comments) AS (what, n)"))
    refused = spark.range(1).select(F.lit("refused files"), F.lit(done.refused_files).cast("bigint"))
    return rescue_summary(rows).toDF("what", "n").union(counts).union(refused)


def month_slice(spark, sf_dir):
    return projections.in_month(_read(spark, sf_dir, "orders"), "o_orderdate", "1998-03")


# Projections and filters


def stage_with_lineage(spark, sf_dir):
    rows = staged_rows(_read(spark, sf_dir, "orders"), "o_orderkey, o_orderdate, o_totalprice")
    return rows.select(
        "o_orderkey",
        "o_orderdate",
        "o_totalprice",
        F.col("loaded_at").isNotNull().alias("has_loaded_at"),
        F.col("source_file_path").contains("orders.parquet").alias("from_orders"),
        F.col("source_file_name").endswith(".parquet").alias("has_file_name"),
        F.col("source_file_modified_at").isNotNull().alias("has_modified_at"),
    )


def strip_suffix(spark, sf_dir):
    shifted = apply_timezone_conversion(_read(spark, sf_dir, "events"), source_timezone=NEW_YORK)
    return projections.strip_suffix(shifted.withColumnRenamed("value", "value_utc")).drop("props")


def conform_columns(spark, sf_dir):
    wanted = [ColumnDefinition(n, "string") for n in ("event_type", "event_id", "value")]
    return projections.conform(_read(spark, sf_dir, "events"), wanted)


def audit_fill(spark, sf_dir):
    given = _read(spark, sf_dir, "customer").withColumn("created_at", _at("2020-01-02 03:04:05"))
    return projections.fill_audit(given).select(
        "c_custkey", "is_active", "created_at", F.col("updated_at").isNotNull().alias("has_updated_at")
    )


# Joins, aggregation, distinct


def join_with_lookup(spark, sf_dir):
    joined = join_lookup(
        _read(spark, sf_dir, "customer"),
        _read(spark, sf_dir, "nation"),
        "c_nationkey",
        "n_nationkey",
        as_text=["n_regionkey"],
    )
    return joined.select("c_custkey", "c_nationkey", "n_name", "n_regionkey")


def _staged_keys(spark, sf_dir):
    """Keys of three tables with the files they come from."""
    columns = {"customer": "c_custkey", "supplier": "s_suppkey", "orders": "o_orderkey"}
    parts = [
        staged_rows(_read(spark, sf_dir, name), f"{key} AS record_key")
        for name, key in columns.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def file_statistics(spark, sf_dir):
    return file_load_stats(_staged_keys(spark, sf_dir)).select(
        "source_file_name", "row_count", F.col("file_modified_at").isNotNull().alias("has_modified_at")
    )


def load_counts(spark, sf_dir):
    """Row counts observed during the writes, next to those of the files written."""
    counted = []
    for name in ("customer", "orders", "lineitem"):
        folder, seen = fresh_folder(spark, "counted"), Observation()
        rows = _read(spark, sf_dir, name).observe(seen, F.count(F.lit(1)).alias("rows"))
        rows.write.parquet(folder)
        written = scan(spark, folder).agg(F.count("*").alias("rows_written"))
        observed = F.lit(seen.get["rows"]).cast("bigint").alias("rows_observed")
        counted.append(written.select(F.lit(name).alias("table_name"), observed, "rows_written"))
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def grouped_sum_by_type(spark, sf_dir):
    totals = grouped_sum(_read(spark, sf_dir, "events"), "event_type", "value", "total_value")
    return totals.withColumn("total_value", F.round("total_value", 2))


def dedup_by_key(spark, sf_dir):
    """A row per key, and whether each is a whole row of the source."""
    lineitem, keys = _read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    kept = dedup_keys(lineitem, keys)
    whole = F.xxhash64(*lineitem.columns).alias("whole")
    source = lineitem.select(whole).distinct().withColumn("is_a_source_row", F.lit(True))
    found = kept.select(*keys, whole).join(source, "whole", "left")
    return found.select(*keys, F.coalesce("is_a_source_row", F.lit(False)).alias("is_a_source_row"))


def dedup_by_latest(spark, sf_dir):
    lineitem, keys = _read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    rest = [c for c in lineitem.columns if c not in (*keys, "l_shipdate")]
    return dedup_latest(lineitem, keys, [F.desc("l_shipdate"), *[F.asc(c) for c in rest]])


# Table writes


def _customer_halves(spark, sf_dir):
    customers = _read(spark, sf_dir, "customer")
    owing = F.coalesce(F.col("c_acctbal") < 0, F.lit(False))
    return customers.where(~owing), customers.where(owing)


def append_evolve(spark, sf_dir):
    name = f"{_database(spark)}.customer"
    first, second = _customer_halves(spark, sf_dir)
    insert_or_update_table(first, name, append_only=True)
    second = second.drop("c_mktsegment").withColumn("c_risk", F.lit("owing"))
    insert_or_update_table(second, name, append_only=True, schema_evolution=True)
    return spark.table(name)


def evolve_order(spark, sf_dir):
    """Audit columns of an evolving append end up after business columns."""
    name = f"{_database(spark)}.customer"
    first, second = _customer_halves(spark, sf_dir)
    insert_or_update_table(first.select("c_custkey", "c_name"), name, append_only=True)
    second = second.select(
        F.lit(True).alias("is_active"), "c_mktsegment", _at("2024-01-01 00:00:00").alias("created_at"),
        "c_custkey", "c_name", "c_acctbal",
    )
    insert_or_update_table(second, name, append_only=True, schema_evolution=True)
    table = spark.table(name)
    return table.select("c_custkey", "c_acctbal", F.lit(",".join(table.columns)).alias("column_order"))


def _order_versions(spark, sf_dir):
    """A table of older orders and a later batch that overlaps it: repriced,
    with a NULL status for urgent orders."""
    orders = _read(spark, sf_dir, "orders")
    target = orders.where("o_orderdate < TIMESTAMP_NTZ'2000-01-01 00:00:00'").withColumn(
        "created_at", _at("2020-01-01 00:00:00")
    )
    urgent = F.col("o_orderpriority") == "1-URGENT"
    source = orders.where("o_orderdate >= TIMESTAMP_NTZ'1998-01-01 00:00:00'").withColumns(
        {
            "o_totalprice": F.col("o_totalprice") + 1000,
            "o_orderstatus": F.when(~urgent, F.col("o_orderstatus")),
            "created_at": _at("2024-01-01 00:00:00"),
        }
    )
    return target, source


def upsert_merge(spark, sf_dir):
    target, source = _order_versions(spark, sf_dir)
    return merged(target, source, ["o_orderkey"])


def upsert_table(spark, sf_dir):
    name = f"{_database(spark)}.orders"
    target, source = _order_versions(spark, sf_dir)
    insert_or_update_table(target, name, append_only=True)
    insert_or_update_table(source, name, key_columns=["o_orderkey"])
    return spark.table(name)


def upsert_partitioned(spark, sf_dir):
    """The same upsert into a table partitioned by status, which moves rows."""
    name = f"{_database(spark)}.orders"
    target, source = _order_versions(spark, sf_dir)
    insert_or_update_table(target, name, append_only=True, partition_by=["o_orderstatus"])
    insert_or_update_table(source, name, key_columns=["o_orderkey"])
    return spark.table(name)


def upsert_by_day(spark, sf_dir):
    """The same upsert into a table partitioned by the order's year, month and day."""
    name = f"{_database(spark)}.orders"
    day = {part: F.date_part(F.lit(part), "o_orderdate").cast("int") for part in ("year", "month", "day")}
    target, source = (rows.withColumns(day) for rows in _order_versions(spark, sf_dir))
    insert_or_update_table(target, name, append_only=True, partition_by=list(day))
    insert_or_update_table(source, name, key_columns=["o_orderkey"])
    return spark.table(name).drop(*day)


def upsert_csv_table(spark, sf_dir):
    """The same upsert into a csv table with a header and a separator."""
    name = f"{_database(spark)}.orders"
    target, source = _order_versions(spark, sf_dir)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in target.schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING csv OPTIONS (sep '|', header 'true')")
    insert_or_update_table(target, name, append_only=True)
    insert_or_update_table(source, name, key_columns=["o_orderkey"])
    return spark.table(name)


def upsert_bucketed(spark, sf_dir):
    """The same upsert into a table laid out by the key's hash, in two steps: the second
    one is of a single customer and rewrites only the buckets of that customer's orders."""
    name = f"{_database(spark)}.orders"
    target, source = _order_versions(spark, sf_dir)
    insert_or_update_table(target, name, key_columns=["o_orderkey"], key_buckets=32)
    few = F.col("o_custkey") == source.agg(F.min("o_custkey")).first()[0]
    insert_or_update_table(source.where(~few), name, key_columns=["o_orderkey"])
    insert_or_update_table(source.where(few), name, key_columns=["o_orderkey"])
    return spark.table(name).drop("key_bucket")


def append_twice(spark, sf_dir):
    """Two writers append halves of the customers, one of them twice under its number."""
    name = f"{_database(spark)}.customer"
    first, second = _customer_halves(spark, sf_dir)
    append_once(first, name, "a", 1)
    append_once(second.limit(3), name, "b", 7)  # lost before it had written all
    append_once(second, name, "b", 7)
    append_once(first, name, "a", 1)
    return spark.table(name).drop("append_id")


def upsert_history_of_status(spark, sf_dir):
    """The status of each customer's last order as a history: orders arrive in three parts
    that follow their times, and the first arrives again after the second."""
    name = f"{_database(spark)}.status"
    definition = TableDefinition(
        name,
        [ColumnDefinition("o_custkey", "bigint", False), ColumnDefinition("o_orderstatus", "string")],
        key_columns=["o_custkey"],
        include_create_and_update=False,
        include_valid_from_valid_to=True,
    )
    at = F.expr("CAST(o_orderdate AS timestamp) + make_dt_interval(0, 0, 0, o_orderkey)").alias("at")
    orders = _read(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", at)
    years = F.year("at")
    orders = orders.withColumn("part", F.when(years < 1996, 0).when(years < 1998, 1).otherwise(2))
    for part in (0, 1, 0, 2):
        changes = orders.where(F.col("part") == part).drop("part")
        upsert_history(changes, definition, as_of="at", key_buckets=16)
    times = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("valid_from", "valid_to")]
    return spark.table(name).select("o_custkey", "o_orderstatus", *times, "is_active")


def migrate_to_wider_types(spark, sf_dir):
    """A table of int and float line items becomes one of bigint and double with a comment
    and a new column, and takes rows that only fit the new version."""
    name, lineitem = f"{_database(spark)}.lineitem", _read(spark, sf_dir, "lineitem")
    narrow = [ColumnDefinition("l_orderkey", "int"), ColumnDefinition("l_linenumber", "int"), ColumnDefinition("l_suppkey", "int")]
    wide = [
        ColumnDefinition("l_orderkey", "bigint", comment="the order"), ColumnDefinition("l_linenumber", "int"),
        ColumnDefinition("l_suppkey", "bigint"), ColumnDefinition("l_returnflag", "string"),
    ]
    options = {"include_is_active": False, "include_create_and_update": False}
    first = TableDefinition(name, narrow, version="1.0.0", **options)
    migrate_table(first)
    old = F.col("l_orderkey") % 2 == 0
    insert_or_update_table(projections.conform(lineitem.where(old), narrow), name, append_only=True)
    second = TableDefinition(name, wide, version="1.1.0", **options)
    done = migrate_table(second)
    later = lineitem.where(~old).withColumn("l_orderkey", F.col("l_orderkey") + F.lit(10**10))
    insert_or_update_table(projections.conform(later, wide), name, append_only=True)
    changes = ",".join(done.added + done.widened + done.commented)
    return spark.table(name).withColumn("changes", F.lit(f"{second.catalog_version()} {changes}"))


def _versioned_orders(spark, sf_dir):
    """Three batches of orders: each leaves a third of them out, has every other order
    twice, and holds stale rows of the batch before."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    batches = []
    for n in range(3):
        some = orders.where(F.col("o_orderkey") % 3 != n).withColumn("version", F.lit(10 * n))
        twice = some.where("o_orderkey % 2 = 0").withColumn("version", F.col("version") + 5)
        stale = some.where("o_orderkey % 5 = 0").withColumn("version", F.col("version") - 8)
        batches.append(
            some.unionByName(twice).unionByName(stale).withColumn("o_totalprice", F.col("o_totalprice") + F.col("version"))
        )
    return batches


def stream_upsert(spark, sf_dir):
    """The batches land one after the other and are upserted by a stream; the second one
    is then applied once more under its name."""
    name = f"{_database(spark)}.orders"
    landing, checkpoint = fresh_folder(spark, "landing"), fresh_folder(spark, "upserted")
    options = {"newest_by": ["version"], "key_buckets": 16}
    batches = _versioned_orders(spark, sf_dir)
    for n, batch in enumerate(batches):
        batch.write.mode("append").option(ROW_GROUP, TASK_BYTES).parquet(landing)
        stream = scan_stream(spark, landing, batch.schema)
        names = upsert_stream(stream, name, ["o_orderkey"], checkpoint, **options)
        if n == 1:
            again = names[0]
    apply_batch(batches[1], again, name, ["o_orderkey"], **options)
    return spark.table(name).select("o_orderkey", "o_orderstatus", "o_totalprice", "version")


def gated_write(spark, sf_dir):
    """Valid line items pass the gate; all of them are refused with the counts."""
    name, lineitem = f"{_database(spark)}.lineitem", _read(spark, sf_dir, "lineitem")
    insert_or_update_table(LINEITEM.process_data(lineitem)[0], name, append_only=True, gate=LINEITEM)
    try:
        insert_or_update_table(lineitem, name, append_only=True, gate=LINEITEM)
    except ValueError as e:
        refused = dict(re.findall(r"(\w+): (\d+) rows", str(e)))
    accepted = spark.table(name).agg(F.count("*").alias("row_count"))
    counts = [
        F.struct(F.lit(k).alias("outcome"), F.lit(int(n)).cast("bigint").alias("row_count"))
        for k, n in refused.items()
    ]
    first = F.struct(F.lit("accepted").alias("outcome"), F.col("row_count"))
    return accepted.select(F.inline(F.array(first, *counts)))


def zone_load(spark, sf_dir):
    """Orders as triangular zones, with the attributes of their customers."""
    db, size = _database(spark), 1 + F.sqrt("o_totalprice") / 1000
    x, y = F.col("o_custkey"), F.col("o_orderkey")
    triangle = F.array(ring((x, y), (x + size, y), (x, y + size), (x, y)))
    load_zones(
        _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", triangle.alias("rings")),
        _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"),
        "o_custkey",
        "c_custkey",
        f"{db}.zones",
        log_table=f"{db}.ingest_logs",
    )
    zones = spark.table(f"{db}.zones").select(
        "o_orderkey", "c_name", "c_mktsegment",
        F.round("longitude", 4).alias("longitude"), F.round("latitude", 4).alias("latitude"),
    )
    log = spark.table(f"{db}.ingest_logs").select(
        "records_processed", F.lit("log"), "status", F.lit(None).cast("double"), F.lit(None).cast("double")
    )
    return zones.union(log)


def upsert_audit(spark, sf_dir):
    """Customers upserted twice, the owing ones inactive before the second time."""
    name = f"{_database(spark)}.customer"
    customers = _read(spark, sf_dir, "customer")
    paid_up = F.coalesce(F.col("c_acctbal") >= 0, F.lit(False))
    insert_or_update_process_table(name, customers.withColumn("is_active", paid_up), ["c_custkey"])
    insert_or_update_process_table(name, customers, ["c_custkey"], force_remove_duplicates=True)
    moved = F.col("created_at") < F.col("updated_at")
    return spark.table(name).select("c_custkey", "c_name", "is_active", moved.alias("created_before_updated"))


def load_log(spark, sf_dir):
    name = f"{_database(spark)}.ingest_logs"
    log_load(
        file_load_stats(_staged_keys(spark, sf_dir)),
        execution_id="run-1",
        source_system="shop",
        table_name="stg_keys",
        start_time=datetime.now(),
        log_table=name,
    )
    return spark.table(name).select(
        "execution_id", "source_system", "table_name", "status",
        "records_processed", "records_failed", "message",
    )


def dataset_chain(spark, sf_dir):
    db = _database(spark)
    trips = materialize(_read(spark, sf_dir, "orders"), f"{db}.orders")
    totals = grouped_sum(trips, "o_orderpriority", "o_totalprice", "total_price")
    return materialize(totals, f"{db}.priority_totals").withColumn("total_price", F.round("total_price", 2))


# Compositions


def _registry(spark, sf_dir, db):
    rows = [
        ("shop.orders", f"{sf_dir}/orders.parquet", f"{db}.stg_orders",
         "o_orderkey, o_orderdate", "o_totalprice > 1000; o_orderstatus <> 'P'"),
        ("shop.customer", f"{sf_dir}/customer.parquet", f"{db}.stg_customer", "*", None),
        ("shop.lineitem", f"{sf_dir}/lineitem.parquet", f"{db}.stg_lineitem",
         "l_orderkey, l_linenumber, l_shipdate", "l_quantity > 10"),
        ("shop.part", f"{sf_dir}/part.parquet", f"{db}.stg_part", "*", None),
    ]
    schema = "source_system string, volume string, stg_table string, select_columns string, filter_condition string"
    registry = spark.createDataFrame(rows, schema).withColumn(
        "is_active", F.col("source_system") != "shop.part"
    )
    insert_or_update_process_table(
        f"{db}.src_definitions", registry, ["source_system", "stg_table"]
    )
    return [r[2] for r in rows]


def _log(spark, db):
    short = F.regexp_replace("table_name", r"^.*\.", "")
    return spark.table(f"{db}.ingest_logs").select(
        short.alias("table_name"), "status", "records_processed", "records_failed", "message"
    )


def metadata_load(spark, sf_dir):
    """Registry → new files → staging tables → log; the second run loads nothing."""
    return _log(spark, _loaded_twice(spark, sf_dir))


def metadata_load_rows(spark, sf_dir):
    """The staged rows of one of the sources, with their shifted times."""
    db = _loaded_twice(spark, sf_dir)
    return spark.table(f"{db}.stg_orders").select("o_orderkey", "o_orderdate_utc")


def metadata_load_types(spark, sf_dir):
    """One source whose files disagree on a column's type: int and bigint."""
    db, landing = _database(spark), fresh_folder(spark, "landing")
    lineitem = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    early = F.col("l_orderkey") % 2 == 0
    lineitem.where(early).write.parquet(landing)
    later = lineitem.where(~early).withColumn("l_linenumber", F.col("l_linenumber").cast("bigint"))
    later.write.mode("append").parquet(landing)
    row = [("shop.lineitem", landing, f"{db}.stg_lineitem", "*", None)]
    schema = "source_system string, volume string, stg_table string, select_columns string, filter_condition string"
    insert_or_update_process_table(
        f"{db}.src_definitions", spark.createDataFrame(row, schema), ["source_system", "stg_table"]
    )
    populate_stg_tables_from_storage(
        f"{db}.stg_lineitem",
        registry_table=f"{db}.src_definitions",
        log_table=f"{db}.ingest_logs",
        checkpoint_root=fresh_folder(spark, "loaded"),
    )
    return spark.table(f"{db}.stg_lineitem").select("l_orderkey", "l_linenumber")


def _loaded_twice(spark, sf_dir):
    db = _database(spark)
    names, loaded = _registry(spark, sf_dir, db), fresh_folder(spark, "loaded")
    for _ in range(2):
        populate_stg_tables_from_storage(
            names,
            timezone_to_utc=True,
            source_timezone=NEW_YORK,
            registry_table=f"{db}.src_definitions",
            log_table=f"{db}.ingest_logs",
            checkpoint_root=loaded,
        )
    return db


def metadata_load_sql(spark, sf_dir):
    db = _database(spark)
    populate_stg_tables_from_sql(
        _registry(spark, sf_dir, db),
        registry_table=f"{db}.src_definitions",
        log_table=f"{db}.ingest_logs",
    )
    return _log(spark, db)


def refine_lineitem(spark, sf_dir):
    """Validated rows upserted on their key, failing rows quarantined; both
    outputs in one frame."""
    db = _database(spark)
    definition = TableDefinition(
        table_name=f"{db}.lineitem",
        columns=[
            ColumnDefinition("l_orderkey", "bigint", False),
            ColumnDefinition("l_linenumber", "int", False, min_value=1),
            *LINEITEM.columns[1:],
        ],
        key_columns=["l_orderkey", "l_linenumber"],
    )
    refine(
        _read(spark, sf_dir, "lineitem"),
        definition,
        quarantine_table=f"{db}.lineitem_quarantine",
        log_table=f"{db}.ingest_logs",
        force_remove_duplicates=True,
        order_by=[F.desc(c) for c in ("l_quantity", "l_discount", "l_tax")],
    )
    names = [c.name for c in definition.columns]
    clean = spark.table(f"{db}.lineitem").where("is_active").select(
        F.lit("clean").alias("outcome"), *names, F.lit("").alias("reasons")
    )
    reasons = F.array_join("validation_errors", ",").alias("reasons")
    failing = spark.table(f"{db}.lineitem_quarantine").select(
        F.lit("quarantined").alias("outcome"), *names, reasons
    )
    none = F.lit(None).cast("double")
    log = spark.table(f"{db}.ingest_logs").select(
        F.lit("log"), "records_processed", F.col("records_failed").cast("int"), none, none, none, "status"
    )
    return clean.unionByName(failing).union(log)


# Data quality


def validate_flag(spark, sf_dir):
    return LINEITEM.validate_dataframe(_read(spark, sf_dir, "lineitem"))


def validate_reasons(spark, sf_dir):
    rows = LINEITEM.validate_with_reasons(_read(spark, sf_dir, "lineitem"))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "is_row_valid",
        F.array_join("validation_errors", ",").alias("reasons"),
        F.size("validation_errors").alias("reason_count"),
    )


def clean_rows(spark, sf_dir):
    return LINEITEM.process_data(_read(spark, sf_dir, "lineitem"))[0]


def quarantine_rows(spark, sf_dir):
    rows = LINEITEM.process_data(_read(spark, sf_dir, "lineitem"))[1]
    return rows.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "is_row_valid",
        F.array_join("validation_errors", ",").alias("reasons"),
    )


def validation_summary(spark, sf_dir):
    return LINEITEM.failure_summary(_read(spark, sf_dir, "lineitem"))


def constraint_violations(spark, sf_dir):
    return LINEITEM.constraint_violations(_read(spark, sf_dir, "lineitem"))


def schema_drift(spark, sf_dir):
    expected = TableDefinition(
        table_name="orders",
        columns=[
            ColumnDefinition("O_ORDERKEY", "bigint"),
            ColumnDefinition("o_custkey", "int"),
            ColumnDefinition("o_totalprice", "double"),
            ColumnDefinition("o_orderdate", "timestamp_ntz"),
            ColumnDefinition("o_orderpriority", "int"),
            ColumnDefinition("o_clerk", "string"),
        ],
        include_is_active=False,
        include_create_and_update=False,
    )
    return expected.drift_report(_read(spark, sf_dir, "orders"))


# Scalar functions


def tz_to_utc(spark, sf_dir):
    return apply_timezone_conversion(
        _read(spark, sf_dir, "events"), source_timezone=NEW_YORK, select_columns="event_id, ts, user_id"
    )


def tz_keep_name(spark, sf_dir):
    return apply_timezone_conversion(
        _read(spark, sf_dir, "events"),
        source_timezone=NEW_YORK,
        select_columns=["event_id", "ts"],
        convert_to_utc=False,
    )


def tz_cast(spark, sf_dir):
    rows = cast_timestamps(_read(spark, sf_dir, "events"), "event_id, ts", ["ts"])
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return rows.select("event_id", F.typeof("ts").alias("ts_type"), text.alias("ts_text"))


def zone_centroid(spark, sf_dir):
    """A zone per order: a right triangle, and for finished orders an L shape,
    a rectangle with a hole, or two rectangles apart."""
    x, y = F.col("o_custkey"), F.col("o_orderkey")
    size = 1 + F.sqrt("o_totalprice") / 1000

    def box(dx, dy, width, clockwise=False):
        corners = [(x + dx, y + dy), (x + dx + width, y + dy),
                   (x + dx + width, y + dy + width), (x + dx, y + dy + width)]
        return ring(*(corners[::-1] if clockwise else corners))

    triangle = F.array(ring((x, y), (x + size, y), (x, y + size), (x, y)))
    shapes = (
        F.when(F.col("o_orderstatus") == "F", F.array(box(0, 0, 4 * size), box(size, size, size, True)))
        .when(F.col("o_orderstatus") == "P", F.array(box(0, 0, size), box(10, 10, 2 * size)))
        .otherwise(triangle)
    )
    zones = _read(spark, sf_dir, "orders").select("o_orderkey", shapes.alias("rings"))
    zones = zones.select("o_orderkey", centroid(F.col("rings")).alias("c"))
    return zones.select(
        "o_orderkey",
        F.round("c.longitude", 4).alias("longitude"),
        F.round("c.latitude", 4).alias("latitude"),
    )


QUERIES = {
    "scan_formats": scan_formats,
    "scan_csv_options": scan_csv_options,
    "scan_parquet_select": scan_parquet_select,
    "filter_clauses": filter_clauses,
    "scan_table": scan_table,
    "registry_active_sources": registry_active_sources,
    "load_new_files": load_new_files_once,
    "load_by_manifest": load_by_manifest_twice,
    "load_rescued": load_rescued,
    "month_slice": month_slice,
    "stage_with_lineage": stage_with_lineage,
    "strip_suffix": strip_suffix,
    "conform_columns": conform_columns,
    "audit_fill": audit_fill,
    "join_lookup": join_with_lookup,
    "file_load_stats": file_statistics,
    "load_counts": load_counts,
    "grouped_sum": grouped_sum_by_type,
    "dedup_keys": dedup_by_key,
    "dedup_latest": dedup_by_latest,
    "append_evolve": append_evolve,
    "evolve_order": evolve_order,
    "append_once": append_twice,
    "upsert_history": upsert_history_of_status,
    "migrate_table": migrate_to_wider_types,
    "upsert_merge": upsert_merge,
    "upsert_table": upsert_table,
    "upsert_partitioned": upsert_partitioned,
    "upsert_by_day": upsert_by_day,
    "upsert_csv_table": upsert_csv_table,
    "upsert_bucketed": upsert_bucketed,
    "stream_upsert": stream_upsert,
    "upsert_audit": upsert_audit,
    "gated_write": gated_write,
    "zone_load": zone_load,
    "load_log": load_log,
    "dataset_chain": dataset_chain,
    "metadata_load": metadata_load,
    "metadata_load_rows": metadata_load_rows,
    "metadata_load_types": metadata_load_types,
    "metadata_load_sql": metadata_load_sql,
    "refine_table": refine_lineitem,
    "validate_flag": validate_flag,
    "validate_reasons": validate_reasons,
    "clean_rows": clean_rows,
    "quarantine_rows": quarantine_rows,
    "validation_summary": validation_summary,
    "constraint_violations": constraint_violations,
    "schema_drift": schema_drift,
    "tz_to_utc": tz_to_utc,
    "tz_keep_name": tz_keep_name,
    "tz_cast": tz_cast,
    "zone_centroid": zone_centroid,
}
