import os
import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewright import (
    ColumnDefinition,
    TableDefinition,
    insert_ingestion_log,
    insert_or_update_process_table,
    populate_stg_tables_from_sql,
    populate_stg_tables_from_storage,
)
from tidewright.plans import staging
from tidewright.plans.datasets import materialize
from tidewright.plans.refine import refine
from tidewright.plans.staging import staged_rows
from tidewright.sources.files import scan_stream
from tidewright.sources.registry import src_definitions
from tidewright.sources.tables import overwrite_partition
from tidewright.sources import load_log
from tidewright.streaming import file_loader
from test_merge import rows


@pytest.fixture
def shop(spark, db, tmp_path):
    """Register sources and run loads in a database and folder of their own."""

    class Shop:
        path = str(tmp_path / "land")
        control = {"registry_table": f"{db}.src", "log_table": f"{db}.log"}

        def register(self, table="stg", path=None, select="*", where=None, system="s", active=True):
            schema = src_definitions().to_schema(include_audit=False)
            row = [(system, path or self.path, f"{db}.{table}", select, where)]
            frame = spark.createDataFrame(row, schema).withColumn("is_active", F.lit(active))
            insert_or_update_process_table(f"{db}.src", frame, ["source_system", "stg_table"])
            return f"{db}.{table}"

        def land(self, sql):
            spark.sql(sql).coalesce(1).write.mode("append").parquet(self.path)

        def load(self, *names, **options):
            options.setdefault("checkpoint_root", str(tmp_path / "loaded"))
            return populate_stg_tables_from_storage([f"{db}.{n}" for n in names] or f"{db}.stg", **self.control, **options)

        def log(self):
            return spark.table(f"{db}.log")

    return Shop()


def test_each_file_once_with_new_columns(spark, shop):
    name = shop.register()
    shop.land("SELECT id FROM range(3)")
    assert shop.load() == {name: 3}
    assert shop.load() == {name: 0}
    shop.land("SELECT id + 10 AS id, 'x' AS extra FROM range(2)")
    assert shop.load() == {name: 2}
    assert rows(spark.table(name).select("id", "extra")) == sorted(
        [(0, None), (1, None), (2, None), (10, "x"), (11, "x")], key=repr
    )
    lineage = spark.table(name).select("loaded_at", "source_file_name", "source_file_path", "source_file_modified_at")
    assert lineage.dropna().count() == 5
    messages = [r["message"] for r in shop.log().where("end_time IS NOT NULL").collect()]
    assert sorted(messages) == ["1 new files, 2 rows.", "1 new files, 3 rows.", "No new rows."]
    per_file = shop.log().where("end_time IS NULL")
    assert sorted(r["records_processed"] for r in per_file.collect()) == [2, 3]


def test_projection_filters_and_zone(spark, shop):
    name = shop.register(select="id, at", where="id > 0; id < 9")
    shop.land("SELECT id, TIMESTAMP_NTZ'2025-01-15 12:00:00' AS at, TIMESTAMP_NTZ'2025-01-15 12:00:00' AS other FROM range(10)")
    loaded = shop.load(timezone_to_utc=True, source_timezone="America/New_York", filter_condition="id <> 5")
    assert loaded == {name: 7}
    table = spark.table(name)
    assert table.columns[:2] == ["id", "at_utc"] and "other" not in " ".join(table.columns)
    assert str(table.first()["at_utc"]) == "2025-01-15 17:00:00"


def test_filter_that_keeps_nothing(spark, shop):
    name = shop.register(where="id > 100")
    shop.land("SELECT id FROM range(3)")
    assert shop.load() == {name: 0}
    assert [r["records_processed"] for r in shop.log().collect()] == [0]


def test_single_csv_file(spark, shop, tmp_path):
    path = tmp_path / "lookup.csv"
    path.write_text("LocationID|Zone\n1|Newark\n2|Jamaica\n")
    name = shop.register(path=str(path), select="LocationID, Zone")
    options = {"file_format": "CSV", "csv_header": True, "csv_delimiter": "|"}
    assert shop.load(**options) == {name: 2}
    assert shop.load(**options) == {name: 0}
    assert rows(spark.table(name).select("LocationID", "Zone")) == [("1", "Newark"), ("2", "Jamaica")]


def test_late_file_with_an_old_time_is_loaded(spark, shop):
    name = shop.register()
    shop.land("SELECT 1 AS id")
    assert shop.load() == {name: 1}
    shop.land("SELECT 2 AS id")
    for entry in os.scandir(shop.path):
        os.utime(entry.path, (1_000_000_000, 1_000_000_000))
    assert shop.load() == {name: 1}
    assert rows(spark.table(name).select("id")) == [(1,), (2,)]


def test_csv_with_other_columns_is_refused(spark, shop, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("a,b\n1,2\n")
    name = shop.register(path=str(folder))
    options = {"file_format": "csv", "csv_header": True, "schema": "a string, b string"}
    assert shop.load(**options) == {name: 1}
    (folder / "b.csv").write_text("b,a\n2,1\n")
    with pytest.raises(Exception, match="CSV header"):
        shop.load(**options)


def test_batches_of_a_large_first_load(spark, shop):
    name = shop.register()
    for i in range(3):
        shop.land(f"SELECT {i} AS id")
    assert shop.load(options={"maxFilesPerTrigger": "1"}) == {name: 3}
    assert len({r["load_id"] for r in spark.table(name).collect()}) == 3


def test_replayed_batch_replaces_its_first_attempt(spark, db, tmp_path):
    """The batch fails after its rows are written; the next run replays it."""
    spark.range(5).write.parquet(f"{tmp_path}/land")
    schema, name = spark.range(1).schema, f"{db}.t"
    stream = lambda: staged_rows(scan_stream(spark, f"{tmp_path}/land", schema), "*")
    spark.sql(f"CREATE TABLE {name} (id BIGINT, loaded_at TIMESTAMP, source_file_name STRING, source_file_path STRING, source_file_modified_at TIMESTAMP, load_id STRING) USING parquet PARTITIONED BY (load_id)")

    def write_then_fail(batch, load_id):
        overwrite_partition(batch, name, "load_id", load_id)
        raise RuntimeError("driver lost")

    with pytest.raises(Exception, match="driver lost"):
        file_loader.run_once(stream(), f"{tmp_path}/loaded", write_then_fail)
    assert spark.table(name).count() == 5
    new = file_loader.load_new_files(stream(), name, f"{tmp_path}/loaded")
    assert new.count() == 5 and spark.table(name).count() == 5
    assert file_loader.load_new_files(stream(), name, f"{tmp_path}/loaded") is None


def test_only_named_active_sources(spark, shop):
    shop.land("SELECT 1 AS id")
    a, b = shop.register("a"), shop.register("b", active=False)
    shop.register("c")
    # The registry upsert turns sources active unless told otherwise.
    assert set(shop.load("a", "b")) == {a}
    assert shop.load("unknown") == {}


def test_two_systems_feed_one_table(spark, shop, tmp_path):
    name = shop.register(system="one")
    shop.register(system="two", path=str(tmp_path / "land2"))
    shop.land("SELECT 1 AS id")
    spark.sql("SELECT 2 AS id").write.parquet(str(tmp_path / "land2"))
    assert shop.load() == {name: 2}
    assert rows(spark.table(name).select("id")) == [(1,), (2,)]


def test_sources_of_several_tables_load_at_once(spark, db, shop, monkeypatch):
    """Three tables meet while they load; the two sources of one table never do."""
    shop.land("SELECT id FROM range(3)")
    for table in ("a", "b", "c"):
        shop.register(table)
    shop.register("c", system="other")
    meet, inside, real = threading.Barrier(3, timeout=120), [], staging.load_new_files

    def load(rows_, table, *rest, **options):
        assert table not in inside
        inside.append(table)
        if "other" not in rest[0]:
            meet.wait()
        done = real(rows_, table, *rest, **options)
        inside.remove(table)
        return done

    monkeypatch.setattr(staging, "load_new_files", load)
    assert shop.load("a", "b", "c") == {f"{db}.a": 3, f"{db}.b": 3, f"{db}.c": 6}
    totals = shop.log().where("end_time IS NOT NULL").collect()
    assert sorted(r["records_processed"] for r in totals) == [3, 3, 3, 3]


def test_failure_leaves_other_tables_alone(spark, db, shop, tmp_path):
    shop.land("SELECT id FROM range(3)")
    shop.register("a", path=str(tmp_path / "nowhere"))
    shop.register("b")
    with pytest.raises(Exception, match="nowhere"):
        shop.load("a", "b")
    assert spark.table(f"{db}.b").count() == 3
    assert sorted(r["status"] for r in shop.log().where("end_time IS NOT NULL").collect()) == ["failed", "success"]


def test_failure_is_logged_and_raised(spark, shop, tmp_path):
    shop.register(path=str(tmp_path / "absent"))
    with pytest.raises(Exception):
        shop.load()
    row = shop.log().collect()
    assert len(row) == 1 and row[0]["status"] == "failed" and row[0]["message"].startswith("Error: ")


def test_arguments(spark, shop):
    with pytest.raises(ValueError, match="source_timezone"):
        shop.load(timezone_to_utc=True)
    with pytest.raises(ValueError, match="xls"):
        shop.load(file_format="xls")


def test_sql_variant_appends_every_time(spark, db, shop):
    name = shop.register(select="id", where="id > 0")
    shop.land("SELECT id, 'x' AS s FROM range(3)")
    for _ in range(2):
        assert populate_stg_tables_from_sql([name], **shop.control) == {name: 2}
    assert rows(spark.table(name).select("id")) == [(1,), (1,), (2,), (2,)]


def test_log_row(spark, db):
    common = {"execution_id": "e", "source_system": "s", "table_name": "t", "log_table": f"{db}.log"}
    insert_ingestion_log(status="success", duration_min=2.9, records_processed=3_000_000_000, **common)
    row = spark.table(f"{db}.log").first()
    assert (row["duration_min"], row["records_processed"], row["records_failed"]) == (2, 3_000_000_000, 0)
    with pytest.raises(ValueError, match="SUCCESS"):
        insert_ingestion_log(status="SUCCESS", **common)


def test_refine(spark, db):
    staged = spark.sql(
        """SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2025-01-15 17:00:00', 5.0D, 'x'),
        (2, TIMESTAMP_NTZ'2025-01-15 18:00:00', -1.0D, 'y'), (NULL, NULL, 1.0D, 'z') AS t(id, at_utc, fare, extra)"""
    )
    definition = TableDefinition(
        f"{db}.silver",
        [
            ColumnDefinition("id", "int", False),
            ColumnDefinition("at", "timestamp", False),
            ColumnDefinition("fare", "double", False, custom_condition="fare > 0"),
        ],
        key_columns=["id", "at"],
    )
    for _ in range(2):
        result = refine(staged, definition, quarantine_table=f"{db}.bad", log_table=f"{db}.log", execution_id="run")
        assert (result.records_processed, result.records_failed, result.records_kept) == (3, 2, 1)
    assert result.replaced_location != spark.table(f"{db}.silver").inputFiles()[0]
    silver = spark.table(f"{db}.silver")
    assert rows(silver.select("id", "fare", "is_active")) == [(1, 5.0, True)]
    assert silver.selectExpr("unix_seconds(at)").first()[0] == 1736960400
    assert silver.where("created_at < updated_at").count() == 1
    assert rows(spark.table(f"{db}.bad").select("id", "validation_errors")) == sorted(
        [(2, ["fare"]), (None, ["id", "at"])], key=repr
    )
    logged = spark.table(f"{db}.log").first()
    assert (logged["records_processed"], logged["records_failed"]) == (3, 2)


KEYED = [ColumnDefinition("k", "int"), ColumnDefinition("v", "int", False, min_value=0)]


def test_refine_loses_no_row(spark, db):
    staged = spark.createDataFrame(
        [(1, 5), (1, 7), (1, 6), (2, 1), (2, -1), (None, 1), (None, 1), (3, None)], "k int, v int"
    )
    definition = TableDefinition(f"{db}.t", KEYED, key_columns=["k"])
    where = {"quarantine_table": f"{db}.bad", "log_table": f"{db}.log"}
    with pytest.raises(ValueError, match="Several source rows"):
        refine(staged, definition, **where)
    failed = spark.table(f"{db}.log").collect()
    assert [r["status"] for r in failed] == ["failed"] and "Several" in failed[0]["message"]
    assert spark.table(f"{db}.t").count() == spark.table(f"{db}.bad").count() == 0
    result = refine(
        staged, definition, force_remove_duplicates=True, order_by=[F.desc("v")], partition_by=["k"], **where
    )
    assert (result.records_processed, result.records_kept, result.records_failed, result.records_duplicate) == (8, 2, 4, 2)
    assert rows(spark.table(f"{db}.t").select("k", "v")) == sorted([(1, 7), (2, 1)], key=repr)
    bad = spark.table(f"{db}.bad").select("k", "v", "validation_errors")
    assert rows(bad) == sorted(
        [(1, 5, ["duplicate key"]), (1, 6, ["duplicate key"]), (2, -1, ["v"]), (3, None, ["v"])]
        + [(None, 1, ["null key"])] * 2,
        key=repr,
    )


@pytest.mark.parametrize("partition_by", [[], ["v"]])
def test_refine_repeated_changes_no_row(spark, db, partition_by):
    staged = spark.createDataFrame([(1, 5), (2, 5), (None, 5), (None, None), (3, -1)], "k int, v int")
    definition = TableDefinition(f"{db}.t", KEYED, key_columns=["k"])
    for _ in range(3):
        result = refine(
            staged, definition, quarantine_table=f"{db}.bad", log_table=f"{db}.log", execution_id="run",
            partition_by=partition_by,
        )
        assert (result.records_kept, result.records_failed) == (2, 3)
        assert rows(spark.table(f"{db}.t").select("k", "v")) == [(1, 5), (2, 5)]
        bad = spark.table(f"{db}.bad").select("k", "v", "validation_errors")
        assert rows(bad) == sorted([(None, 5, ["null key"]), (None, None, ["v"]), (3, -1, ["v"])], key=repr)


def test_refine_of_a_frame_that_turns_out_empty(spark, db):
    """Emptiness that Spark finds out while it runs."""
    some = spark.range(5).selectExpr("CAST(id AS int) AS k", "1 AS v")
    none = some.join(spark.range(100, 105).selectExpr("CAST(id AS int) AS k"), "k", "left_semi")
    result = refine(none, TableDefinition(f"{db}.t", KEYED, key_columns=["k"]), quarantine_table=f"{db}.bad", log_table=f"{db}.log")
    assert (result.records_processed, spark.table(f"{db}.t").count()) == (0, 0)


def test_refine_evolves_both_tables(spark, db):
    where = {"quarantine_table": f"{db}.bad", "log_table": f"{db}.log"}
    refine(spark.createDataFrame([(1, 5), (2, -1)], "k int, v int"), TableDefinition(f"{db}.t", KEYED, key_columns=["k"]), **where)
    wider = TableDefinition(f"{db}.t", [*KEYED, ColumnDefinition("w", "int")], key_columns=["k"])
    refine(spark.createDataFrame([(3, 5, 1), (4, -1, 2)], "k int, v int, w int"), wider, **where)
    assert rows(spark.table(f"{db}.t").select("k", "w")) == sorted([(1, None), (3, 1)], key=repr)
    assert rows(spark.table(f"{db}.bad").select("k", "w")) == sorted([(2, None), (4, 2)], key=repr)


def test_log_is_complete_whatever_fails(spark, db, shop, monkeypatch):
    name = shop.register()
    for i in range(3):
        shop.land(f"SELECT id FROM range({i + 1})")
    real, calls = overwrite_partition, []

    def third_fails(rows_, *rest):
        calls.append(rest)
        if len(calls) == 3:
            raise RuntimeError("lost")
        real(rows_, *rest)

    monkeypatch.setattr(file_loader, "overwrite_partition", third_fails)
    with pytest.raises(Exception, match="lost"):
        shop.load(options={"maxFilesPerTrigger": "1"})
    monkeypatch.setattr(file_loader, "overwrite_partition", real)
    shop.load(options={"maxFilesPerTrigger": "1"})
    shop.load()
    assert spark.table(name).count() == 6
    per_file = shop.log().where("end_time IS NULL").collect()
    assert sorted(r["records_processed"] for r in per_file) == [1, 2, 3]
    assert shop.log().where("status = 'failed'").count() == 1
    totals = shop.log().where("end_time IS NOT NULL AND status = 'success'")
    assert sum(r["records_processed"] for r in totals.collect()) == 6


@pytest.mark.parametrize("written", [False, True])
def test_load_is_logged_once_whenever_the_driver_is_lost(spark, db, shop, monkeypatch, written):
    """Lost before or after the log's rows are written: their writing is also their mark."""
    name = shop.register()
    shop.land("SELECT id FROM range(3)")
    real = overwrite_partition

    def lost(rows_, table, *rest):
        if table == f"{db}.log":
            if written:
                real(rows_, table, *rest)
            raise KeyboardInterrupt("lost")
        real(rows_, table, *rest)

    with monkeypatch.context() as m:
        m.setattr(load_log, "overwrite_partition", lost)
        with pytest.raises(KeyboardInterrupt):
            shop.load()
    shop.land("SELECT id FROM range(2)")
    shop.load()
    shop.load()
    totals = shop.log().where("end_time IS NOT NULL AND status = 'success'").collect()
    assert sum(r["records_processed"] for r in totals) == spark.table(name).count() == 5
    per_file = shop.log().where("end_time IS NULL").collect()
    assert sorted(r["records_processed"] for r in per_file) == [2, 3]


def test_load_that_is_logged_again_replaces_its_rows(spark, db):
    load = {"execution_id": "e", "source_system": "s", "table_name": "t", "log_table": f"{db}.log"}
    stats = spark.createDataFrame([("a", "/a", 3), ("b", "/b", 4)], "source_file_name string, source_file_path string, row_count bigint")
    for some in (stats, stats.limit(1), stats):
        load_log.log_load(some, start_time=datetime.now(), load_id="x-1", **load)
    assert sorted(r["records_processed"] for r in spark.table(f"{db}.log").collect()) == [3, 4, 7]
    load_log.log_load(None, start_time=datetime.now(), load_id="x-2", **load)
    assert sorted(r[0] for r in load_log.logged_loads(spark, f"{db}.log").collect()) == ["x-1", "x-2"]
    spark.sql(f"CREATE TABLE {db}.flat (execution_id string) USING parquet")
    with pytest.raises(ValueError, match="partitioned by load_id"):
        load_log.prepare_log(f"{db}.flat")


def test_files_of_one_name_are_several_files(spark, db, shop, tmp_path):
    shop.register()
    for m in (1, 2):
        spark.range(m).coalesce(1).write.parquet(f"{tmp_path}/one")
        os.makedirs(f"{shop.path}/m={m}", exist_ok=True)
        part = next(f for f in os.scandir(f"{tmp_path}/one") if f.name.startswith("part-"))
        os.rename(part.path, f"{shop.path}/m={m}/part-0.parquet")
        os.rename(f"{tmp_path}/one", f"{tmp_path}/one-{m}")
    shop.load()
    messages = sorted(r["message"] for r in shop.log().collect())
    assert messages == ["2 new files, 3 rows.", "File part-0.parquet", "File part-0.parquet"]


def test_dataset_chain(spark, db):
    trips = materialize(spark.createDataFrame([(1, 2.5), (1, 1.5), (2, 1.0)], "zip int, fare double"), f"{db}.trips")
    totals = materialize(trips.groupBy("zip").agg(F.sum("fare").alias("total_fare")), f"{db}.zones")
    assert rows(totals) == [(1, 4.0), (2, 1.0)]
