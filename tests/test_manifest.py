import os

import pytest
from pyspark.sql import functions as F

from tidewright.settings import LOAD_ID
from tidewright.sources import manifest
from tidewright.sources.manifest import load_by_manifest


class Landing:
    """A folder of csv files with a table and a manifest."""

    def __init__(self, db, tmp_path):
        self.folder, self.table, self.manifest = tmp_path / "land ing", f"{db}.t", f"{db}.files"
        self.folder.mkdir()
        self.clock = 1_700_000_000

    def put(self, name, *lines, at=None):
        path = self.folder / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("".join(f"{line}\n" for line in lines))
        self.clock += 10
        os.utime(path, (at or self.clock, at or self.clock))

    def load(self, **options):
        return load_by_manifest(str(self.folder), self.table, self.manifest, file_format="csv", schema="k int, v string", **options)

    def rows(self, spark):
        return sorted((r.source_file_name, r.k, r.v) for r in spark.table(self.table).collect())


@pytest.fixture
def landing(db, tmp_path):
    return Landing(db, tmp_path)


def test_new_repeated_and_changed_files(spark, landing):
    landing.put("a.csv", "1,a", "2,b")
    landing.put("b.csv", "3,c")
    done = landing.load()
    assert (done.new_files, done.changed_files, done.rows) == (2, 0, 3)
    again = landing.load()
    assert (again.load_id, again.rows) == (None, 0)
    landing.put("a.csv", "1,z")
    landing.put("c d.csv", "4,d")
    done = landing.load()
    assert (done.new_files, done.changed_files, done.rows) == (1, 1, 2)
    assert landing.rows(spark) == [("a.csv", 1, "z"), ("b.csv", 3, "c"), ("c%20d.csv", 4, "d")]
    assert spark.table(landing.manifest).groupBy("path").count().where("count > 1").isEmpty()
    assert landing.load().load_id is None


def test_all_files_changed_leave_no_old_partition(spark, landing):
    landing.put("a.csv", "1,a")
    landing.load()
    landing.put("a.csv", "1,b")
    done = landing.load()
    assert landing.rows(spark) == [("a.csv", 1, "b")]
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {landing.table}").collect()] == [f"{LOAD_ID}={done.load_id}"]


def test_old_file_with_an_old_time_is_seen(spark, landing):
    """A file that is copied with its old time is new, and one of equal time and other size has changed."""
    landing.put("a.csv", "1,a", at=1_000)
    landing.load()
    landing.put("old.csv", "2,b", at=500)
    landing.put("a.csv", "1,a", "9,more", at=1_000)
    done = landing.load()
    assert (done.new_files, done.changed_files, done.rows) == (1, 1, 3)
    assert landing.rows(spark) == [("a.csv", 1, "a"), ("a.csv", 9, "more"), ("old.csv", 2, "b")]


def test_empty_folder_empty_file_and_vanished_file(spark, landing):
    assert landing.load().load_id is None
    landing.put("a.csv", "1,a")
    landing.put("empty.csv")
    done = landing.load()
    assert (done.new_files, done.rows) == (1, 1)  # a file without a byte is not listed
    (landing.folder / "a.csv").unlink()
    assert landing.load().load_id is None
    assert landing.rows(spark) == [("a.csv", 1, "a")]


def _stop(*args, **kwargs):
    raise RuntimeError("lost")


@pytest.mark.parametrize("lost_in", ["manifest entries", "taking out", "entries of former files"])
def test_what_a_lost_driver_left_is_put_right(spark, landing, monkeypatch, lost_in):
    landing.put("a.csv", "1,a")
    landing.put("b.csv", "2,b")
    landing.load()
    landing.put("a.csv", "1,new")
    landing.put("c.csv", "3,c")
    with monkeypatch.context() as m:
        if lost_in == "manifest entries":
            write = manifest.overwrite_partition
            m.setattr(manifest, "overwrite_partition", lambda rows, name, *a: _stop() if name == landing.manifest else write(rows, name, *a))
        elif lost_in == "taking out":
            m.setattr(manifest, "replace_partitions", _stop)
        else:
            replace = manifest.replace_partitions
            m.setattr(manifest, "replace_partitions", lambda rows, name, *a: _stop() if name == landing.manifest else replace(rows, name, *a))
        with pytest.raises(RuntimeError, match="lost"):
            landing.load()
    landing.load()
    assert landing.rows(spark) == [("a.csv", 1, "new"), ("b.csv", 2, "b"), ("c.csv", 3, "c")]
    assert spark.table(landing.manifest).count() == 3
    assert landing.load().load_id is None


def test_only_files_of_the_range_are_scanned(spark, landing):
    """The times of the pending files reach the scan, which then lists these files alone."""
    landing.put("a.csv", "1,a", at=1_000)
    landing.put("b.csv", "2,b", at=2_000)
    pending = manifest.listed_files(spark, str(landing.folder)).where("path LIKE '%b.csv'")
    facts = pending.agg(F.min("modified").alias("first"), F.max("modified").alias("last")).first()
    rows = manifest._rows_of(spark, str(landing.folder), pending, facts, "csv", "k int, v string", None)
    assert [r.k for r in rows.collect()] == [2]
    scan = rows._jdf.queryExecution().executedPlan().toString()
    assert "file_modification_time" in scan
    content = manifest.listed_files(spark, str(landing.folder))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in content.split("ReadSchema")[-1]


def test_loads_of_others_into_the_same_table_stay(spark, db, tmp_path, landing):
    """Those of another manifest, and those that no manifest names."""
    landing.put("a.csv", "1,a")
    landing.load()
    (tmp_path / "2").mkdir()
    other = Landing(db, tmp_path / "2")
    other.manifest = f"{db}.other_files"
    other.put("b.csv", "2,b")
    other.load()
    rows = spark.table(landing.table).drop(LOAD_ID).limit(1)
    rows = spark.createDataFrame(rows.collect(), rows.schema).withColumn("k", F.lit(9))
    manifest.overwrite_partition(rows, landing.table, LOAD_ID, "stream-00000000")
    for each in (landing, other, landing):
        each.load()
    assert sorted(r.k for r in spark.table(landing.table).collect()) == [1, 2, 9]


def test_transform_log_and_recursive_folders(spark, landing, db):
    landing.put("x/a.csv", "1,a", "2,b")
    done = landing.load(
        options={"recursiveFileLookup": "true"}, log_table=f"{db}.log", transform=lambda rows: rows.where("k > 1")
    )
    assert done.rows == 1
    log = spark.table(f"{db}.log").select("records_processed", "message").collect()
    assert sorted(tuple(r) for r in log) == [(1, "1 new files, 1 rows."), (1, "File a.csv")]


def test_load_that_was_not_logged_is_logged_by_the_next(spark, landing, db, monkeypatch):
    landing.put("a.csv", "1,a")
    with monkeypatch.context() as m:
        m.setattr(manifest, "log_load", _stop)
        with pytest.raises(RuntimeError, match="lost"):
            landing.load(log_table=f"{db}.log")
    landing.put("b.csv", "2,b", "3,c")
    assert landing.load(log_table=f"{db}.log").rows == 2
    landing.load(log_table=f"{db}.log")
    log = spark.table(f"{db}.log").where("end_time IS NOT NULL").collect()
    assert sorted(r.records_processed for r in log) == [0, 1, 2]
