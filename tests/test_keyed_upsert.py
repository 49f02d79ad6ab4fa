import pathlib

import pytest
from pyspark.sql import functions as F

from tidewright import insert_or_update_table
from tidewright.operators.merge import merged
from tidewright.sources.files import scan_stream
from tidewright.streaming import keyed_upsert as stream
from test_merge import rows

SCHEMA = "k int, v string, at int"


def frame(spark, *data, schema=SCHEMA):
    return spark.createDataFrame(list(data), schema)


class Landed:
    """A stream over a folder, upserted into one table."""

    def __init__(self, spark, db, tmp_path, **options):
        self.spark, self.name, self.options = spark, f"{db}.t", {"newest_by": ["at"], **options}
        self.landing, self.checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")

    def land(self, *data):
        frame(self.spark, *data).coalesce(1).write.mode("append").parquet(self.landing)

    def run(self):
        source = scan_stream(self.spark, self.landing, frame(self.spark).schema)
        return stream.upsert_stream(source, self.name, ["k"], self.checkpoint, **self.options)

    def forget(self, name):
        """As if the driver was lost before Spark noted the batch as done."""
        commits = pathlib.Path(self.checkpoint) / "commits"
        n = str(int(name.rsplit("-", 1)[1]))
        for file in (commits / n, commits / f".{n}.crc"):
            file.unlink(missing_ok=True)

    def unmark(self, name):
        """As if it was lost between the rows and their mark."""
        stream_id = name.rsplit("-", 1)[0]
        self.spark.sql(f"ALTER TABLE {self.name} UNSET TBLPROPERTIES ('applied_batch.{stream_id}')")

    def result(self):
        return rows(self.spark.table(self.name).select("k", "v", "at"))


@pytest.mark.parametrize("buckets", [None, 4])
def test_last_row_of_a_key_counts(spark, db, tmp_path, buckets):
    landed = Landed(spark, db, tmp_path, key_buckets=buckets)
    landed.land((1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "d", 5))
    first = landed.run()
    landed.land((1, "late", 2), (2, "e", 5), (3, "f", None))
    second = landed.run()
    landed.land((3, "g", None), (2, None, 6))
    landed.run()
    assert landed.result() == rows(frame(spark, (1, "b", 3), (2, None, 6), (3, "g", None)))
    assert landed.run() == []
    written = {r.k: r.applied_batch for r in spark.table(landed.name).collect()}
    assert written[1] == first[0] and written[2] > second[0] > first[0]


@pytest.mark.parametrize("buckets", [None, 4])
@pytest.mark.parametrize("marked", [True, False])
def test_replayed_batch_changes_nothing(spark, db, tmp_path, buckets, marked):
    """Rows without a key are there once, too, whether or not the mark was set."""
    landed = Landed(spark, db, tmp_path, key_buckets=buckets)
    landed.land((1, "a", 1), (None, "n", 1), (None, "n", 1))
    landed.run()
    landed.land((1, "b", 2), (2, "c", 1), (None, "m", 2))
    [name] = landed.run()
    before = rows(spark.table(landed.name))
    landed.forget(name)
    if not marked:
        landed.unmark(name)
    assert landed.run() == [name]
    assert rows(spark.table(landed.name)) == before
    assert stream.last_applied(spark, landed.name, name.rsplit("-", 1)[0]) == name


def test_two_streams_into_one_table(spark, db, tmp_path):
    one, two = Landed(spark, db, tmp_path / "1"), Landed(spark, db, tmp_path / "2")
    one.land((1, "a", 1), (2, "a", 9))
    one.run()
    two.land((1, "b", 2), (2, "b", 2))
    two.run()
    assert one.result() == rows(frame(spark, (1, "b", 2), (2, "a", 9)))


def test_existing_table_and_refusals(spark, db, tmp_path):
    landed = Landed(spark, db, tmp_path)
    insert_or_update_table(frame(spark, (1, "old", 0), (5, "stays", 0)), landed.name, append_only=True)
    landed.land((1, "new", 1))
    landed.run()
    assert landed.result() == rows(frame(spark, (1, "new", 1), (5, "stays", 0)))
    with pytest.raises(ValueError, match="newest_by"):
        stream.apply_batch(frame(spark, (1, "v", 1)), "other-00000000", landed.name, ["k"], newest_by=[])
    insert_or_update_table(frame(spark, (1, "old", 0)), f"{db}.p", append_only=True, partition_by=["v"])
    with pytest.raises(ValueError, match="key buckets"):
        stream.apply_batch(frame(spark, (1, "v", 1)), "other-00000000", f"{db}.p", ["k"], newest_by=["at"])
    assert spark.table(f"{db}.p").columns == ["k", "at", "v"]


def test_merge_by_several_columns(spark):
    schema = "k int, v string, a int, b int"
    target = frame(spark, (1, "t", 1, 5), (2, "t", 1, None), (3, "t", None, 9), (4, "t", 2, 2), schema=schema)
    source = frame(spark, (1, "s", 1, 4), (2, "s", 1, 0), (3, "s", None, 9), (4, "s", None, 9), (5, "s", None, None), schema=schema)
    after = merged(target, source, ["k"], ["a", "b"])
    assert sorted((r.k, r.v) for r in after.collect()) == [(1, "t"), (2, "s"), (3, "s"), (4, "t"), (5, "s")]


def test_upsert_of_late_rows_into_partitions(spark, db):
    name = f"{db}.t"
    insert_or_update_table(frame(spark, (1, "x", 5), (2, "x", 5)), name, key_columns=["k"], partition_by=["v"])
    insert_or_update_table(frame(spark, (1, "y", 4), (2, "y", 6)), name, key_columns=["k"], newest_by=["at"])
    assert rows(spark.table(name).select("k", "v", "at")) == rows(frame(spark, (1, "x", 5), (2, "y", 6)))
    assert spark.table(name).where(F.col("v") == "y").count() == 1
