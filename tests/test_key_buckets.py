import pytest
from pyspark.sql import functions as F

from tidewright import ColumnDefinition, TableDefinition, insert_or_update_table
from tidewright.sources import key_buckets as layout
from test_merge import rows

SCHEMA = "k bigint, g string, v string, created_at int"


def frame(spark, *data, schema=SCHEMA):
    return spark.createDataFrame(list(data), schema)


def plain(spark, name):
    return rows(spark.table(name).drop("key_bucket"))


def files(spark, name):
    """Of each bucket's folder its files."""
    found = {}
    for f in spark.table(name).inputFiles():
        folder, file = f.rsplit("/", 1)
        found.setdefault(folder.rsplit("/", 1)[1], set()).add(file)
    return found


def load(spark, name, n=200, buckets=16):
    first = spark.range(n).selectExpr("id AS k", "'g' AS g", "'old' AS v", "1 AS created_at")
    insert_or_update_table(first, name, key_columns=["k", "g"], key_buckets=buckets)


def test_one_changed_row_rewrites_one_bucket(spark, db):
    name = f"{db}.t"
    load(spark, name)
    before = files(spark, name)
    insert_or_update_table(frame(spark, (7, "g", "new", 9)), name, key_columns=["k", "g"])
    after = files(spark, name)
    assert set(before) == set(after) and len(before) == 16
    changed = [b for b in before if before[b] != after[b]]
    assert len(changed) == 1
    [row] = spark.table(name).where("k = 7").collect()
    assert (row.v, row.created_at, changed) == ("new", 1, [f"key_bucket={row.key_bucket}"])
    assert spark.table(name).count() == 200


def test_keys_of_other_types_hash_alike(spark, db):
    """A source's int or text key finds the bigint of the table."""
    name = f"{db}.t"
    load(spark, name, 20)
    insert_or_update_table(frame(spark, (3, "g", "int", 9), schema="k int, g string, v string, created_at int"), name, key_columns=["k", "g"])
    insert_or_update_table(frame(spark, ("4", "g", "text", 9), schema="k string, g string, v string, created_at int"), name, key_columns=["G", "K"])
    assert spark.table(name).where("v <> 'old'").select("k", "v").orderBy("k").collect() == [(3, "int"), (4, "text")]
    assert spark.table(name).count() == 20


def test_zeros_of_both_signs_are_one_key(spark, db):
    name, schema = f"{db}.t", "k double, v string"
    insert_or_update_table(frame(spark, (0.0, "a"), (float("nan"), "n"), schema=schema), name, key_columns=["k"], key_buckets=8)
    insert_or_update_table(frame(spark, (-0.0, "b"), (float("nan"), "m"), schema=schema), name, key_columns=["k"])
    assert sorted(r.v for r in spark.table(name).collect()) == ["b", "m"]


def test_rows_without_a_key_are_only_appended(spark, db):
    name = f"{db}.t"
    load(spark, name, 5, 4)
    for _ in range(2):
        insert_or_update_table(frame(spark, (None, "g", "x", 2), (1, None, "y", 2), (2, "g", "z", 2)), name, key_columns=["k", "g"])
    assert [r.v for r in spark.table(name).where("key_bucket = -1").orderBy("v").collect()] == ["x", "x", "y", "y"]
    assert spark.table(name).where("key_bucket <> -1").count() == 5


def test_append_partial_columns_and_evolution(spark, db):
    name = f"{db}.t"
    load(spark, name, 3, 4)
    insert_or_update_table(frame(spark, ("g", 9, "app"), schema="g string, k bigint, v string"), name, append_only=True)
    insert_or_update_table(
        frame(spark, (9, "g", True), schema="k bigint, g string, w boolean"), name, key_columns=["k", "g"], schema_evolution=True
    )
    assert spark.table(name).columns == ["k", "g", "v", "created_at", "w", "key_bucket"]
    assert spark.table(name).where("k = 9").drop("key_bucket").collect() == [(9, "g", "app", None, True)]
    # What was read from the table can be written to it.
    insert_or_update_table(spark.table(name).withColumn("v", F.lit("all")), name, key_columns=["k", "g"])
    assert {r.v for r in spark.table(name).collect()} == {"all"}


def test_refusals(spark, db):
    name = f"{db}.t"
    load(spark, name, 3, 4)
    with pytest.raises(ValueError, match="laid out by the key"):
        insert_or_update_table(frame(spark, (1, "g", "v", 1)), name, key_columns=["k"])
    with pytest.raises(ValueError, match="4 key buckets"):
        insert_or_update_table(frame(spark, (1, "g", "v", 1)), name, key_columns=["k", "g"], key_buckets=8)
    with pytest.raises(ValueError, match="no other partitions"):
        insert_or_update_table(frame(spark), f"{db}.u", key_columns=["k"], key_buckets=8, partition_by=["g"])
    with pytest.raises(ValueError, match="taken"):
        insert_or_update_table(frame(spark, schema="k int, Key_Bucket int"), f"{db}.u", key_columns=["k"], key_buckets=8)
    insert_or_update_table(frame(spark, (1, "g", "v", 1)), f"{db}.u", append_only=True)
    with pytest.raises(ValueError, match="without key buckets"):
        insert_or_update_table(frame(spark, (1, "g", "v", 1)), f"{db}.u", key_columns=["k"], key_buckets=8)
    with pytest.raises(ValueError, match="Several source rows"):
        insert_or_update_table(frame(spark, (1, "g", "v", 1), (1, "g", "w", 1)), name, key_columns=["k", "g"])
    assert spark.table(name).count() == 3


def test_empty_source_and_hot_bucket(spark, db):
    name = f"{db}.t"
    load(spark, name, 50, 1)
    insert_or_update_table(frame(spark), name, key_columns=["k", "g"])
    source = spark.range(40, 60).selectExpr("id AS k", "'g' AS g", "'new' AS v", "2 AS created_at")
    insert_or_update_table(source, name, key_columns=["k", "g"])
    assert spark.table(name).groupBy("v").count().orderBy("v").collect() == [("new", 20), ("old", 40)]


def test_layout_is_read_from_the_table(spark, db):
    name = f"{db}.t"
    load(spark, name, 3, 4)
    assert layout.layout_of(name) == layout.Layout(("k", "g"), 4)
    insert_or_update_table(frame(spark, (1, "g", "v", 1)), f"{db}.plain", append_only=True)
    assert layout.layout_of(f"{db}.plain") is None


GATE = TableDefinition("t", [ColumnDefinition("k", "bigint", False), ColumnDefinition("v", "double", min_value=0.5)])


def test_gate_counts_the_rows_that_are_written(spark, db):
    """A frame that is another at each evaluation cannot pass the gate and break the rule."""
    chance = "CAST(reflect('java.lang.Math', 'random') AS double) AS v"  # anew at each evaluation
    with pytest.raises(ValueError, match="v_min_check"):
        insert_or_update_table(spark.range(400).selectExpr("id AS k", chance), f"{db}.t", append_only=True, gate=GATE)
    assert not spark.catalog.tableExists(f"{db}.t")
    passed = 0
    for i in range(16):
        try:
            insert_or_update_table(spark.range(i, i + 1).selectExpr("id AS k", chance), f"{db}.t", append_only=True, gate=GATE)
            passed += 1
        except ValueError:
            pass
    assert 0 < passed < 16
    assert spark.table(f"{db}.t").where("v < 0.5").isEmpty() and spark.table(f"{db}.t").count() == passed


def test_gate_reads_its_input_once(spark, db, tmp_path):
    spark.range(100).selectExpr("id AS k", "1.0D AS v").write.parquet(str(tmp_path / "in"))
    evaluated = spark.sparkContext.accumulator(0)
    source = spark.read.parquet(str(tmp_path / "in"))

    def count(batches):
        for b in batches:
            evaluated.add(b.num_rows)
            yield b

    insert_or_update_table(source.mapInArrow(count, source.schema), f"{db}.t", key_columns=["k"], gate=GATE)
    assert evaluated.value == 100 and spark.table(f"{db}.t").count() == 100
