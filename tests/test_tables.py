import pytest
from pyspark.sql import functions as F

from tidewright import (
    ColumnDefinition,
    TableCreationError,
    TableDefinition,
    add_missing_columns_to_table,
    create_table_if_not_exists,
    insert_or_update_process_table,
    insert_or_update_table,
)
from tidewright.sources import tables
from test_merge import rows

SCHEMA = "k int, v string, created_at int"


def frame(spark, *data, schema=SCHEMA):
    return spark.createDataFrame(list(data), schema)


def test_create_once(spark, db):
    schema = frame(spark).schema
    assert create_table_if_not_exists(f"{db}.t", schema) is True
    assert create_table_if_not_exists(f"{db}.t", schema) is False
    with pytest.raises(TableCreationError, match="k:int"):
        create_table_if_not_exists("no_such_db.t", schema)


def test_append_matches_by_name_and_evolves(spark, db):
    name = f"{db}.t"
    insert_or_update_table(frame(spark, (1, "a", 10)), name, append_only=True)
    insert_or_update_table(frame(spark, ("b", 2), schema="v string, k int"), name, append_only=True)
    more = frame(spark, (3, True), schema="k int, w boolean")
    with pytest.raises(ValueError, match="w"):
        insert_or_update_table(more, name, append_only=True)
    insert_or_update_table(more, name, append_only=True, schema_evolution=True)
    assert spark.table(name).columns == ["k", "v", "created_at", "w"]
    assert rows(spark.table(name)) == [
        (1, "a", 10, None), (2, "b", None, None), (3, None, None, True),
    ]


def test_add_missing_columns(spark, db):
    assert add_missing_columns_to_table(f"{db}.none", frame(spark).schema) == []
    create_table_if_not_exists(f"{db}.t", frame(spark, schema="K int").schema)
    wanted = frame(spark, schema="updated_at timestamp, `odd name` int, k int, is_active boolean, z string").schema
    assert add_missing_columns_to_table(f"{db}.t", wanted) == ["odd name", "z", "updated_at", "is_active"]
    assert add_missing_columns_to_table(f"{db}.t", wanted) == []


def test_failed_evolution_raises(spark, db):
    spark.sql(f"CREATE VIEW {db}.v AS SELECT 1 AS k")
    with pytest.raises(Exception):
        add_missing_columns_to_table(f"{db}.v", frame(spark, schema="k int, z int").schema)


def test_upsert_arguments(spark, db):
    data = frame(spark, (1, "a", 10))
    for options in [{}, {"key_columns": []}, {"append_only": True, "force_remove_duplicates": True}]:
        with pytest.raises(ValueError, match="key_columns"):
            insert_or_update_table(data, f"{db}.t", **options)
    assert not spark.catalog.tableExists(f"{db}.t")


@pytest.mark.parametrize("partition_by", [[], ["v"]])
def test_upsert_twice(spark, db, partition_by):
    name = f"{db}.t"
    first = frame(spark, (1, "a", 10), (2, "b", 20), (None, "n", 0))
    insert_or_update_table(first, name, key_columns=["k"], partition_by=partition_by)
    second = frame(spark, (2, None, 99), (3, "c", 99), (None, "m", 99))
    insert_or_update_table(second, name, key_columns=["k"])
    by_name = spark.table(name).select("k", "v", "created_at")
    expected = [(1, "a", 10), (2, None, 20), (3, "c", 99), (None, "m", 99), (None, "n", 0)]
    assert rows(by_name) == sorted(expected, key=repr)
    # Once more, without the row whose NULL key makes it new every time.
    insert_or_update_table(second.where("k IS NOT NULL"), name, key_columns=["k"])
    assert rows(spark.table(name).select("k", "v", "created_at")) == sorted(expected, key=repr)


def test_upsert_into_emptied_and_untouched_partitions(spark, db):
    name = f"{db}.t"
    insert_or_update_table(
        frame(spark, (1, "it's", 1), (2, "b", 1), (3, "c/d", 1)), name, key_columns=["k"], partition_by=["v"]
    )
    untouched = [f for f in spark.table(name).inputFiles() if "v=b" in f]
    insert_or_update_table(frame(spark, (1, "new", 2), (3, "c/d", 2)), name, key_columns=["k"])
    assert rows(spark.table(name).select("k", "v", "created_at")) == [(1, "new", 1), (2, "b", 1), (3, "c/d", 1)]
    assert [f for f in spark.table(name).inputFiles() if "v=b" in f] == untouched
    parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    assert parts == {"v=new", "v=b", "v=c%2Fd"}


def test_table_options_survive_an_upsert(spark, db):
    name = f"{db}.t"
    spark.sql(f"CREATE TABLE {name} (k INT, v STRING) USING csv OPTIONS (sep '|', header 'true')")
    insert_or_update_table(frame(spark, (1, "a"), (2, "b"), schema="k int, v string"), name, append_only=True)
    for _ in range(2):
        insert_or_update_table(frame(spark, (2, "z"), schema="k int, v string"), name, key_columns=["k"])
        assert rows(spark.table(name)) == [(1, "a"), (2, "z")]
    spark.sql(f"CREATE TABLE {db}.u (k INT, v STRING) USING parquet OPTIONS (compression 'zstd')")
    insert_or_update_table(frame(spark, (1, "a"), schema="k int, v string"), f"{db}.u", append_only=True)
    insert_or_update_table(frame(spark, (1, "b"), schema="k int, v string"), f"{db}.u", key_columns=["k"])
    assert all("zstd" in f for f in spark.table(f"{db}.u").inputFiles())
    assert not [t.name for t in spark.catalog.listTables(db) if "next_version" in t.name]


def test_thousands_of_touched_partitions_make_a_shallow_predicate(spark):
    from pyspark.sql import Row

    day = Row("y", "m", "d")
    values = [day(y, m, d) for y in range(2000, 2028) for m in range(1, 13) for d in range(1, 31)]
    values += [day(None, 1, 1), day(2000, None, 1), day(2000, 1, None)]
    frame_ = spark.createDataFrame([(2001, 5, 6), (1999, 1, 1), (None, 1, 1), (2000, 1, None), (2001, None, 1)], "y int, m int, d int")
    assert rows(frame_.where(tables._in_partitions(values))) == sorted([(2001, 5, 6), (None, 1, 1), (2000, 1, None)], key=repr)


def test_null_keys_survive_de_duplication(spark, db):
    twice = frame(spark, (None, "a", 1), (None, "a", 1), (1, "b", 1), (1, "b", 2))
    insert_or_update_table(twice, f"{db}.t", key_columns=["k"], force_remove_duplicates=True, order_by=[F.desc("created_at")])
    assert rows(spark.table(f"{db}.t").select("k", "created_at")) == sorted([(None, 1), (None, 1), (1, 2)], key=repr)


def test_gate(spark, db):
    rules = TableDefinition(f"{db}.t", [ColumnDefinition("k", "int", False), ColumnDefinition("v", "string")])
    insert_or_update_table(frame(spark, (1, "a", 1)), f"{db}.t", append_only=True, gate=rules)
    for bad, why in [
        (frame(spark, (None, "a", 1)), "k_not_null: 1 rows"),
        (frame(spark, (1,), schema="k int"), "missing"),
        (frame(spark, ("1", "a"), schema="k string, v string"), "k is string"),
    ]:
        with pytest.raises(ValueError, match=why):
            insert_or_update_table(bad, f"{db}.t", append_only=True, gate=rules)
    assert spark.table(f"{db}.t").count() == 1


def test_an_upsert_rewrites_one_partition(spark, db):
    data = spark.range(100).selectExpr("id AS k", "id % 10 AS p", "'a' AS v")
    insert_or_update_table(data, f"{db}.t", append_only=True, partition_by=["p"])
    before = set(spark.table(f"{db}.t").inputFiles())
    insert_or_update_table(data.where("k = 13").withColumn("v", F.lit("z")), f"{db}.t", key_columns=["k"])
    gone = before - set(spark.table(f"{db}.t").inputFiles())
    assert gone and all("p=3" in f for f in gone)


def test_two_partition_columns(spark, db):
    name, schema = f"{db}.t", "k int, v string, p int, q string"
    insert_or_update_table(
        frame(spark, (1, "a", 1, "x"), (2, "b", None, "y"), (3, "c", 3, None), schema=schema),
        name, key_columns=["k"], partition_by=["p", "q"],
    )
    insert_or_update_table(
        frame(spark, (2, "B", 1, "x"), (3, "C", 3, None), (4, "D", None, None), schema=schema),
        name, key_columns=["k"],
    )
    assert rows(spark.table(name).select("k", "v", "p", "q")) == [
        (1, "a", 1, "x"), (2, "B", 1, "x"), (3, "C", 3, None), (4, "D", None, None),
    ]


def test_partition_column_absent_from_the_source(spark, db):
    name, schema = f"{db}.t", "k int, v string, p string"
    insert_or_update_table(
        frame(spark, (1, "a", "x"), (2, "b", "y"), schema=schema), name, key_columns=["k"], partition_by=["p"]
    )
    insert_or_update_table(frame(spark, (1, "A"), (3, "C"), schema="k int, v string"), name, key_columns=["k"])
    assert rows(spark.table(name)) == [(1, "A", "x"), (2, "b", "y"), (3, "C", None)]


def test_append_writes_few_files_per_partition(spark, db):
    data = spark.range(0, 1000, 1, 8).selectExpr("id", "CAST(id % 3 AS STRING) AS p")
    insert_or_update_table(data, f"{db}.t", append_only=True, partition_by=["p"])
    assert len(spark.table(f"{db}.t").inputFiles()) == 3


def test_several_source_rows_for_one_key(spark, db):
    twice = frame(spark, (1, "a", 1), (1, "b", 1), (2, "c", 1))
    with pytest.raises(ValueError, match="Several source rows"):
        insert_or_update_table(twice, f"{db}.t", key_columns=["k"])
    insert_or_update_table(twice, f"{db}.t", key_columns=["k"], force_remove_duplicates=True)
    assert rows(spark.table(f"{db}.t").select("k")) == [(1,), (2,)]


def test_upsert_evolves(spark, db):
    name = f"{db}.t"
    insert_or_update_table(frame(spark, (1, "a", 10), (2, "b", 10)), name, key_columns=["k"])
    more = frame(spark, (2, 5), schema="k int, w int")
    with pytest.raises(ValueError, match="w"):
        insert_or_update_table(more, name, key_columns=["k"])
    insert_or_update_table(more, name, key_columns=["k"], schema_evolution=True)
    assert rows(spark.table(name)) == [(1, "a", 10, None), (2, "b", 10, 5)]


def test_publish_keeps_the_replaced_version(spark, db):
    name = f"{db}.t"
    insert_or_update_table(frame(spark, (1, "a", 10)), name, key_columns=["k"])
    before = spark.table(name)
    result = insert_or_update_table(frame(spark, (1, "z", 10)), name, key_columns=["k"])
    assert result.source_rows == 1
    assert rows(spark.read.parquet(result.replaced_location)) == [(1, "a", 10)]
    assert rows(before) == [(1, "a", 10)]
    assert rows(spark.table(name)) == [(1, "z", 10)]
    assert tables.table_details(name).location != result.replaced_location


def test_table_details(spark, db):
    spark.sql(f"CREATE TABLE {db}.t (a INT COMMENT '# odd', p DATE, `q r` STRING) USING ORC PARTITIONED BY (p, `q r`)")
    details = tables.table_details(f"{db}.t")
    assert (details.provider, details.partition_columns) == ("orc", ["p", "q r"])
    assert details.location.endswith(f"{db}.db/t")
    create_table_if_not_exists(f"{db}.u", frame(spark).schema)
    assert tables.table_details(f"{db}.u").partition_columns == []


def test_failed_upsert_leaves_the_table(spark, db):
    name = f"{db}.t"
    insert_or_update_table(frame(spark, (1, "a", 10)), name, key_columns=["k"])
    broken = frame(spark, (1, "a", 10)).withColumn("v", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        insert_or_update_table(broken, name, key_columns=["k"])
    assert rows(spark.table(name)) == [(1, "a", 10)]


def test_empty_source(spark, db):
    result = insert_or_update_table(frame(spark), f"{db}.t", key_columns=["k"])
    assert result.source_rows == 0 and spark.table(f"{db}.t").count() == 0


def test_registered_source_twice(spark, db):
    name, schema = f"{db}.src", "source_system string, stg_table string, volume string"
    keys = ["source_system", "stg_table"]
    row = frame(spark, ("s", "t", "/a"), schema=schema)
    insert_or_update_process_table(name, row, keys)
    first = spark.table(name).first()
    spark_row = spark.table(name).drop("updated_at").withColumn("is_active", F.lit(False))
    insert_or_update_process_table(name, spark_row, keys)
    assert spark.table(name).first()["is_active"] is False
    doubled = row.unionByName(row)
    insert_or_update_process_table(name, doubled, keys, force_remove_duplicates=True)
    last = spark.table(name).collect()
    assert len(last) == 1 and last[0]["is_active"] is True
    assert last[0]["created_at"] == first["created_at"]
    assert last[0]["updated_at"] > first["updated_at"]
