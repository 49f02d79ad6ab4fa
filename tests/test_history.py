import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewright import ColumnDefinition, TableDefinition, insert_or_update_table
from tidewright.plans.history import upsert_history
from tidewright.plans.migrate import migrate_table, widens
from tidewright.sources.tables import append_once
from pyspark.sql.types import _parse_datatype_string as parsed
from test_merge import rows

SCHEMA = "k int, v string, w int, at int"


def definition(db, name="h"):
    columns = [ColumnDefinition("k", "bigint", False), ColumnDefinition("v", "string"), ColumnDefinition("w", "int")]
    return TableDefinition(
        f"{db}.{name}", columns, key_columns=["k"], include_create_and_update=False, include_valid_from_valid_to=True
    )


def changes(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA).withColumn("at", F.timestamp_seconds("at"))


def versions(spark, name):
    at = [F.unix_seconds(c).alias(c) for c in ("valid_from", "valid_to")]
    return rows(spark.table(name).select("k", "v", "w", *at, "is_active"))


def brute(data, repeats=False):
    """The history of changes that are given in the order of their arrival."""
    said = {}
    for k, v, w, at in data:
        said.setdefault(k, {})[at] = (v, w)
    out = []
    for k, at_times in said.items():
        kept = []
        for at, values in sorted(at_times.items()):
            if repeats or not kept or kept[-1][1] != values:
                kept.append((at, values))
        ends = [at for at, _ in kept[1:]] + [None]
        out += [(k, *values, at, end, end is None) for (at, values), end in zip(kept, ends)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("buckets", [None, 4])
def test_intervals_close_and_open(spark, db, buckets):
    d, table = definition(db), f"{db}.h"
    first = [(1, "a", 1, 10), (1, "a", 1, 20), (1, "b", None, 30), (2, None, None, 10)]
    assert upsert_history(changes(spark, *first), d, as_of="at", key_buckets=buckets) == 4
    assert versions(spark, table) == brute(first)
    upsert_history(changes(spark, *first), d, as_of="at", key_buckets=buckets)
    assert versions(spark, table) == brute(first)
    more = [(1, "b", None, 40), (1, "b", 0, 50), (2, None, 1, 40), (3, "new", 1, 5)]
    upsert_history(changes(spark, *more), d, as_of="at", key_buckets=buckets)
    assert versions(spark, table) == brute(first + more)
    late = [(1, "between", 9, 25), (2, "corrected", 2, 10), (3, "earlier", 1, 1)]
    upsert_history(changes(spark, *late), d, as_of="at", key_buckets=buckets)
    assert versions(spark, table) == brute(first + more + late)
    assert upsert_history(changes(spark), d, as_of="at") == 0


def test_any_order_gives_the_same_rows_with_repeats(spark, db):
    rng, d = random.Random(2), definition(db)
    said = [(k, rng.choice("ab"), None, at) for k in range(4) for at in rng.sample(range(100), 12)]
    arriving = rng.sample(said, len(said))
    for part in (arriving[:15], arriving[15:40], arriving[40:]):
        upsert_history(changes(spark, *part), d, as_of="at", key_buckets=3, repeats=True)
    assert versions(spark, f"{db}.h") == brute(said, repeats=True)


def test_untouched_buckets_stay(spark, db):
    d = definition(db)
    upsert_history(spark.range(100).selectExpr("id AS k", "'a' AS v", "1 AS w", "timestamp_seconds(1) AS at"), d, as_of="at", key_buckets=8)
    before = set(spark.table(f"{db}.h").inputFiles())
    upsert_history(changes(spark, (5, "b", 1, 9)), d, as_of="at")
    kept = before & set(spark.table(f"{db}.h").inputFiles())
    assert len(kept) == len(before) - 1


def test_refusals(spark, db):
    with pytest.raises(ValueError, match="valid_from"):
        upsert_history(changes(spark), TableDefinition(f"{db}.x", [ColumnDefinition("k", "int")], key_columns=["k"]), as_of="at")
    for bad in [(None, "a", 1, 1), (1, "a", 1, None)]:
        with pytest.raises(ValueError, match="1 changes"):
            upsert_history(changes(spark, bad, (2, "a", 1, 1)), definition(db), as_of="at")
    with pytest.raises(ValueError, match="not found"):
        upsert_history(changes(spark).drop("k"), definition(db), as_of="at")


def test_microseconds_make_versions(spark, db):
    """Times are told apart to their last digit, zone-less ones too."""
    d = TableDefinition(
        f"{db}.h", [ColumnDefinition("k", "int"), ColumnDefinition("n", "timestamp_ntz"), ColumnDefinition("x", "double")],
        key_columns=["k"], include_create_and_update=False, include_valid_from_valid_to=True,
    )
    sql = "SELECT 1 AS k, TIMESTAMP_NTZ'2024-01-01 00:00:00.00000{0}' AS n, CAST('NaN' AS double) AS x, timestamp_seconds({0}) AS valid_from"
    for i in (1, 2):
        upsert_history(spark.sql(sql.format(i)), d, as_of="valid_from")
    assert [r.n for r in spark.table(f"{db}.h").orderBy("n").collect()] == [datetime(2024, 1, 1, 0, 0, 0, i) for i in (1, 2)]


def test_append_once(spark, db):
    name = f"{db}.t"
    frame = lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    append_once(frame(1, 2, 3), name, "w", 1)
    append_once(frame(1, 2), name, "w", 1)  # repeated with what it should have written
    append_once(frame(2), name, "w", 2)
    append_once(frame(2), name, "x", 1)
    assert sorted(r.v for r in spark.table(name).collect()) == [1, 2, 2, 2]
    with pytest.raises(ValueError, match="unknown"):
        append_once(frame(1).withColumn("u", F.lit(1)), name, "w", 3)
    append_once(frame(9).withColumn("u", F.lit(1)), name, "w", 3, schema_evolution=True)
    assert spark.table(name).where("u = 1").select("v", "append_id").collect() == [(9, "w-000000000003")]
    insert_or_update_table(frame(1), f"{db}.plain", append_only=True)
    with pytest.raises(ValueError, match="append_id"):
        append_once(frame(1), f"{db}.plain", "w", 1)


@pytest.mark.parametrize(
    "old, new, fits",
    [
        ("int", "bigint", True), ("bigint", "int", False), ("int", "double", True), ("bigint", "double", False),
        ("float", "double", True), ("int", "decimal(10,0)", True), ("bigint", "decimal(10,0)", False),
        ("decimal(5,2)", "decimal(7,3)", True), ("decimal(5,2)", "decimal(5,3)", False), ("date", "timestamp_ntz", True),
        ("string", "int", False), ("int", "string", False),
    ],
)
def test_widens(spark, old, new, fits):
    assert widens(parsed(old), parsed(new)) is fits


def versioned(db, version, *columns, name="m"):
    columns = [ColumnDefinition(n, t, comment=c) for n, t, c in columns]
    return TableDefinition(f"{db}.{name}", columns, version=version, include_is_active=False, include_create_and_update=False)


@pytest.mark.parametrize("layout", ["plain", "partitioned", "buckets"])
def test_migration_keeps_layout_rows_and_properties(spark, db, layout):
    name = f"{db}.m"
    options = {"partitioned": {"partition_by": ["p"]}, "buckets": {"key_buckets": 4}}.get(layout, {})
    first = spark.createDataFrame([(1, 1.5, "x"), (2, None, None)], "k int, v float, p string")
    insert_or_update_table(first, name, key_columns=["k"], **options)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('owner_team' = 'a')")
    d = versioned(db, "2.0.0", ("k", "bigint", "the key"), ("v", "double", None), ("p", "string", "where"), ("n", "int", None))
    done = migrate_table(d)
    assert (done.added, done.widened) == (["n"], ["k", "v"])
    assert rows(spark.table(done.replaced_table).select("k", "v", "p")) == rows(first)
    insert_or_update_table(
        spark.createDataFrame([(1, 9.25, "x"), (2**40, 1e300, "y")], "k bigint, v double, p string"), name, key_columns=["k"]
    )
    table = spark.table(name)
    assert rows(table.select("k", "v", "p", "n")) == sorted(
        [(1, 9.25, "x", None), (2, None, None, None), (2**40, 1e300, "y", None)], key=repr
    )
    assert table.schema["k"].metadata["comment"] == "the key" and table.schema["p"].metadata["comment"] == "where"
    assert d.catalog_version() == "2.0.0"
    props = spark.sql(f"SHOW TBLPROPERTIES {name}").where("key = 'owner_team'").collect()
    assert props[0]["value"] == "a"
    again = migrate_table(d)
    assert (again.added, again.widened, again.commented, again.replaced_table) == ([], [], [], None)


def test_migration_refusals_and_lost_runs(spark, db):
    one = versioned(db, "1.0.0", ("k", "bigint", None))
    assert migrate_table(one).added == ["k"]
    with pytest.raises(ValueError, match="wider"):
        migrate_table(versioned(db, "2.0.0", ("k", "int", None)))
    assert one.catalog_version() == "1.0.0"
    insert_or_update_table(spark.range(3).toDF("k"), f"{db}.m", append_only=True)
    two = versioned(db, "2.0.0", ("k", "decimal(20,0)", None))
    # Lost between the two changes of names.
    migrate_table(two)
    spark.sql(f"ALTER TABLE {db}.m RENAME TO {db}.m__migrated")
    assert migrate_table(two).widened == [] and spark.table(f"{db}.m").count() == 3
    with pytest.raises(ValueError, match="above"):
        migrate_table(versioned(db, "1.5.0", ("k", "decimal(20,0)", None)))
    # A staged table of a run that was lost before is made anew.
    spark.sql(f"CREATE TABLE {db}.m__migrated (x int) USING parquet")
    migrate_table(versioned(db, "3.0.0", ("k", "decimal(22,0)", None)))
    assert spark.table(f"{db}.m").count() == 3
