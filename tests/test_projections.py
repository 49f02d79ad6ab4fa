import pytest
from pyspark.sql import functions as F

from tidewright import ColumnDefinition
from tidewright.operators import joins, projections as P
from tidewright.operators.aggregates import grouped_sum
from test_merge import rows


def test_select_text(spark):
    frame = spark.createDataFrame([(1, "a{2}"), (2, "aa")], "id int, s string")
    out = P.select_text(frame, "id, coalesce(s, 'x, y') AS t, regexp_like(s, 'a{2}') AS twice", also=["s"])
    assert rows(out) == [(1, "a{2}", False, "a{2}"), (2, "aa", True, "aa")]
    assert P.select_text(frame, "*") is frame and P.select_text(frame, None) is frame


def test_filter_clauses(spark):
    frame = spark.createDataFrame([(1, "a;b"), (2, "c"), (3, None)], "id int, s string")
    assert rows(P.where_clauses(frame, "id > 0; s = 'a;b';")) == [(1, "a;b")]
    assert rows(P.where_clauses(frame, "id > 1 OR id = 1", "s = 'c'")) == [(2, "c")]
    assert P.where_clauses(frame, None, "", " ; ") is frame


def test_strip_suffix(spark):
    frame = spark.createDataFrame([(1, 2, 3)], "t_utc int, a_utc_b int, _utc int")
    assert P.strip_suffix(frame).columns == ["t", "a_utc_b", "_utc"]
    with pytest.raises(ValueError, match="t"):
        P.strip_suffix(spark.createDataFrame([(1, 2)], "T int, t_utc int"))


def test_conform_and_audit(spark):
    frame = spark.createDataFrame([(1, "x", False)], "b int, a string, IS_ACTIVE boolean")
    out = P.conform(frame, [ColumnDefinition("a", "string"), ColumnDefinition("b", "int")])
    assert out.columns == ["a", "b"]
    filled = P.fill_audit(frame)
    assert filled.columns == ["b", "a", "IS_ACTIVE", "created_at", "updated_at"]
    assert filled.first()["IS_ACTIVE"] is False
    assert P.fill_audit(filled) is filled


def test_in_month_is_a_range_on_the_scan(spark, table):
    december = P.in_month(table(spark, "orders"), "o_orderdate", "1998-12")
    plan = spark._jvm.PythonSQLUtils.explainString(december._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(o_orderdate,1998-12-01T00:00)" in plan
    assert "LessThan(o_orderdate,1999-01-01T00:00)" in plan


def test_join_lookup(spark):
    zones = spark.createDataFrame([(1, "n"), (2, "s"), (None, "x")], "id int, zone string")
    shapes = spark.createDataFrame([(1, 0.5), (3, 0.1), (None, 0.2)], "id int, area double")
    assert rows(joins.join_lookup(zones, shapes, "id", "id", as_text=["area"])) == [(1, "n", "0.5")]


def test_active_sources(spark):
    landed = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "src string, v int")
    registry = spark.createDataFrame([("a", True), ("a", True), ("b", False), ("c", None)], "src string, is_active boolean")
    assert rows(joins.rows_of_active_sources(landed, registry, ["src"])) == [("a", 1)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_a_measured_small_side_is_broadcast(spark, monkeypatch):
    landed = spark.range(100).selectExpr("CAST(id % 3 AS STRING) AS src", "id")
    registry = spark.createDataFrame([("1", True), ("2", True)], "src string, is_active boolean")
    small = joins.rows_of_active_sources(landed, registry, ["src"])
    assert "BroadcastHashJoin" in plan_of(small) and small.count() == 66
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
    large = joins.rows_of_active_sources(landed, registry, ["src"])
    assert "SortMergeJoin" in plan_of(large) and large.count() == 66
    monkeypatch.undo()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1b")
    try:
        assert "SortMergeJoin" in plan_of(joins.rows_of_active_sources(landed, registry, ["src"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_size_settings():
    assert [joins.size_in_bytes(t) for t in ("-1", "10485760b", "10MB", "2g", "1k", "1t", "7", " 1PB ")] == [
        -1, 10485760, 10485760, 2 << 30, 1024, 1 << 40, 7, 1 << 50,
    ]


def test_grouped_sum(spark):
    frame = spark.range(1000).select(F.lit("k").alias("k"), F.lit(0.1).alias("v"))
    assert abs(grouped_sum(frame, "k", "v", "total").first()["total"] - 100) < 1e-9
    assert float(grouped_sum(frame, "k", "v", "total", exact=(18, 2)).first()["total"]) == 100.0
    small = frame.withColumn("v", F.lit(0.004))
    assert abs(grouped_sum(small, "k", "v", "total").first()["total"] - 4) < 1e-9
    assert grouped_sum(frame.withColumn("v", F.lit(1e17)), "k", "v", "total").first()["total"] == 1e20


def test_clauses_end_outside_quotes(spark):
    frame = spark.createDataFrame([("a;b", 1), ("a", 2), ("it's; x", 3)], "v string, `k;2` int")
    keep = lambda *texts: [r[1] for r in P.where_clauses(frame, *texts).collect()]
    assert keep("v = 'a;b'; `k;2` > 0") == [1]
    assert keep('v = "a;b"; `k;2` > 0', None) == [1]
    assert keep(r"v = 'it\'s; x' ; ") == [3]
    assert keep("; ;") == [1, 2, 3]


def test_no_lookup_row_travels_to_be_measured(spark):
    """Only sums, one row for each task, go to the single task of the measure."""
    lookup = spark.range(0, 1000, 1, 40)
    size = F.octet_length(F.to_json(F.struct("*")))
    plan = lookup.agg(F.count("*"), F.sum(size))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("SinglePartition") and "Limit" not in plan
