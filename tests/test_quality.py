import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewright import ColumnDefinition
from tidewright.operators import quality
from test_definition import plain

RULES = plain(
    ColumnDefinition("id", "int"),
    ColumnDefinition("v", "int", min_value=1, max_value=9),
    ColumnDefinition("w", "int", False, custom_condition="w % 2 = 0"),
    ColumnDefinition("absent", "int", False, min_value=1),
)


def test_null_fails_a_bounded_nullable_column(spark):
    rules = plain(ColumnDefinition("id", "int"), ColumnDefinition("v", "int", min_value=1))
    frame = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, v int")
    verdicts = {r["id"]: r["is_row_valid"] for r in rules.validate_dataframe(frame).collect()}
    assert verdicts == {1: True, 2: False, 3: False}


def test_without_rules_every_row_is_valid(spark):
    rules = plain(ColumnDefinition("id", "int"))
    frame = spark.createDataFrame([(1,), (None,)], "id int")
    rows = rules.validate_with_reasons(frame).collect()
    assert [(r["validation_errors"], r["is_row_valid"]) for r in rows] == [([], True)] * 2
    clean, quarantine = rules.process_data(frame)
    assert (clean.count(), quarantine.count()) == (2, 0)
    assert rules.validate_with_reasons(frame).schema["validation_errors"].dataType.simpleString() == "array<string>"


def test_names_are_compared_without_case(spark):
    rules = plain(ColumnDefinition("V", "int", min_value=1))
    frame = spark.createDataFrame([(0,)], "v int")
    assert rules.validate_with_reasons(frame).first()["validation_errors"] == ["V"]


def test_one_frame_on_request(spark):
    frame = spark.createDataFrame([(1, 5, 2)], "id int, v int, w int")
    assert RULES.process_data(frame, one_output_table=True).columns[-2:] == ["validation_errors", "is_row_valid"]


def test_odd_column_names(spark):
    rules = plain(ColumnDefinition("a.b c`d", "int", min_value=1))
    frame = spark.createDataFrame([(0,), (2,)], "`a.b c``d` int")
    assert rules.process_data(frame)[0].count() == 1


def test_nan_is_above_every_bound(spark):
    rules = plain(ColumnDefinition("d", "double", min_value=1.0, max_value=2.0))
    frame = spark.createDataFrame([(float("nan"),), (1.5,)], "d double")
    clean, quarantine = rules.process_data(frame)
    assert (clean.count(), quarantine.count()) == (1, 1)


cell = st.one_of(st.none(), st.integers(-3, 12))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.integers(0, 5), cell, cell), min_size=1, max_size=30))
def test_every_row_is_clean_or_quarantined_as_brute_force_says(spark, rows):
    def errors(v, w):
        bad = []
        if v is None or not 1 <= v <= 9:
            bad.append("v")
        if w is None or w % 2:
            bad.append("w")
        return bad

    frame = spark.createDataFrame(rows, "id int, v int, w int")
    clean, quarantine = RULES.process_data(frame)
    key = repr
    assert sorted(map(tuple, clean.collect()), key=key) == sorted([r for r in rows if not errors(*r[1:])], key=key)
    failing = [(*r, errors(*r[1:]), False) for r in rows if errors(*r[1:])]
    assert sorted(map(tuple, quarantine.collect()), key=key) == sorted(failing, key=key)
    summary = {r["column_name"]: r["failed_rows"] for r in RULES.failure_summary(frame).collect()}
    assert summary == {
        "v": sum("v" in f[3] for f in failing),
        "w": sum("w" in f[3] for f in failing),
        "*": len(failing),
    }


def test_checks_let_null_pass_but_not_null_is_counted(spark):
    frame = spark.createDataFrame([(1, 0, 1), (2, None, None), (3, 10, 2)], "id int, v int, w int")
    counts = {r["constraint_name"]: r["violations"] for r in RULES.constraint_violations(frame).collect()}
    assert counts == {"v_min_check": 1, "v_max_check": 1, "w_custom_check": 1, "w_not_null": 1}
    with pytest.raises(ValueError, match="v_min_check: 1 rows"):
        quality.reject_violations(frame, RULES.columns)
    with pytest.raises(ValueError, match="violated: w_not_null: 1 rows"):
        quality.reject_violations(frame.where("id = 2"), RULES.columns)


def test_quarantine_filter_reaches_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("id AS v", "id AS w").write.parquet(f"{tmp_path}/t")
    rules = [ColumnDefinition("w", "bigint", custom_condition="w > 3"), ColumnDefinition("v", "bigint", max_value=5)]
    failing = quality.quarantine_rows(spark.read.parquet(f"{tmp_path}/t"), rules)
    plan = failing._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].splitlines()[0]
    assert "LessThanOrEqual(w,3)" in pushed and "GreaterThan(v,5)" in pushed
