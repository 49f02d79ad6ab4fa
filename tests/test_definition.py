import pytest
from pyspark.sql import types as T

from tidewright import ColumnDefinition, TableDefinition, create_table_definition_from_dict


def plain(*columns, name="t", **options):
    return TableDefinition(
        name, list(columns), include_is_active=False, include_create_and_update=False, **options
    )


@pytest.mark.parametrize(
    "text, expected",
    [
        ("string", T.StringType()),
        ("int", T.IntegerType()),
        ("Integer", T.IntegerType()),
        ("long", T.LongType()),
        ("bigint", T.LongType()),
        ("double", T.DoubleType()),
        ("float", T.FloatType()),
        ("bool", T.BooleanType()),
        ("boolean", T.BooleanType()),
        ("timestamp", T.TimestampType()),
        ("timestamp_ntz", T.TimestampNTZType()),
        ("date", T.DateType()),
        ("decimal", T.DecimalType(10, 0)),
        ("decimal(10,2)", T.DecimalType(10, 2)),
        ("Decimal(10, 2)", T.DecimalType(10, 2)),
        ("array<int>", T.ArrayType(T.IntegerType())),
    ],
)
def test_types(spark, text, expected):
    assert ColumnDefinition("c", text).to_spark_type() == expected


def test_unknown_type_is_refused(spark):
    with pytest.raises(ValueError, match="wibble"):
        ColumnDefinition("c", "wibble").to_spark_type()


def test_field_has_comment_and_nullability(spark):
    field = ColumnDefinition("c", "int", False, "it's a count").to_spark_field()
    assert (field.nullable, field.metadata) == (False, {"comment": "it's a count"})


def test_invalid_definitions():
    column = ColumnDefinition("a", "int")
    for arguments in [
        {"table_name": "", "columns": [column]},
        {"table_name": "t", "columns": []},
        {"table_name": "t", "columns": [column], "include_valid_from_valid_to": True},
    ]:
        with pytest.raises(ValueError):
            TableDefinition(**arguments)


def test_schema_order_and_nullability(spark):
    both = TableDefinition("t", [ColumnDefinition("a", "int")])
    assert [(f.name, f.nullable) for f in both.to_schema()] == [
        ("a", True), ("is_active", False), ("created_at", False), ("updated_at", False),
    ]
    validity = TableDefinition(
        "t", [ColumnDefinition("a", "int")], include_create_and_update=False,
        include_valid_from_valid_to=True,
    )
    assert [(f.name, f.nullable) for f in validity.to_schema()] == [
        ("a", True), ("valid_from", False), ("valid_to", True), ("is_active", False),
    ]


def test_from_dict(spark):
    definition = create_table_definition_from_dict(
        "t",
        [
            {"name": "a", "type": "int", "nullable": False, "min_value": 1, "max_value": 9},
            {"name": "b", "type": "string", "comment": "text", "custom_condition": "length(b) > 5"},
        ],
        key_columns=["a"],
    )
    assert definition.columns[0] == ColumnDefinition("a", "int", False, None, 1, 9)
    assert definition.columns[1].custom_condition == "length(b) > 5"
    assert isinstance(definition, TableDefinition) and definition.key_columns == ["a"]


def test_constraint_texts_quote_literals():
    definition = plain(
        ColumnDefinition("a", "int", min_value=1, max_value=2),
        ColumnDefinition("b", "string", min_value="it's", custom_condition="length(b) > 5"),
    )
    texts = definition.generate_constraints()
    assert len(texts) == 4
    assert texts[0] == "ALTER TABLE t ADD CONSTRAINT `a_min_check` CHECK (`a` >= 1)"
    assert "(`b` >= 'it\\'s')" in texts[2] and "b_custom_check" in texts[3]


def test_create_from_ddl_has_every_schema_column(spark, db):
    definition = TableDefinition(
        f"{db}.t",
        [ColumnDefinition("a", "bool", False, "it's"), ColumnDefinition("odd name", "int")],
    )
    assert definition.ensure_version_sync() is True
    table = spark.table(f"{db}.t")
    assert table.columns == ["a", "odd name", "is_active", "created_at", "updated_at"]
    assert table.schema["a"].metadata["comment"] == "it's"
    assert definition.catalog_version() == "1.0.0"
    assert definition.ensure_version_sync() is False


def test_version_stamp_moves_up_only(spark, db):
    def at(version):
        return TableDefinition(f"{db}.t", [ColumnDefinition("a", "int")], version=version)

    at("1.9.0").ensure_version_sync()
    assert at("1.10.0").ensure_version_sync() is True
    with pytest.raises(ValueError, match="1.10.0"):
        at("1.9.1").ensure_version_sync()
    assert at("1.9.1").ensure_version_sync(allow_downgrade=True) is True
    assert at("1.9.1").catalog_version() == "1.9.1"


def test_version_sync_of_missing_table_raises(spark, db):
    with pytest.raises(Exception):
        plain(ColumnDefinition("a", "int"), name=f"{db}.absent").sync_table_version()


def test_drift_report_dict(spark):
    definition = TableDefinition(
        "t", [ColumnDefinition("Key", "bigint"), ColumnDefinition("n", "int"), ColumnDefinition("x", "int")]
    )
    frame = spark.createDataFrame([], "key bigint, n string, extra int")
    report = definition.compare_schema(frame)
    assert report["missing_in_source"] == ["x", "is_active", "created_at", "updated_at"]
    assert report["unexpected_in_source"] == ["extra"]
    assert report["type_mismatches"] == [
        "n is string, defined as n int"
    ]
    business = definition.compare_schema(frame, include_audit=False)
    assert business["missing_in_source"] == ["x"]


def test_drift_counts_values_that_do_not_convert(spark):
    definition = plain(ColumnDefinition("n", "int"), ColumnDefinition("m", "int"), ColumnDefinition("d", "date"))
    frame = spark.createDataFrame(
        [("1", [1], "2024-01-01"), ("x1", [], "x"), ("-", None, None), (" 7 ", None, ""), (None, None, "1")],
        "n string, m array<int>, d string",
    )
    rows = {r["column_name"]: r["bad_rows"] for r in definition.drift_report(frame).collect()}
    assert rows == {"n": 2, "m": 2, "d": 3}


def test_no_drift_reads_nothing(spark):
    definition = plain(ColumnDefinition("n", "int"))
    assert definition.drift_report(spark.createDataFrame([(1,)], "n int")).count() == 0
    only_extra = definition.drift_report(spark.createDataFrame([(1, 2)], "n int, e int")).collect()
    assert [(r["kind"], r["column_name"], r["bad_rows"]) for r in only_extra] == [
        ("unexpected_in_source", "e", None)
    ]
