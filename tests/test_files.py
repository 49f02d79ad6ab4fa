from datetime import date

import pytest

from tidewright.sources import files
from test_merge import rows


def test_formats(spark, tmp_path):
    data = spark.createDataFrame([(1, "a;b"), (2, None)], "id int, s string")
    for name in ("parquet", "orc", "json"):
        data.write.format(name).save(f"{tmp_path}/{name}")
        assert rows(files.scan(spark, f"{tmp_path}/{name}", name.upper()).select("id", "s")) == [(1, "a;b"), (2, None)]
    data.write.csv(f"{tmp_path}/csv", header=True, sep="\t")
    text = files.scan(spark, f"{tmp_path}/csv", "csv", csv_header=True, csv_delimiter="\t")
    assert text.columns == ["id", "s"] and rows(text) == [("1", "a;b"), ("2", None)]
    typed = files.scan(spark, f"{tmp_path}/csv", "csv", csv_header=True, csv_delimiter="\t", schema="id int, s string")
    assert rows(typed) == [(1, "a;b"), (2, None)]
    data.write.xml(f"{tmp_path}/xml", rowTag="r")
    assert rows(files.scan(spark, f"{tmp_path}/xml", "xml", schema="id int, s string", options={"rowTag": "r"})) == [(1, "a;b"), (2, None)]
    assert files.scan(spark, f"{tmp_path}/csv", "text").columns == ["value"]
    binary = files.scan(spark, f"{tmp_path}/json", "binary", options={"pathGlobFilter": "*.json"})
    assert {"path", "length", "content"} <= set(binary.columns) and binary.count() >= 1


def test_fixture_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1, "s": "x"},\n {"id": 2, "s": null}]')
    (tmp_path / "b.CSV").write_text("id,s\n1,x\n2,\n")
    assert rows(files.scan_by_suffix(spark, f"{tmp_path}/a.json")) == [(1, "x"), (2, None)]
    assert rows(files.scan_by_suffix(spark, f"{tmp_path}/b.CSV")) == [("1", "x"), ("2", None)]
    with pytest.raises(ValueError, match="c.txt"):
        files.scan_by_suffix(spark, f"{tmp_path}/c.txt")


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="parquet, delta, csv, json, xml, avro, orc, text, binary"):
        files.scan(spark, "/nowhere", "xls")


def test_schema_is_the_union_of_all_files(spark, tmp_path):
    spark.range(1).write.parquet(f"{tmp_path}/d")
    spark.range(1).selectExpr("id", "'x' AS s").write.mode("append").parquet(f"{tmp_path}/d")
    assert files.file_schema(spark, f"{tmp_path}/d").simpleString() == "struct<id:bigint,s:string>"


def test_widened_scan(spark, tmp_path):
    spark.sql("SELECT 1 AS n, CAST(1.5 AS FLOAT) AS f, 7 AS d, CAST(1 AS DECIMAL(5, 2)) AS m").write.parquet(f"{tmp_path}/a")
    spark.sql("SELECT 10000000000 AS N, 2.5D AS f, 0.5D AS d, CAST(1 AS DECIMAL(6, 3)) AS m, 'x' AS s").write.parquet(f"{tmp_path}/b")
    frame = files.scan_widened(spark, [f"{tmp_path}/a", [f"{tmp_path}/b"]])
    assert [t for _, t in frame.dtypes] == ["bigint", "double", "double", "decimal(6,3)", "string"]
    assert rows(frame.select("n", "f", "d", "s")) == [(1, 1.5, 7.0, None), (10_000_000_000, 2.5, 0.5, "x")]
    spark.sql("SELECT 'x' AS n").write.parquet(f"{tmp_path}/c")
    with pytest.raises(ValueError, match="n"):
        files.scan_widened(spark, [f"{tmp_path}/a", f"{tmp_path}/c"])


def test_month_files():
    assert files.month_files("/land/", today=date(2025, 2, 28)) == [
        "/land/yellow/yellow_tripdata_2024-11.parquet",
        "/land/green/green_tripdata_2024-11.parquet",
    ]
    assert files.month_files("/land", "yellow", "2025-03") == ["/land/yellow/yellow_tripdata_2025-03.parquet"]
    assert len(files.month_files("/land", "a, b")) == 2
    assert files.months_back(date(2025, 3, 31), 3) == "2024-12"
