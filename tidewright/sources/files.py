"""File scans by format name, for batch and stream alike."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructField,
    StructType,
)

# Accepted format names.
FORMATS = ("parquet", "delta", "csv", "json", "xml", "avro", "orc", "text", "binary")

# By default a file stream ignores new files a week older than the latest one.
EVERY_AGE = "36500d"

# Files of one micro-batch: terabytes of full-size files, and still a list of
# paths the driver plans with ease. A lost driver resumes after the last batch.
FILES_PER_BATCH = 20_000

# Fixed value: monthly file names.
MONTH_FILE = "{kind}_tripdata_{month}.parquet"


def spark_format(file_format: str) -> str:
    name = file_format.lower()
    if name not in FORMATS:
        raise ValueError(f"Unsupported file format '{file_format}'; use one of {', '.join(FORMATS)}.")
    return "binaryFile" if name == "binary" else name


def _prepared(
    reader: DataFrameReader | DataStreamReader,
    file_format: str,
    schema: StructType | str | None,
    csv_header: bool,
    csv_delimiter: str,
    options: Mapping[str, str] | None,
):
    name = spark_format(file_format)
    reader = reader.format(name)
    if name == "csv":
        # With a header, a file whose columns differ is refused, not misread.
        reader = reader.option("header", csv_header).option("sep", csv_delimiter)
        reader = reader.option("enforceSchema", not csv_header)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**(options or {}))


def scan(
    spark: SparkSession,
    paths: str | Sequence[str],
    file_format: str = "parquet",
    *,
    schema: StructType | str | None = None,
    csv_header: bool = False,
    csv_delimiter: str = ",",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read files of one format. ``xml`` needs the option ``rowTag``; ``avro``
    and ``delta`` need their package on the cluster. Pass a schema for csv,
    json and xml: without one Spark reads the data twice (csv: gives text)."""
    reader = _prepared(spark.read, file_format, schema, csv_header, csv_delimiter, options)
    return reader.load(paths if isinstance(paths, str) else list(paths))


def scan_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    file_format: str = "parquet",
    *,
    csv_header: bool = False,
    csv_delimiter: str = ",",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The same scan as a stream of files; ``path`` may be a single file."""
    reader = spark.readStream.option("maxFileAge", EVERY_AGE)
    if not {k.lower() for k in options or {}} & {"maxfilespertrigger", "maxbytespertrigger"}:
        reader = reader.option("maxFilesPerTrigger", FILES_PER_BATCH)
    reader = _prepared(reader, file_format, schema, csv_header, csv_delimiter, options)
    return reader.load(_stream_path(path))


def _stream_path(path: str) -> str:
    """A file stream takes a single file only through a glob pattern; a class of
    one letter matches just that path."""
    path = path.rstrip("/")
    if "." not in path.rsplit("/", 1)[-1] or any(c in path for c in "*?[]{}\\"):
        return path
    return f"{path[:-1]}[{path[-1]}]"


def scan_by_suffix(spark: SparkSession, path: str) -> DataFrame:
    """A ``.json`` file of records, or a ``.csv`` file with header as text."""
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix == "json":
        return scan(spark, path, "json", options={"multiLine": "true"})
    if suffix == "csv":
        return scan(spark, path, "csv", csv_header=True)
    raise ValueError(f"Neither a .json nor a .csv file: {path}")


def file_schema(
    spark: SparkSession,
    paths: str | Sequence[str],
    file_format: str = "parquet",
    *,
    csv_header: bool = False,
    csv_delimiter: str = ",",
    options: Mapping[str, str] | None = None,
) -> StructType:
    """The union of the files' columns. For Parquet and ORC from the footers,
    read by a Spark job; no row is read. A column whose numeric types differ
    between files gets the wider one."""
    merging = dict(options or {})
    if file_format.lower() in ("parquet", "orc"):
        merging.setdefault("mergeSchema", "true")

    def schema(of: str | Sequence[str], **more: str) -> StructType:
        given = merging | more
        return scan(
            spark, of, file_format, csv_header=csv_header, csv_delimiter=csv_delimiter, options=given
        ).schema

    def halved(files: list[str]) -> StructType:
        # Spark refuses to merge some types. Files sorted by name change their
        # types a few times at most, so halving finds groups of one type soon.
        try:
            return schema(files)
        except Exception as e:
            if len(files) < 2 or "MERGE_SCHEMA" not in str(e):
                raise
        half = len(files) // 2
        return widened(halved(files[:half]), halved(files[half:]))

    try:
        return schema(paths)
    except Exception as e:
        if "MERGE_SCHEMA" not in str(e):
            raise
    one = scan(spark, paths, file_format, options=merging | {"mergeSchema": "false"})
    return halved(sorted(one.inputFiles()))


def scan_widened(spark: SparkSession, groups: Sequence[str | Sequence[str]]) -> DataFrame:
    """One Parquet scan over path groups whose numeric types differ.

    Spark refuses to merge int with bigint or double footers, but its Parquet
    reader widens to the schema it is given, so the wider type of each column
    is worked out from one schema per group and all groups are read at once.
    """
    schema = StructType([])
    for group in groups:
        schema = widened(schema, file_schema(spark, group))
    paths = [p for g in groups for p in ([g] if isinstance(g, str) else g)]
    return scan(spark, paths, schema=schema)


def widened(left: StructType, right: StructType) -> StructType:
    """All columns of both schemas, each with the wider of its two types."""
    merged = {f.name.lower(): f for f in left.fields}
    for f in right.fields:
        known = merged.get(f.name.lower())
        if known is None:
            merged[f.name.lower()] = StructField(f.name, f.dataType, True, f.metadata)
        elif known.dataType != f.dataType:
            wide = _wider(known.name, known.dataType, f.dataType)
            merged[f.name.lower()] = StructField(known.name, wide, True, known.metadata)
    return StructType(list(merged.values()))


# From narrow to wide; each integer type fits the ones after it.
_INTEGERS = [ByteType(), ShortType(), IntegerType(), LongType()]


def _wider(name: str, a: DataType, b: DataType) -> DataType:
    for one, other in ((a, b), (b, a)):
        if one in _INTEGERS and other in _INTEGERS:
            return max(one, other, key=_INTEGERS.index)
        if one in _INTEGERS[:3] and isinstance(other, (FloatType, DoubleType)):
            return DoubleType()
        if isinstance(one, FloatType) and isinstance(other, DoubleType):
            return DoubleType()
        if isinstance(one, DecimalType) and isinstance(other, DecimalType):
            scale = max(one.scale, other.scale)
            whole = max(one.precision - one.scale, other.precision - other.scale)
            if whole + scale <= 38:
                return DecimalType(whole + scale, scale)
    raise ValueError(f"Column '{name}': no common type for {a.simpleString()} and {b.simpleString()}")


def month_files(
    root: str,
    kinds: str | Sequence[str] = ("yellow", "green"),
    month: str | None = None,
    *,
    today: date | None = None,
    pattern: str = MONTH_FILE,
) -> list[str]:
    """Paths of one month's file per kind, each below a folder of its kind.

    ``month`` is 'yyyy-MM'; by default the month three months back. ``kinds``
    may be a comma-separated text.
    """
    if isinstance(kinds, str):
        kinds = [k.strip() for k in kinds.split(",") if k.strip()]
    month = month or months_back(today or date.today(), 3)
    base = root.rstrip("/")
    return [f"{base}/{kind}/{pattern.format(kind=kind, month=month)}" for kind in kinds]


def months_back(day: date, count: int) -> str:
    year, month = divmod(day.year * 12 + day.month - 1 - count, 12)
    return f"{year:04d}-{month + 1:02d}"
