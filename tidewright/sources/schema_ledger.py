"""The schema of a growing folder, read from the footers of new files only.

A ledger beside a load's checkpoint names the files whose columns are known (path, size,
time of change) and their common schema. A later run reads the footers of files that are
not named, widens the schema by theirs, and notes both in one write. The ledger can be
deleted at any time: the next run then reads all footers again.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewright.sources.files import file_schema, widened
from tidewright.sources.manifest import listed_files

_LEDGER = "path string, size bigint, modified timestamp, run int, schema string"
# Formats with footers, and how many new files are named to the reader at most; a folder
# with more of them is read whole.
FOOTERS = ("parquet", "orc")
NAMED_FILES = 10_000


def folder_schema(
    spark: SparkSession,
    path: str,
    file_format: str,
    ledger: str,
    *,
    options: Mapping[str, str] | None = None,
    **csv: str | bool,
) -> StructType:
    """The union of the files' columns, as ``file_schema`` gives it."""
    if file_format.lower() not in FOOTERS or _is_pattern(path):
        return file_schema(spark, path, file_format, options=options, **csv)
    known = _read(spark, ledger)
    last = known.where(F.col("schema").isNotNull()).agg(F.max(F.struct("run", "schema"))).first()[0]
    selection = {k: v for k, v in (options or {}).items() if k in ("recursiveFileLookup", "pathGlobFilter")}
    file = ["path", "size", "modified"]
    found = listed_files(spark, path, selection).join(known.select(*file), file, "left_anti")
    new = [r["location"] for r in found.select("location").limit(NAMED_FILES + 1).collect()] if last else []
    if last and not new:
        return StructType.fromJson(json.loads(last["schema"]))
    if last and len(new) <= NAMED_FILES and not _is_file(path) and not any(_is_pattern(f) for f in new):
        only = file_schema(spark, new, file_format, options={**(options or {}), "basePath": path})
        schema = widened(StructType.fromJson(json.loads(last["schema"])), only)
    else:
        schema = file_schema(spark, path, file_format, options=options)
    run = last["run"] + 1 if last else 0
    named = found.select(*file, F.lit(run).alias("run"), F.lit(None).cast("string").alias("schema"))
    said = spark.range(1).select(
        *[F.lit(None).cast(t).alias(c) for c, t in zip(file, ("string", "bigint", "timestamp"), strict=True)],
        F.lit(run).alias("run"),
        F.lit(schema.json()).alias("schema"),
    )
    named.unionByName(said).write.mode("append").parquet(ledger)
    return schema


def _read(spark: SparkSession, ledger: str) -> DataFrame:
    try:
        return spark.read.schema(_LEDGER).parquet(ledger)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], _LEDGER)


def _is_pattern(path: str) -> bool:
    return any(c in path for c in "*?[]{}\\")


def _is_file(path: str) -> bool:
    return "." in path.rstrip("/").rsplit("/", 1)[-1]
