"""Names and places shared by the whole library."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Audit column names and the two a matched row keeps on update.
AUDIT_COLUMNS = ("is_active", "valid_from", "valid_to", "created_at", "updated_at")
KEPT_ON_UPDATE = ("created_at", "valid_from")

# Default names of the two control tables.
SRC_DEFINITIONS_TABLE = "src_definitions"
INGEST_LOGS_TABLE = "ingest_logs"

# The two spellings of a load's outcome.
SUCCESS = "success"
FAILED = "failed"

# Partition column of staging tables: one value per committed micro-batch.
LOAD_ID = "load_id"

_local_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; on
    a cluster a machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder shared by all executors.")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_folder:
        _local_folder[app] = tempfile.mkdtemp(prefix="tidewright-")
    return _local_folder[app]


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def scratch_folder(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A fresh shared folder for one step, removed when the step is over."""
    folder = fresh_folder(spark, purpose)
    try:
        yield folder
    finally:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def quoted(name: str) -> str:
    """A single column name as Spark SQL text, safe for any character."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """A Python string as a Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
