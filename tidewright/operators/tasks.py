"""Bounds on what one task of a load or an upsert takes, whatever the size of the tables.

A task that sorts or aggregates holds a whole split of a file, and a split is at least a
row group: 128 MB by default, which repeated texts (file names, states) swell many times
in memory. Within ``small_tasks`` splits, row groups that are written and partitions of a
shuffle are smaller, and shuffles have enough partitions to be split that far.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidewright.operators.joins import size_in_bytes

# Bytes of a split, of a shuffle partition, and of a row group that is written.
TASK_BYTES = 16 << 20
# Partitions of a shuffle before Spark joins small ones.
TASK_PARTITIONS = 200

ROW_GROUP = "parquet.block.size"
_BYTES = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", ROW_GROUP)
_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Lowers the session's sizes for what is run within; smaller ones of the session stay."""
    conf = spark.conf
    before = {name: conf.get(name, None) for name in (*_BYTES, _PARTITIONS)}
    given = before[_PARTITIONS] or conf.get("spark.sql.shuffle.partitions")
    try:
        for name in _BYTES:
            size = TASK_BYTES if before[name] is None else min(TASK_BYTES, size_in_bytes(before[name]))
            conf.set(name, str(size))
        conf.set(_PARTITIONS, str(max(TASK_PARTITIONS, int(given))))
        yield
    finally:
        for name, value in before.items():
            if value is None:
                conf.unset(name)
            else:
                conf.set(name, value)


def in_small_tasks(work):
    """The function, run within ``small_tasks`` of its first argument's session, or of the
    active one if that is no frame."""

    @functools.wraps(work)
    def run(*args, **kwargs):
        first = next(iter((*args, *kwargs.values())), None)
        spark = first.sparkSession if isinstance(first, DataFrame) else SparkSession.active()
        with small_tasks(spark):
            return work(*args, **kwargs)

    return run
