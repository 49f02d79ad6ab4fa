"""Joins with control and lookup tables.

A side made from driver rows, or computed, has no size Spark knows before it
runs; it would then shuffle the other side, however large, on a key of few
values. Its size is therefore summed first; each task sends one row of sums. A
side above the bound is left to Spark: a sort-merge join in which AQE splits
skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.settings import quoted


# Rows of a side that is broadcast, at most.
BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """The frame, marked for broadcast if it has at most ``BROADCAST_ROWS`` rows and
    ``spark.sql.autoBroadcastJoinThreshold`` bytes."""
    limit = size_in_bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    if limit <= 0:
        return df
    row_size = F.octet_length(F.to_json(F.struct("*")))
    seen = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(row_size), F.lit(0)).alias("size")).first()
    return F.broadcast(df) if seen["rows"] <= BROADCAST_ROWS and seen["size"] <= limit else df


def size_in_bytes(setting: str) -> int:
    """A Spark size setting such as '10485760b' or '10MB'."""
    digits = setting.strip().rstrip("bBkKmMgGtTpP")
    unit = setting.strip()[len(digits):].lower()[:1]
    return int(digits) * 1024 ** max(0, "bkmgtp".find(unit or "b"))


def join_lookup(
    df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, *, as_text: Sequence[str] = ()
) -> DataFrame:
    """Inner equi-join that attaches lookup attributes, without the lookup's key.

    ``as_text`` names lookup columns to attach as strings.
    """
    reference = f"{lookup_key}__ref"
    side = lookup.withColumnRenamed(lookup_key, reference)
    if as_text:
        side = side.withColumns({c: F.col(quoted(c)).cast("string") for c in as_text})
    joined = df.join(broadcast_if_small(side), F.col(quoted(key)) == F.col(quoted(reference)), "inner")
    return joined.drop(reference)


def rows_of_active_sources(landed: DataFrame, registry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Landed rows whose source is registered as active."""
    active = registry.where("is_active").select(*[F.col(quoted(k)) for k in keys])
    return landed.join(broadcast_if_small(active), list(keys), "left_semi")
