"""One row per key. A NULL in a key matches nothing, so its row is kept."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.settings import quoted

_RANK, _APART = "__rank", "__apart"


def dedup_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One arbitrary row per key; aggregated before the shuffle."""
    if not keys:
        raise ValueError("De-duplication needs key columns.")
    return _apart(df, keys).dropDuplicates([*keys, _APART]).drop(_APART)


def _apart(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """With a column that tells rows with a NULL in their key apart from all others."""
    unknown = reduce(or_, [F.col(quoted(k)).isNull() for k in keys])
    return df.withColumn(_APART, F.when(unknown, F.monotonically_increasing_id()))


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row per key in the order given.

    ``row_number() = 1`` is planned with a group limit below the exchange, so
    every input partition sends at most one row per key: a key that holds a
    third of all rows does not gather in one task.
    """
    if not keys:
        raise ValueError("De-duplication needs key columns.")
    ranked = Window.partitionBy(*[F.col(quoted(k)) for k in keys], _APART).orderBy(*order_by)
    rows = _apart(df, keys).withColumn(_RANK, F.row_number().over(ranked))
    return rows.where(f"{_RANK} = 1").drop(_RANK, _APART)
