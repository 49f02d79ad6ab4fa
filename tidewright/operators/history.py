"""Versions of rows with validity intervals.

A key's versions are ordered by the time they are valid from. A version that says the
same as the one before it is none, which a hash of its values finds; each other one is
valid until the next begins, and the last is open (``valid_to`` is NULL). A late change
is put where it belongs, and one for a time that is known replaces what was said of that
time.

What says the same as the version before it is dropped, and is unknown when a late change
comes between the two: that one then holds until the next version. ``repeats`` keeps all
that was said as versions of their own, which makes any order of arrival give the same
rows. A key's versions meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.operators.merge import aligned, require_columns
from tidewright.settings import quoted

VALID_FROM, VALID_TO, IS_ACTIVE = "valid_from", "valid_to", "is_active"
_EXACT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_NEW, _SAID, _RANK = "__new", "__said", "__rank"


def value_columns(rows: DataFrame, keys: Sequence[str]) -> list[str]:
    """The columns whose change makes a version."""
    apart = {k.lower() for k in keys} | {VALID_FROM, VALID_TO, IS_ACTIVE}
    return [c for c in rows.columns if c.lower() not in apart]


def _said(rows: DataFrame, keys: Sequence[str]) -> Column:
    """A hash of the values in which NULL differs from any value; 256 bits, as no one
    compares the values afterwards."""
    texts = F.to_json(
        F.struct(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(value_columns(rows, keys))]),
        {"ignoreNullFields": "false", "timestampFormat": _EXACT + "XXX", "timestampNTZFormat": _EXACT},
    )
    return F.sha2(texts, 256)


def history(
    current: DataFrame, changes: DataFrame, keys: Sequence[str], *, repeats: bool = False
) -> DataFrame:
    """All versions after the changes, in the schema of ``current``.

    ``changes`` has the keys, ``valid_from`` and values; a column it lacks is NULL in its
    versions. Keys and ``valid_from`` must not be NULL. Of several changes of a key at
    one time the one with the greatest hash counts.
    """
    require_columns(changes, [*keys, VALID_FROM])
    require_columns(current, [*keys, VALID_FROM, VALID_TO])
    touched = changes.select(*[F.col(quoted(k)) for k in keys]).distinct()
    old = current.join(touched, list(keys), "left_semi").select(*current.columns)
    new = aligned(changes, current.schema)
    versions = old.withColumn(_NEW, F.lit(0)).unionByName(new.withColumn(_NEW, F.lit(1)))
    versions = versions.withColumn(_SAID, _said(current, keys))
    of_key = Window.partitionBy(*[F.col(quoted(k)) for k in keys])
    at_a_time = Window.partitionBy(*[F.col(quoted(k)) for k in keys], VALID_FROM)
    first = F.row_number().over(at_a_time.orderBy(F.desc(_NEW), F.desc(_SAID)))
    versions = versions.withColumn(_RANK, first).where(F.col(_RANK) == 1)
    in_time = of_key.orderBy(VALID_FROM)
    if not repeats:
        versions = versions.withColumn("__before", F.lag(_SAID).over(in_time))
        versions = versions.where(~F.col("__before").eqNullSafe(F.col(_SAID)))
    versions = versions.withColumn(VALID_TO, F.lead(VALID_FROM).over(in_time))
    if IS_ACTIVE in [c.lower() for c in current.columns]:
        versions = versions.withColumn(IS_ACTIVE, F.col(VALID_TO).isNull())
    untouched = current.join(touched, list(keys), "left_anti").select(*current.columns)
    return untouched.unionByName(versions.select(*current.columns))
