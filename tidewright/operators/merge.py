"""Keyed upsert as a frame function, and schema alignment for writes.

A matched target row takes every source column but ``created_at`` and
``valid_from``, NULLs included; unmatched source rows are inserted; target-only
rows stay. Keys match by plain equality, so a NULL key never matches and its
source row is inserted.

Why not one full outer join: Spark cannot split a skewed key there. The upsert
is instead a left join from the target (its skewed partitions can be split,
and a small source is broadcast so the target does not move at all) plus the
source rows no target key matches.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewright.settings import AUDIT_COLUMNS, KEPT_ON_UPDATE, quoted

_HIT = "__hit"


def _keys_only(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key columns of rows that can match at all."""
    known = reduce(and_, [F.col(quoted(k)).isNotNull() for k in keys])
    return df.select(*[F.col(quoted(k)) for k in keys]).where(known)


def repeated_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-NULL keys held by several source rows; counted before the shuffle."""
    counted = _keys_only(source, keys).groupBy(*keys).count()
    return counted.where("count > 1")


def matched_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys both sides hold, read from the key columns alone.

    The target's keys are made distinct before they are joined, which folds a
    hot key into one row per task. Where Spark can broadcast the source's keys
    it moves the join below the aggregate, so that only matching keys are
    shuffled.
    """
    return _keys_only(target, keys).distinct().join(_keys_only(source, keys), list(keys), "left_semi")


def matched_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target rows whose key the source holds; the target is read once."""
    return target.join(_keys_only(source, keys), list(keys), "left_semi")


def merged(
    target: DataFrame, source: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = ()
) -> DataFrame:
    """Target rows after the upsert, in the target's schema.

    ``source`` must hold one row per key (see ``repeated_keys``). Its columns
    must be a subset of the target's; a target column it lacks keeps its value
    on update and is NULL on insert. With ``newest_by`` a source row that is less
    than the target's by these columns leaves it as it is; NULL is the least value.
    """
    if not keys:
        raise ValueError("An upsert needs key columns.")
    require_columns(source, keys)
    require_columns(target, keys)
    for side in (source, target):
        require_columns(side, newest_by)
    return updated_rows(target, source, keys, newest_by).unionByName(inserted_rows(target, source, keys))


def updated_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = ()
) -> DataFrame:
    """Every target row, with the source's values where its key matches."""
    incoming = aligned(source, target.schema, fill_missing=False)
    have = {c.lower() for c in incoming.columns}
    fixed = {k.lower() for k in keys} | set(KEPT_ON_UPDATE)
    changing = [c for c in target.columns if c.lower() in have and c.lower() not in fixed]
    # Renamed, so that a source derived from the target stays unambiguous.
    side = incoming.select(
        *[F.col(quoted(k)).alias(f"__key_{i}") for i, k in enumerate(keys)],
        *[F.col(quoted(c)).alias(f"__new_{c}") for c in changing],
        *[F.col(quoted(c)).alias(f"__order_{i}") for i, c in enumerate(newest_by)],
        F.lit(True).alias(_HIT),
    )
    same = [F.col(quoted(k)) == F.col(f"__key_{i}") for i, k in enumerate(keys)]
    joined = target.join(side, reduce(and_, same), "left")
    taken = F.col(_HIT)
    if newest_by:
        arriving = F.struct(*[F.col(f"__order_{i}").alias(f"o{i}") for i in range(len(newest_by))])
        present = F.struct(*[F.col(quoted(c)).alias(f"o{i}") for i, c in enumerate(newest_by)])
        taken = taken & (arriving >= present)

    def after(name: str) -> Column:
        old = F.col(quoted(name))
        if name not in changing:
            return old
        # The flag, not coalesce, decides: a NULL from the source overwrites too.
        return F.when(taken, F.col(quoted(f"__new_{name}"))).otherwise(old).alias(name)

    return joined.select(*[after(c) for c in target.columns])


def inserted_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows no target key matches, in the target's schema."""
    known = matched_keys(target, source, keys)
    return aligned(source.join(known, list(keys), "left_anti"), target.schema)


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    have = {c.lower() for c in df.columns}
    absent = [n for n in names if n.lower() not in have]
    if absent:
        raise ValueError(f"Columns not found: {absent}")


def missing_fields(target: StructType, source: StructType) -> list:
    """Source-only fields: business columns first, audit columns last."""
    have = {f.name.lower() for f in target.fields}
    absent = [f for f in source.fields if f.name.lower() not in have]
    audit = [f for f in absent if f.name in AUDIT_COLUMNS]
    return [f for f in absent if f.name not in AUDIT_COLUMNS] + audit


def aligned(df: DataFrame, schema: StructType, *, fill_missing: bool = True) -> DataFrame:
    """The frame's columns under the schema's names, types and order.

    Columns the schema lacks are refused; columns the frame lacks become NULL,
    or are left out when ``fill_missing`` is false.
    """
    extra = [f.name for f in missing_fields(schema, df.schema)]
    if extra:
        raise ValueError(f"Columns unknown to the table: {extra}; evolve its schema first.")
    have = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        ours = have.get(field.name.lower())
        if ours is not None:
            value = F.col(quoted(ours.name))
            if ours.dataType != field.dataType:
                value = value.cast(field.dataType)
            columns.append(value.alias(field.name))
        elif fill_missing:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*columns)
