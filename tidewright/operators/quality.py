"""Row validation. Everything here is JVM-side: no UDF and no row shuffle.

``columns`` are ``ColumnDefinition`` objects. Rules of columns the frame does
not have are skipped; names are compared without case.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ruled(df: DataFrame, columns: Sequence) -> list:
    names = {c.lower() for c in df.columns}
    return [c for c in columns if c.name.lower() in names and c.has_rule()]


def flag_rows(df: DataFrame, columns: Sequence) -> DataFrame:
    """Add ``is_row_valid``, true where no rule fails."""
    ruled = _ruled(df, columns)
    verdict = reduce(and_, [c.passes() for c in ruled]) if ruled else F.lit(True)
    return df.withColumn("is_row_valid", F.coalesce(verdict, F.lit(False)))


def explain_rows(df: DataFrame, columns: Sequence) -> DataFrame:
    """Add ``validation_errors``, the failing columns in definition order, and
    ``is_row_valid``, true where that array is empty."""
    ruled = _ruled(df, columns)
    none = F.array().cast("array<string>")
    # Constant arrays and concat stay in generated code; filtering an array
    # with a lambda does not, and takes twice as long.
    reasons = [F.when(c.fails(), F.array(F.lit(c.name))).otherwise(none) for c in ruled]
    verdict = ~reduce(or_, [c.fails() for c in ruled]) if ruled else F.lit(True)
    return df.withColumns(
        {"validation_errors": F.concat(*reasons) if ruled else none, "is_row_valid": verdict}
    )


def clean_rows(df: DataFrame, columns: Sequence) -> DataFrame:
    """The rows no rule fails, without verdict columns."""
    ruled = _ruled(df, columns)
    return df.where(reduce(and_, [c.passes() for c in ruled])) if ruled else df


def quarantine_rows(df: DataFrame, columns: Sequence) -> DataFrame:
    """The failing rows with their verdict columns.

    Filters first, so that the reasons are built for failing rows only.
    """
    ruled = _ruled(df, columns)
    failing = df.where(reduce(or_, [c.fails() for c in ruled]) if ruled else F.lit(False))
    return explain_rows(failing, columns)


def failure_summary(df: DataFrame, columns: Sequence) -> DataFrame:
    """(column_name, failed_rows) per ruled column, and ``*`` for failing rows.

    One global aggregate: each task sends a single row of counters.
    """
    ruled = _ruled(df, columns)
    named = {c.name: c.fails() for c in ruled}
    named["*"] = reduce(or_, list(named.values())) if named else F.lit(False)
    return _counts(df, named, "column_name", "failed_rows")


def broken_constraints(df: DataFrame, columns: Sequence) -> dict[str, Column]:
    """By name, what is true of a row that violates a NOT NULL, range or custom rule.

    As for an SQL CHECK, a NULL outcome of the latter two is no violation.
    """
    named = {}
    for c in _ruled(df, columns):
        if not c.nullable:
            named[f"{c.name}_not_null"] = c.value.isNull()
        named.update({name: ~rule for name, rule in c.constraints().items()})
    return named


def constraint_violations(df: DataFrame, columns: Sequence) -> DataFrame:
    """(constraint_name, violations) for NOT NULL, range and custom rules."""
    return _counts(df, broken_constraints(df, columns), "constraint_name", "violations")


def reject_violations(df: DataFrame, columns: Sequence) -> None:
    """Gate before a write: raise with the counts when a constraint is violated."""
    found = constraint_violations(df, columns).collect()
    refuse({r["constraint_name"]: r["violations"] for r in found})


def refuse(violations: Mapping[str, int]) -> None:
    broken = {name: n for name, n in violations.items() if n}
    if broken:
        counts = ", ".join(f"{name}: {n} rows" for name, n in broken.items())
        raise ValueError(f"Constraints violated: {counts}")


def _counts(df: DataFrame, named: dict[str, Column], label: str, measure: str) -> DataFrame:
    if not named:
        return df.sparkSession.createDataFrame([], f"{label} string, {measure} bigint")
    totals = df.agg(*[F.count_if(rule).alias(f"n{i}") for i, rule in enumerate(named.values())])
    rows = [
        F.struct(F.lit(name).alias(label), F.col(f"n{i}").alias(measure))
        for i, name in enumerate(named)
    ]
    return totals.select(F.inline(F.array(*rows)))
