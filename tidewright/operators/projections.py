"""Projections and filters, most of them driven by registry text."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.settings import quoted

# Names of the lineage columns.
LINEAGE_COLUMNS = (
    "loaded_at",
    "source_file_name",
    "source_file_path",
    "source_file_modified_at",
)

# A quoted piece of SQL text, whose semicolons end no clause, or a semicolon.
_QUOTED_OR_END = re.compile(r"""'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*"|`(?:``|[^`])*`|;""", re.S)


def select_text(df: DataFrame, columns: str | None, *, also: Sequence[str] = ()) -> DataFrame:
    """Project with SQL select-list text, then the ``also`` columns as they are."""
    listed = (columns or "*").strip()
    kept = "".join(f", {quoted(c)}" for c in also)
    if listed == "*":
        return df
    # Braces are doubled because the text is a format string naming {src}.
    text = (listed + kept).replace("{", "{{").replace("}", "}}")
    return df.sparkSession.sql(f"SELECT {text} FROM {{src}}", src=df)


def filter_clauses(*texts: str | None) -> Column | None:
    """All ``;``-separated clauses of all texts, joined by AND; None without any."""
    clauses = [c.strip() for t in texts if t for c in _clauses(t)]
    return reduce(and_, [F.expr(c) for c in clauses if c]) if any(clauses) else None


def _clauses(text: str) -> list[str]:
    ends = [m.start() for m in _QUOTED_OR_END.finditer(text) if m[0] == ";"]
    return [text[a:b] for a, b in zip([0, *(e + 1 for e in ends)], [*ends, len(text)])]


def where_clauses(df: DataFrame, *texts: str | None) -> DataFrame:
    """Filter by registry text; the plain predicates reach the file scan."""
    condition = filter_clauses(*texts)
    return df if condition is None else df.where(condition)


def with_lineage(df: DataFrame) -> DataFrame:
    """Add load time and file identity; ``df`` must be a file scan."""
    return df.select(
        "*",
        F.current_timestamp().alias("loaded_at"),
        F.col("_metadata.file_name").alias("source_file_name"),
        F.col("_metadata.file_path").alias("source_file_path"),
        F.col("_metadata.file_modification_time").alias("source_file_modified_at"),
    )


def strip_suffix(df: DataFrame, suffix: str = "_utc") -> DataFrame:
    """Remove a trailing suffix from every column name that has it."""
    names = [c.removesuffix(suffix) or c for c in df.columns]
    seen = [n.lower() for n in names]
    clashes = sorted({n for n in names if seen.count(n.lower()) > 1})
    if clashes:
        raise ValueError(f"Removing '{suffix}' gives one name twice: {clashes}")
    return df.toDF(*names)


def conform(df: DataFrame, columns: Sequence) -> DataFrame:
    """Keep the defined columns, in the defined order."""
    return df.select(*[F.col(quoted(c.name)) for c in columns])


def fill_audit(df: DataFrame) -> DataFrame:
    """Add is_active, created_at and updated_at where absent."""
    defaults = {
        "is_active": F.lit(True),
        "created_at": F.current_timestamp(),
        "updated_at": F.current_timestamp(),
    }
    have = {c.lower() for c in df.columns}
    missing = {name: value for name, value in defaults.items() if name not in have}
    return df.withColumns(missing) if missing else df


def in_month(df: DataFrame, column: str, month: str) -> DataFrame:
    """Rows whose timestamp lies in ``month`` ('yyyy-MM').

    A plain range, so partitions, files and row groups can be skipped.
    """
    start = F.to_timestamp_ntz(F.lit(f"{month}-01 00:00:00"))
    end = start + F.expr("INTERVAL 1 MONTH")
    ts = F.col(quoted(column))
    return df.where((ts >= start) & (ts < end))
