"""Declarative table definitions: columns, rules, audit columns, version."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    StructField,
    StructType,
    TimestampType,
)

from tidewright.operators import drift, quality
from tidewright.operators.ddl import create_table_text
from tidewright.settings import quoted, sql_text


@dataclass(frozen=True)
class ColumnDefinition:
    """One column: name, type text, nullability, comment and row rules.

    ``custom_condition`` is any Spark SQL predicate over the row. A ruled
    column fails on NULL, also where it is nullable.
    """

    name: str
    data_type: str
    nullable: bool = True
    comment: str | None = None
    min_value: Any = None
    max_value: Any = None
    custom_condition: str | None = None

    def to_spark_type(self) -> DataType:
        """The Spark type of ``data_type``; any Spark DDL type text is accepted."""
        text = self.data_type.strip()
        if text.lower() == "bool":
            return BooleanType()
        try:
            return DataType.fromDDL(text)
        except Exception as e:
            raise ValueError(f"Column '{self.name}': unknown type '{self.data_type}'") from e

    def to_spark_field(self) -> StructField:
        metadata = {"comment": self.comment} if self.comment else None
        return StructField(self.name, self.to_spark_type(), self.nullable, metadata)

    @property
    def value(self) -> Column:
        return F.col(quoted(self.name))

    def has_rule(self) -> bool:
        bounded = self.min_value is not None or self.max_value is not None
        return not self.nullable or bounded or bool(self.custom_condition)

    def constraints(self) -> dict[str, Column]:
        """Named raw predicates for range and custom rules; NULL satisfies them."""
        named = {}
        if self.min_value is not None:
            named[f"{self.name}_min_check"] = self.value >= self.min_value
        if self.max_value is not None:
            named[f"{self.name}_max_check"] = self.value <= self.max_value
        if self.custom_condition:
            named[f"{self.name}_custom_check"] = F.expr(self.custom_condition)
        return named

    def passes(self) -> Column:
        """Raw conjunction of the rules, for WHERE: NULL drops the row.

        No ``coalesce`` wraps it, so its comparisons reach the Parquet scan.
        """
        checks = [] if self.nullable else [self.value.isNotNull()]
        return reduce(and_, checks + list(self.constraints().values()))

    def fails(self) -> Column:
        """Never-NULL complement of ``passes`` as a disjunction of simple
        comparisons, which a Parquet scan can use to skip row groups."""
        checks = []
        if not self.nullable or self.min_value is not None or self.max_value is not None:
            checks.append(self.value.isNull())
        if self.min_value is not None:
            checks.append(self.value < self.min_value)
        if self.max_value is not None:
            checks.append(self.value > self.max_value)
        if self.custom_condition:
            custom = F.expr(self.custom_condition)
            checks += [custom.isNull(), ~custom]
        return reduce(or_, checks)

    def get_validation_expr(self) -> Column | None:
        """True where every rule holds, else false; None without rules."""
        return F.coalesce(self.passes(), F.lit(False)) if self.has_rule() else None


@dataclass(frozen=True)
class TableDefinition:
    """A table: ordered columns, key, version and audit column switches."""

    table_name: str
    columns: Sequence[ColumnDefinition]
    location: str | None = None
    key_columns: Sequence[str] | None = None
    version: str = "1.0.0"
    include_is_active: bool = True
    include_create_and_update: bool = True
    include_valid_from_valid_to: bool = False

    def __post_init__(self):
        if not self.table_name:
            raise ValueError("table_name must not be empty.")
        if not self.columns:
            raise ValueError("columns must name at least one column.")
        if self.include_create_and_update and self.include_valid_from_valid_to:
            raise ValueError("Choose created_at/updated_at or valid_from/valid_to, not both.")

    def to_schema(self, *, include_audit: bool = True) -> StructType:
        """Business columns in order, then the audit columns switched on."""
        fields = [c.to_spark_field() for c in self.columns]
        if not include_audit:
            return StructType(fields)
        if self.include_valid_from_valid_to:
            fields.append(StructField("valid_from", TimestampType(), False))
            fields.append(StructField("valid_to", TimestampType(), True))
        if self.include_is_active:
            fields.append(StructField("is_active", BooleanType(), False))
        if self.include_create_and_update:
            fields.append(StructField("created_at", TimestampType(), False))
            fields.append(StructField("updated_at", TimestampType(), False))
        return StructType(fields)

    # Validation

    def validate_dataframe(self, df: DataFrame) -> DataFrame:
        return quality.flag_rows(df, self.columns)

    def validate_with_reasons(self, df: DataFrame) -> DataFrame:
        return quality.explain_rows(df, self.columns)

    def process_data(
        self, df: DataFrame, *, one_output_table: bool = False
    ) -> tuple[DataFrame, DataFrame] | DataFrame:
        """(clean, quarantine), or one annotated frame."""
        if one_output_table:
            return self.validate_with_reasons(df)
        return quality.clean_rows(df, self.columns), quality.quarantine_rows(df, self.columns)

    def failure_summary(self, df: DataFrame) -> DataFrame:
        return quality.failure_summary(df, self.columns)

    def constraint_violations(self, df: DataFrame) -> DataFrame:
        return quality.constraint_violations(df, self.columns)

    def reject_violations(self, df: DataFrame) -> None:
        quality.reject_violations(df, self.columns)

    def broken_constraints(self, df: DataFrame) -> dict[str, Column]:
        return quality.broken_constraints(df, self.columns)

    def reject_schema(self, df: DataFrame) -> None:
        """Raise where rows lack or mistype a defined column. Reads no data."""
        report = self.compare_schema(df, include_audit=False)
        if report["missing_in_source"] or report["type_mismatches"]:
            raise ValueError(f"Rows do not fit {self.table_name}: {report}")

    def reject(self, df: DataFrame) -> None:
        """``reject_schema``, then raise where a constraint is violated. This reads the rows
        once; a write with ``gate=`` counts the violations of the very rows it writes."""
        self.reject_schema(df)
        self.reject_violations(df)

    # Drift

    def compare_schema(self, df: DataFrame, *, include_audit: bool = True) -> dict[str, list[str]]:
        return drift.schema_report(df.schema, self.to_schema(include_audit=include_audit))

    def drift_report(self, df: DataFrame, *, include_audit: bool = True) -> DataFrame:
        return drift.drift_report(df, self.to_schema(include_audit=include_audit))

    # Catalog text

    def generate_ddl(
        self, table_format: str | None = None, *, partition_by: Sequence[str] = ()
    ) -> str:
        """CREATE TABLE text built from ``to_schema()``, so it never differs from it."""
        return create_table_text(
            self.table_name,
            self.to_schema(),
            table_format or SparkSession.active().conf.get("spark.sql.sources.default"),
            partition_by=partition_by,
            location=self.location,
            version=self.version,
        )

    def generate_constraints(self) -> list[str]:
        """ALTER TABLE texts for providers that enforce CHECK constraints."""
        texts = []
        for c in self.columns:
            limits = [("min", ">=", c.min_value), ("max", "<=", c.max_value)]
            rules = {
                f"{c.name}_{kind}_check": f"{quoted(c.name)} {sign} {_literal(bound)}"
                for kind, sign, bound in limits
                if bound is not None
            }
            if c.custom_condition:
                rules[f"{c.name}_custom_check"] = c.custom_condition
            texts += [
                f"ALTER TABLE {self.table_name} ADD CONSTRAINT {quoted(name)} CHECK ({rule})"
                for name, rule in rules.items()
            ]
        return texts

    # Catalog actions

    def catalog_version(self) -> str | None:
        props = SparkSession.active().sql(f"SHOW TBLPROPERTIES {self.table_name}")
        rows = props.where("key = 'schema_version'").collect()
        return rows[0]["value"] if rows else None

    def sync_table_version(self) -> None:
        SparkSession.active().sql(
            f"ALTER TABLE {self.table_name} "
            f"SET TBLPROPERTIES ('schema_version' = {sql_text(self.version)})"
        )

    def ensure_version_sync(
        self,
        *,
        table_format: str | None = None,
        partition_by: Sequence[str] = (),
        allow_downgrade: bool = False,
    ) -> bool:
        """Create the table, or stamp it with this version; True if anything changed.

        A catalog version above this one is refused unless ``allow_downgrade``.
        """
        spark = SparkSession.active()
        if not spark.catalog.tableExists(self.table_name):
            spark.sql(self.generate_ddl(table_format, partition_by=partition_by))
            return True
        if self.catalog_version() == self.version:
            return False
        if not allow_downgrade:
            self.refuse_downgrade()
        self.sync_table_version()
        return True

    def refuse_downgrade(self) -> None:
        current = self.catalog_version()
        if current and _version_key(current) > _version_key(self.version):
            raise ValueError(
                f"{self.table_name} is at version {current}, above {self.version}."
            )


def _literal(bound: Any) -> str:
    if isinstance(bound, bool) or isinstance(bound, (int, float)):
        return str(bound).lower() if isinstance(bound, bool) else repr(bound)
    return sql_text(str(bound))


def _version_key(version: str) -> list[tuple[int, int, str]]:
    """Numeric parts compare as numbers and rank above text parts."""
    parts = version.split(".")
    return [(1, int(p), "") if p.isdigit() else (0, 0, p) for p in parts]


def create_table_definition_from_dict(
    table_name: str,
    columns_dict: Sequence[Mapping[str, Any]],
    location: str | None = None,
    key_columns: Sequence[str] | None = None,
    include_is_active: bool = True,
    include_create_and_update: bool = True,
    include_valid_from_valid_to: bool = False,
) -> TableDefinition:
    """A definition from configuration; each column needs ``name`` and ``type``."""
    columns = []
    for entry in columns_dict:
        rest = {k: v for k, v in entry.items() if k != "type"}
        columns.append(ColumnDefinition(data_type=entry["type"], **rest))
    return TableDefinition(
        table_name=table_name,
        columns=columns,
        location=location,
        key_columns=key_columns,
        include_is_active=include_is_active,
        include_create_and_update=include_create_and_update,
        include_valid_from_valid_to=include_valid_from_valid_to,
    )
