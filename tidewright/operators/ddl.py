"""CREATE TABLE text from a schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql.types import StructType

from tidewright.settings import quoted, sql_text


def create_table_text(
    table_name: str,
    schema: StructType,
    table_format: str,
    *,
    partition_by: Sequence[str] = (),
    location: str | None = None,
    version: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> str:
    specs = []
    for f in schema.fields:
        spec = f"{quoted(f.name)} {f.dataType.simpleString()}"
        if not f.nullable:
            spec += " NOT NULL"
        if f.metadata.get("comment"):
            spec += f" COMMENT {sql_text(f.metadata['comment'])}"
        specs.append(spec)
    text = f"CREATE TABLE IF NOT EXISTS {table_name} ({', '.join(specs)}) USING {table_format}"
    if partition_by:
        text += f" PARTITIONED BY ({', '.join(quoted(c) for c in partition_by)})"
    if location:
        text += f" LOCATION {sql_text(location)}"
    properties = dict(properties or {}) | ({"schema_version": version} if version else {})
    if properties:
        listed = ", ".join(f"{sql_text(k)} = {sql_text(v)}" for k, v in properties.items())
        text += f" TBLPROPERTIES ({listed})"
    return text
