"""Key-hash layout of file tables: one partition for each bucket of the key's hash.

The bucket is derived from the key alone, so the buckets an upsert touches follow
from its source, a row never moves, and only those buckets are rewritten. Rows with
a NULL in their key match nothing; they lie in a bucket of their own that is only
appended to. The layout is noted in the table's properties, so that later
upserts need not name it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegerType, StructField, StructType

from tidewright.operators import merge
from tidewright.settings import quoted

# The partition column, and its value for rows with a NULL in their key.
KEY_BUCKET = "key_bucket"
UNKEYED = -1
_PROPERTY = "key_bucket_layout"


@dataclass(frozen=True)
class Layout:
    keys: tuple[str, ...]
    buckets: int

    def properties(self) -> dict[str, str]:
        return {_PROPERTY: json.dumps({"keys": list(self.keys), "buckets": self.buckets})}

    def require(self, keys: Sequence[str], buckets: int | None = None) -> None:
        if {k.lower() for k in keys} != {k.lower() for k in self.keys}:
            raise ValueError(f"The table is laid out by the key {list(self.keys)}, not by {list(keys)}.")
        if buckets not in (None, self.buckets):
            raise ValueError(f"The table has {self.buckets} key buckets, not {buckets}.")


def layout_of(table_name: str) -> Layout | None:
    """The layout a table was created with; only its properties are read."""
    props = SparkSession.active().sql(f"SHOW TBLPROPERTIES {table_name}")
    rows = props.where(F.col("key") == _PROPERTY).collect()
    if not rows:
        return None
    facts = json.loads(rows[0]["value"])
    return Layout(tuple(facts["keys"]), facts["buckets"])


def bucketed_schema(schema: StructType) -> StructType:
    if any(f.name.lower() == KEY_BUCKET for f in schema.fields):
        raise ValueError(f"The column name {KEY_BUCKET} is taken by the layout.")
    return StructType([*schema.fields, StructField(KEY_BUCKET, IntegerType())])


def known_key(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(quoted(k)).isNotNull() for k in keys])


def with_bucket(rows: DataFrame, table: StructType, layout: Layout) -> DataFrame:
    """The rows under the table's types, as equal keys of other types hash otherwise,
    with their bucket."""
    plain = StructType([f for f in table.fields if f.name.lower() != KEY_BUCKET])
    typed = merge.aligned(rows.drop(KEY_BUCKET), plain, fill_missing=False)
    kinds = {f.name.lower(): f.dataType for f in typed.schema.fields}

    def hashed(key: str) -> Column:
        # 0.0 and -0.0 are equal keys.
        value = F.col(quoted(key))
        return value + F.lit(0.0) if isinstance(kinds[key.lower()], (DoubleType, FloatType)) else value

    bucket = F.pmod(F.xxhash64(*[hashed(k) for k in layout.keys]), F.lit(layout.buckets)).cast("int")
    return typed.withColumn(KEY_BUCKET, F.when(known_key(layout.keys), bucket).otherwise(F.lit(UNKEYED)))
