"""Fixture rows shared by the operators' tests."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)


def docs(spark, rows):
    """A documents table of (doc_id, text) rows."""
    return spark.createDataFrame(
        [(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in rows], DOCS
    ).repartition(3)


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}
