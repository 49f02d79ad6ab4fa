import pathlib
import sys
import uuid

import pytest
from pyspark.sql import SparkSession

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def db(spark):
    """A fresh database, so that every test has table names of its own."""
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture(scope="session")
def table():
    return lambda spark, name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
