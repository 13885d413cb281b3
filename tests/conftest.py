import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import configure

    scratch = tempfile.mkdtemp(prefix="tidemark-tests-")
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.conf.set("spark.checkpoint.dir", f"{scratch}/shared")
    session.sql("CREATE DATABASE IF NOT EXISTS t")
    yield configure(session)
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""

    def get(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])

    return get


@pytest.fixture
def table(spark, request):
    """A table name used by one test only."""
    name = "t." + "".join(c if c.isalnum() else "_" for c in request.node.name).lower()
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return name
