import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("scorefold-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def rows(spark):
    """rows(data, schema, *columns): evaluate expressions over literal rows, in order."""

    def evaluate(data, schema, *columns):
        return [tuple(r) for r in spark.createDataFrame(data, schema).coalesce(1).select(*columns).collect()]

    return evaluate


@pytest.fixture
def column(rows):
    """column(values, type, f): the list of f(column) over the values."""

    def evaluate(values, dtype, f):
        return [r[0] for r in rows([(v,) for v in values], f"x {dtype}", f("x"))]

    return evaluate
