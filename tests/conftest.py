import datetime as dt
import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from threadloom.session import prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master(os.environ.get("TEST_MASTER", "local[*]")).appName("tests").config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tests-"))
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture()
def as_of():
    return dt.datetime(2024, 3, 1)


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in (df.select(*order) if order else df).collect()), key=repr)


def final_plan(df) -> str:
    """The plan as executed, after adaptive changes."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
