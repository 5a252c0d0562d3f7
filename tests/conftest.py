import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("tablescout-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from tablescout.session import checkpoint_dir

    checkpoint_dir(s, tempfile.mkdtemp(prefix="tablescout-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def g0(spark):
    """The sample pair from FIXTURES.md (G0)."""
    t0 = spark.createDataFrame(
        [("foo", "lst", 1), ("max", "lst", 1), ("lst", "dt", 2), ("foo", "show", 3)], "k string, t string, v bigint"
    )
    t1 = spark.createDataFrame([("foo", "max", 3), ("foo", "vs", 1), ("lst", "re", 2)], "l string, m string, n bigint")
    return [t0, t1]
