import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="triage-test-ckpt-")
    s = (SparkSession.builder.master("local[4]").appName("triage-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(ckpt)
    yield s


@pytest.fixture(scope="session")
def registry():
    from triage.registry import load_all
    return load_all()


@pytest.fixture(scope="session")
def fx01(spark):
    from triage.sources.fixtures import Fixtures
    return Fixtures(spark, SF01)


@pytest.fixture(scope="session")
def fx001(spark):
    from triage.sources.fixtures import Fixtures
    return Fixtures(spark, SF001)


def _key(t):
    return tuple((x is None, str(x)) for x in t)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=_key)


def one(spark, expr_cols, data, schema):
    """Evaluate column expressions over hand-written rows."""
    df = spark.createDataFrame(data, schema)
    return [tuple(r) for r in df.select(*expr_cols).collect()]
