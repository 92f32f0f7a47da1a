import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("CLICKMART_TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[*]")
        .appName("clickmart-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # Tests only: name a checkpoint folder when the environment names none.
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getConf().get("spark.checkpoint.dir", None)):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="clickmart-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="clickmart-test-")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
