import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# The reference's sample site log (11 lines, "site url").
SITE_LOG = [
    "www.baidu.com url1",
    "www.baidu.com url2",
    "www.baidu.com url2",
    "www.baidu.com url3",
    "www.baidu.com url4",
    "www.google.com url1",
    "www.google.com url1",
    "www.google.com url1",
    "www.google.com url2",
    "www.google.com url3",
    "www.google.com url3",
]


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    ckpt = tempfile.mkdtemp(prefix="skewkit-test-ckpt-")
    s = (SparkSession.builder.master("local[*]")
         .appName("skewkit-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def site_log(spark):
    rows = [tuple(line.split(" ")) for line in SITE_LOG]
    return spark.createDataFrame(rows, "site string, url string")


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="skewkit-test-")


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((x is not None, x) if x is not None else (False, 0) for x in t))
