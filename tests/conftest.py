import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[*]")
        .appName("logsift-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    from pyspark import SparkConf

    if not SparkConf().get("spark.checkpoint.dir", None):
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="logsift-test-ckpt-"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def conf(spark):
    """Set session confs for one test and restore them afterwards."""
    saved = {}

    def set_(key, value):
        if key not in saved:
            saved[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)

    yield set_
    for k, v in saved.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def line(ip="1.2.3.4", ts="27/Dec/2037:12:00:00 +0000", request="GET /usr/admin HTTP/1.0", status="200",
         size="4900", referrer="-", agent="Mozilla/5.0", rt="120", ident="- -"):
    return f'{ip} {ident} [{ts}] "{request}" {status} {size} "{referrer}" "{agent}" {rt}'


def lines_df(spark, items):
    return spark.createDataFrame([(i, s) for i, s in enumerate(items)], "id int, log_line string")
