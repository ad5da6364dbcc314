"""Shared folders, the stored table and exact quantiles."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from logsift.operators.analytics import discrete_quantiles
from logsift.plans import catalog
from logsift.session import forget, persist, shared_dir

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

# Another folder as working directory: workers then have no copy of the package.
_PLAIN = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.sql.warehouse.dir", {cwd!r} + "/warehouse"){more}.getOrCreate())
{setup}
from logsift.plans.catalog import QUERIES
for q in ("overview", "isolation_forest", "kmeans_check", "response_time_distribution", "clean_logs"):
    print(q, QUERIES[q](spark, {sf!r}).count())
"""


@pytest.mark.parametrize("more, setup", [
    ("", ""), ("", "spark.sparkContext.setCheckpointDir({cwd!r} + '/own')"), (".config('spark.checkpoint.dir', {cwd!r} + '/set')", "")])
def test_queries_run_in_a_session_without_presets(tmp_path, more, setup):
    cwd = str(tmp_path)
    code = _PLAIN.format(root=ROOT, cwd=cwd, sf=SF_SMALL, more=more.format(cwd=cwd), setup=setup.format(cwd=cwd))
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_CONF_DIR")} | {"SPARK_CONF_DIR": cwd}
    done = subprocess.run([sys.executable, "-c", code], cwd=cwd, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    assert "clean_logs 1000" in done.stdout
    # What was written is gone with the application.
    left = [f for top, _, names in os.walk(cwd) if "logsift-" in top for f in names if f.endswith(".parquet")]
    assert left == []


def test_stored_table_follows_its_input(spark, tmp_path):
    for t in ("events", "nation", "region"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    d = str(tmp_path)
    assert catalog.QUERIES["overview"](spark, d).first().total_requests == 1000
    first = catalog._STORED[(spark.sparkContext.applicationId, d)]
    catalog.QUERIES["overview"](spark, d)
    assert catalog._STORED[(spark.sparkContext.applicationId, d)] is first
    spark.read.parquet(f"{SF_SMALL}/events.parquet").write.mode("append").parquet(f"{d}/events.parquet")
    assert catalog.QUERIES["overview"](spark, d).first().total_requests == 2000


def test_persist_and_forget(spark):
    df = persist(spark.range(10), "test")
    assert df.count() == 10 and shared_dir(spark, "x") != shared_dir(spark, "x")
    files = df.inputFiles()
    forget(df)
    assert not any(os.path.exists(f.removeprefix("file://").removeprefix("file:")) for f in files)


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_quantiles_of_a_million_distinct_values(spark, conf, reuse):
    conf("spark.sql.exchange.reuse", reuse)
    n = 1_000_003
    df = spark.range(n).select((F.col("id") * 7919 % n * 1_000_000_007).alias("l"), (F.col("id") * 104729 % n / 7.0 - 1e4).alias("d"))
    got = discrete_quantiles(df, {"l": (0.0, 0.25, 0.5, 0.75, 1.0), "d": (0.1, 0.5)})
    row = spark.range(1).select(*got["l"], *got["d"]).first()
    ranks = [max(1, -(-n * q // 100)) - 1 for q in (0, 25, 50, 75, 100)]
    assert list(row[:5]) == [r * 1_000_000_007 for r in ranks]
    assert list(row[5:]) == [r / 7.0 - 1e4 for r in (-(-n // 10) - 1, -(-n // 2) - 1)]


def test_quantiles_of_odd_columns(spark):
    df = spark.createDataFrame([(None, 1.5), (3, None), (1, float("nan")), (1, -2.0)], "a int, b double")
    got = discrete_quantiles(df, {"a": (0.5, 1.0), "b": (0.34, 1.0)})
    row = spark.range(1).select(*got["a"], *got["b"]).first()
    assert list(row[:3]) == [1, 3, 1.5] and row[3] != row[3]
    none = discrete_quantiles(df.limit(0), {"a": (0.5,)})["a"]
    assert spark.range(1).select(*none).first()[0] is None
