import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from logsift.operators.detect_ml import isolation_forest, isolation_forest_check, kmeans_check, kmeans_clusters


def planted(spark, n=3000, k=15):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"a": rng.normal(0, 1, n), "b": rng.normal(0, 1, n)})
    pdf.loc[: k - 1, ["a", "b"]] = rng.normal(9, 0.3, (k, 2))
    pdf["id"] = np.arange(n)
    return spark.createDataFrame(pdf)


def test_isolation_forest_ranks_planted_points_first(spark):
    df = planted(spark)
    out = isolation_forest(df, ["a", "b"], contamination=0.1)
    top = [r.id for r in out.orderBy(F.desc("anomaly_score"), "id").limit(15).collect()]
    assert sorted(top) == list(range(15))
    share = out.agg(F.avg("isolation_forest_anomaly")).collect()[0][0]
    assert 0.09 <= share <= 0.1
    check = isolation_forest_check(out).first()
    assert (check.n_rows, check.null_scores, check.out_of_range, check.flagged_share_kept) == (3000, 0, 0, True)


@pytest.mark.parametrize("equal", [8000, 200_000])
def test_equal_rows_are_the_majority_not_the_anomaly(spark, equal):
    """Many equal rows and 1,000 scattered ones: only scattered ones are flagged, at every size."""
    rng = np.random.default_rng(3)
    far = spark.createDataFrame(pd.DataFrame({"a": rng.uniform(-50, 50, 1000), "b": rng.uniform(-50, 50, 1000)}))
    df = spark.range(equal).select(F.lit(1.0).alias("a"), F.lit(2.0).alias("b")).unionByName(far)
    out = isolation_forest(df, ["a", "b"], contamination=1000 / (equal + 1000) + 1e-6)
    flagged = out.filter("isolation_forest_anomaly = 1")
    assert flagged.filter("a = 1.0 AND b = 2.0").count() == 0
    assert flagged.count() >= 990


def test_isolation_forest_independent_of_partitioning(spark):
    df = planted(spark)
    a = isolation_forest(df.repartition(2), ["a", "b"]).select("id", "anomaly_score").collect()
    b = isolation_forest(df.repartition(9), ["a", "b"]).select("id", "anomaly_score").collect()
    assert sorted(a) == sorted(b)


def test_isolation_forest_null_and_nan_features(spark):
    df = planted(spark).select("id", "a", "b")
    odd = spark.createDataFrame([(10_000 + i, float("nan"), 1.0) for i in range(100)] + [(20_000, None, 1.0)], "id long, a double, b double")
    out = isolation_forest(df.unionByName(odd), ["a", "b"], contamination=0.01)
    missing = out.filter("id >= 10000").collect()
    assert all(r.anomaly_score is None and r.isolation_forest_anomaly == 0 for r in missing)
    assert {r.id for r in out.filter("isolation_forest_anomaly = 1").collect()} >= set(range(15))


def test_isolation_forest_few_rows(spark):
    for rows in ([], [(1.0, 2.0)], [(1.0, 2.0), (3.0, 4.0), (3.0, 4.0)]):
        out = isolation_forest(spark.createDataFrame(rows, "a double, b double"), ["a", "b"]).collect()
        assert len(out) == len(rows) and all(r.anomaly_score is None or 0 < r.anomaly_score <= 1 for r in out)


def test_kmeans_far_points_flagged(spark):
    df = planted(spark)
    out = kmeans_clusters(df, ["a", "b"], k=2)
    flagged = {r.id for r in out.filter("cluster_anomaly = 1").collect()}
    assert set(range(15)) <= flagged
    check = kmeans_check(out).first()
    assert (check.n_rows, check.size_sum, check.misplaced) == (3000, 3000, 0)


def test_kmeans_independent_of_partitioning(spark):
    df = planted(spark, 20_000, 300)
    runs = []
    for parts in (2, 4, 9):
        out = kmeans_clusters(df.repartition(parts), ["a", "b"], k=3)
        runs.append(sorted((r.id, r.cluster, r.cluster_size, r.distance, r.cluster_anomaly) for r in out.collect()))
    assert runs[0] == runs[1] == runs[2]


def test_kmeans_odd_rows(spark):
    rows = [(1.0, 2.0), (1.0, 2.0), (None, 1.0), (float("nan"), 1.0), (5.0, 2.0)]
    out = kmeans_clusters(spark.createDataFrame(rows, "a double, b double"), ["a", "b"], k=2).collect()
    assert len(out) == 3 and all(not math.isnan(r.distance) for r in out)
    assert kmeans_clusters(spark.createDataFrame([], "a double, b double"), ["a", "b"], k=2).count() == 0
