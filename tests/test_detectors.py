import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from conftest import line, lines_df
from logsift.config import DetectorConfig
from logsift.functions.clean import clean_logs
from logsift.operators import detect_rules as R
from logsift.operators import detect_stats as S
from logsift.operators.metrics import traffic_metrics


def metric_df(spark, rows):
    """rows: (hour_offset, key, request_count)"""
    base = dt.datetime(2024, 1, 1)
    data = [(base + dt.timedelta(hours=h), k, "/e", c, 10.0) for h, k, c in rows]
    return spark.createDataFrame(data, "timestamp timestamp, ip_address string, endpoint string, "
                                       "request_count bigint, response_time double")


def test_z_score_flags_a_spike(spark):
    rows = [(h, "a", 10) for h in range(30)] + [(30, "a", 200)]
    rows = [(h, k, c + (h % 3)) for h, k, c in rows]
    out = S.z_score(metric_df(spark, rows), threshold=3).filter("anomaly = 1").collect()
    assert len(out) == 1 and out[0].request_count == 200


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_z_score_degenerate_groups(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    rows = [(0, "one", 5)] + [(h, "flat", 7) for h in range(4)]
    out = {(r.ip_address, r.timestamp): r for r in S.z_score(metric_df(spark, rows)).collect()}
    for r in out.values():
        assert r.z_score is None and r.anomaly == 0
        if r.ip_address == "one":
            assert r.stddev_request_count is None
        else:
            assert r.stddev_request_count == 0.0


def test_normal_behavior_matches_z_score_baseline(spark):
    rows = [(h, k, (h * 7) % 5 + 1) for h in range(10) for k in ("a", "b")]
    m = metric_df(spark, rows)
    base = {r.ip_address: r for r in S.normal_behavior(m).collect()}
    for r in S.z_score(m).collect():
        assert r.avg_request_count == pytest.approx(base[r.ip_address].avg_request_count)
        assert r.stddev_request_count == pytest.approx(base[r.ip_address].stddev_request_count)


@pytest.mark.parametrize("k", [2, 9, 10])
def test_rolling_bound(spark, k):
    # one spike after k flat rows: |x-mean|/std over n=k+1 rows is (n-1)/sqrt(n)
    rows = [(h, "a", 1) for h in range(k)] + [(k, "a", 100)]
    out = S.rolling_anomaly(metric_df(spark, rows), window_size=k, threshold=0).collect()
    last = max(out, key=lambda r: r.timestamp)
    n = k + 1
    assert abs(last.request_count - last.rolling_mean) / last.rolling_std == pytest.approx((n - 1) / math.sqrt(n))
    flagged = S.rolling_anomaly(metric_df(spark, rows), window_size=k, threshold=3).filter("time_series_anomaly=1")
    assert flagged.count() == (1 if (n - 1) / math.sqrt(n) > 3 else 0)


def test_rolling_excluding_current_row(spark):
    rows = [(h, "a", 1 + h % 2) for h in range(6)] + [(6, "a", 50)]
    out = S.rolling_anomaly(metric_df(spark, rows), window_size=2, threshold=3, include_current=False)
    assert [r.request_count for r in out.filter("time_series_anomaly = 1").collect()] == [50]


def test_outliers_zscore_and_iqr(spark):
    vals = [10, 11, 12, 10, 11, 12, 10, 11, 12, 10, 11, 12, 10, 11, 12, 10, 11, 12, 10, 500]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, x int")
    z = {r.id: r.x_outlier for r in S.outliers_zscore(df, ["x"]).collect()}
    assert z[19] == 1 and sum(z.values()) == 1
    q = {r.id: r.x_outlier for r in S.outliers_iqr(df, ["x"]).collect()}
    assert q[19] == 1 and sum(q.values()) == 1
    plan = S.outliers_zscore(df, ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_outliers_constant_column_under_ansi(spark, conf):
    conf("spark.sql.ansi.enabled", "true")
    df = spark.createDataFrame([(1,), (1,), (1,)], "x int")
    assert [r.x_outlier for r in S.outliers_zscore(df, ["x"]).collect()] == [0, 0, 0]


def test_traffic_metrics_buckets(spark):
    items = [line(ip="1.1.1.1", ts=f"01/Jan/2024:10:{m:02d}:00 +0000", rt=str(m)) for m in (1, 2, 3)]
    items += [line(ip="1.1.1.1", ts="01/Jan/2024:11:00:00 +0000", rt="7"), "garbage"]
    out = traffic_metrics(clean_logs(lines_df(spark, items))).orderBy("timestamp").collect()
    assert [(r.request_count, r.response_time) for r in out] == [(3, 2.0), (1, 7.0)]


def rules_input(spark):
    items = [line(ip="1.1.1.1", request="DELETE /x HTTP/1.0", status="500", rt="6000"),
             line(ip="1.1.1.1", request="put /x HTTP/1.0", status="401", rt="7000", agent="SQLMap/1.0"),
             line(ip="2.2.2.2", status="200", agent="nmap scan"),
             line(ip="2.2.2.2", status="200", agent="Mozilla", ts="bad"),
             "garbage"]
    return clean_logs(lines_df(spark, items))


def test_rule_detectors(spark):
    df = rules_input(spark)
    m = R.suspicious_methods(df).collect()
    assert [(r.method, r.timestamp) for r in m] == [("DELETE", "2037-12-27T12:00:00+00:00")]
    assert sorted(r.status_code for r in R.suspicious_status(df).collect()) == [401, 500]
    ips = {r.ip_address: r.request_count for r in R.high_rate_ips(df, limit=1).collect()}
    assert ips == {"1.1.1.1": 2, "2.2.2.2": 2}
    slow = R.slow_requests(df).collect()
    assert [(r["count"], r.avg_response_time, r.max_response_time) for r in slow] == [(2, 6500.0, 7000)]
    assert R.slow_requests(df, max_ms=10_000).count() == 0
    ua = {r.user_agent: r["count"] for r in R.suspicious_user_agents(df).collect()}
    assert ua == {"SQLMap/1.0": 1, "nmap scan": 1}
    assert R.blocked_countries(df.withColumn("country", F.lit("X"))).count() == 0
    assert R.blocked_countries(df.withColumn("country", F.lit("X")), countries=["X"]).count() == 5


def test_report_and_totals(spark):
    df = rules_input(spark).withColumn("country", F.lit("X"))
    cfg = DetectorConfig(max_requests_per_ip=1, geoblocking_countries=("X",))
    rep = R.anomaly_report(df, cfg)
    cats = {}
    for r in rep.collect():
        cats[r.category] = cats.get(r.category, 0) + 1
    assert cats == {"ip": 2, "performance": 1, "security": 2, "method": 1, "status": 2, "geo": 5}
    t = R.anomaly_totals(rep).collect()[0]
    assert (t.ip_anomalies, t.performance_anomalies, t.security_anomalies) == (2, 1, 1)
    assert t.total_anomalies == 4


@pytest.mark.parametrize("k,include_current", [(1, True), (3, True), (5, False), (11, True)])
def test_rolling_blocked_equals_plain(spark, k, include_current):
    import random

    rnd = random.Random(k)
    rows = []
    for key, n in (("hot", 400), ("b", 30), ("c", 3)):
        hours = sorted(rnd.sample(range(0, 24 * 40), n))
        rows += [(h, key, rnd.randrange(1, 50)) for h in hours]
    m = metric_df(spark, rows)
    cols = ["ip_address", "timestamp", "rolling_mean", "rolling_std", "time_series_anomaly"]
    plain = S.rolling_anomaly(m, window_size=k, threshold=1.5, include_current=include_current).select(*cols)
    blocked = S.rolling_anomaly(m, window_size=k, threshold=1.5, include_current=include_current,
                                block_seconds=86400).select(*cols)
    assert sorted(plain.collect()) == sorted(blocked.collect())
    assert blocked.count() == len(rows)
