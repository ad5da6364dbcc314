import datetime as dt
import math

from pyspark.sql import functions as F

from conftest import SF_ORACLE
from logsift.functions.clean import clean_logs
from logsift.operators import analytics as A
from logsift.operators import slices as L
from logsift.session import persist
from logsift.sources import fixtures


def cleaned(spark):
    return persist(clean_logs(fixtures.log_lines(spark, SF_ORACLE)), "test-slices")


def test_overview_of_any_range_reads_slices_only(spark):
    df = cleaned(spark)
    slices = persist(L.traffic_slices(df), "test-hours")
    lo, hi = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc), dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
    for start, end in ((None, None), (lo, hi), (hi, None), (dt.datetime(1990, 1, 1, tzinfo=dt.timezone.utc), dt.datetime(1990, 1, 2, tzinfo=dt.timezone.utc))):
        part = df
        if start is not None:
            part = part.filter(F.col("timestamp") >= F.lit(start))
        if end is not None:
            part = part.filter(F.col("timestamp") < F.lit(end))
        got, want = L.overview_from_slices(slices, start, end).first(), A.overview(part).first()
        assert got.total_requests == want.total_requests and got.max_response_time == want.max_response_time
        for c in ("avg_response_time", "avg_response_size"):
            assert got[c] is want[c] is None or math.isclose(got[c], want[c], rel_tol=1e-12)
        # Four standard errors.
        assert abs(got.unique_visitors - want.unique_visitors) <= 4 * 1.04 / 2 ** (L.HLL_BITS / 2) * want.unique_visitors
    asked = L.overview_from_slices(slices)
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and all("test-hours" in f for f in asked.inputFiles())


def test_merged_quantile_sketches_keep_their_rank_error(spark):
    """Ten million skewed values in 40 slices."""
    n = 10_000_000
    values = spark.range(n).selectExpr("timestamp_seconds(3600 * (id % 40)) AS timestamp", "'a' AS ip_address", "'/' AS endpoint",
                                       "cast(pow(2.0, 24 * (id / 1e7)) AS int) AS response_time", "1 AS response_size")
    slices = persist(L.traffic_slices(values), "test-kll")
    r = L.distribution_from_slices(slices).first()
    for q, v in ((0.25, r.iqr_response_time[0]), (0.5, r.median_response_time), (0.75, r.iqr_response_time[1])):
        # Ranks of the values that truncate to v.
        low, high = math.log2(v) / 24, math.log2(v + 1) / 24
        assert low - L.KLL_ERROR <= q <= high + L.KLL_ERROR
    none = L.distribution_from_slices(slices.filter("timed < 0")).first()
    assert none.median_response_time is None and none.iqr_response_time == [None, None]


def test_heavy_hitters_of_a_skewed_stream_are_found(spark):
    """Addresses above n / 400 among a million that come once."""
    heavy = {f"h{k}": 4000 + 150 * k for k in range(20)}
    parts = [spark.range(c).selectExpr(f"'{v}' AS ip_address", "id") for v, c in heavy.items()]
    rows = spark.range(1_000_000).selectExpr("concat('u', id) AS ip_address", "id")
    for p in parts:
        rows = rows.unionByName(p)
    rows = rows.selectExpr("ip_address", "timestamp_seconds(3600 * (id % 17)) AS timestamp", "'/' AS endpoint", "1 AS response_time", "1 AS response_size")
    slices = persist(L.traffic_slices(rows), "test-top")
    got = {r.item: r["count"] for r in L.heavy_from_slices(slices, "top_ip", 20).collect()}
    n = 1_000_000 + sum(heavy.values())
    assert set(got) == set(heavy)
    assert all(heavy[v] <= c <= heavy[v] + 4 * n / L.TOP_PLACES for v, c in got.items())
    assert [r.item for r in L.heavy_from_slices(slices, "top_endpoint", 3).collect()] == ["/"]


def test_slices_of_one_hour_merge(spark):
    df = cleaned(spark)
    whole = L.overview_from_slices(L.traffic_slices(df)).first()
    half = F.pmod(F.xxhash64("ip_address", "timestamp"), F.lit(2)) == 0
    parts = L.traffic_slices(df.filter(half)).unionByName(L.traffic_slices(df.filter(~half)))
    assert L.overview_from_slices(parts).first() == whole


def test_one_refresh_equals_the_single_queries(spark):
    df = cleaned(spark)
    out = L.dashboard_refresh(df)
    rows = out.collect()
    by = {name: [r for r in rows if r.panel == name] for name in L.PANELS}
    stats = A.descriptive_stats(df).first()
    top = by["summary"][0]
    assert len(by["summary"]) == 1 and top.answered == stats.total_requests and top.min_response_time == stats.min_response_time
    assert math.isclose(top.avg_response_time, stats.avg_response_time) and math.isclose(top.stddev_response_time, stats.stddev_response_time)
    assert {(r.hour, r.requests, r.avg_response_time) for r in by["hourly"]} == {tuple(r) for r in A.hourly_profile(df).collect()}
    assert {(r.status_code, r.requests) for r in by["status"]} == {tuple(r) for r in A.status_distribution(df).collect()}
    assert {(r.day, r.status_code, r.requests) for r in by["trend"]} == {tuple(r) for r in A.status_code_trend(df).collect()}
    for name, column in (("top_ips", "ip_address"), ("top_methods", "method"), ("top_endpoints", "endpoint")):
        assert {(r[column], r.requests) for r in by[name]} == {tuple(r) for r in A.top_n(df, column, 10).collect()}
    plan = L.dashboard_refresh(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "WindowGroupLimit" in plan
    assert sum(len(v) for v in by.values()) == len(rows)
    assert L.dashboard_refresh(df.limit(0)).count() == 0
