import datetime as dt

import pytest

from conftest import line, lines_df
from logsift.functions.clean import clean_logs
from logsift.operators import analytics as A
from logsift.plans.catalog import export


def df_of(spark):
    items = [line(ip="1.1.1.1", ts="01/Jan/2024:10:15:00 +0000", rt="10", status="200"),
             line(ip="1.1.1.1", ts="01/Jan/2024:10:45:00 +0000", rt="20", status="404"),
             line(ip="2.2.2.2", ts="02/Feb/2024:23:59:59 +0000", rt="30", status="500", request="POST /b HTTP/1.1"),
             "garbage"]
    return clean_logs(lines_df(spark, items))


def test_descriptive_and_overview(spark):
    df = df_of(spark)
    d = A.descriptive_stats(df).collect()[0]
    assert d.avg_response_time == 15.0 and d.total_requests == 3 and d.min_response_time == 0
    o = A.overview(df).collect()[0]
    assert (o.total_requests, o.max_response_time, o.unique_visitors) == (4, 30, 3)


def test_time_buckets(spark, conf):
    conf("spark.sql.session.timeZone", "America/New_York")
    df = df_of(spark)
    hours = {r.hour: r["count"] for r in A.time_based_analysis(df, "hour").collect()}
    assert hours == {dt.datetime(2024, 1, 1, 10): 2, dt.datetime(2024, 2, 2, 23): 1, None: 1}
    months = {r.month: r["count"] for r in A.time_based_analysis(df, "month").collect()}
    assert months == {dt.datetime(2024, 1, 1): 2, dt.datetime(2024, 2, 1): 1, None: 1}
    prof = {r.hour: r.requests for r in A.hourly_profile(df).collect()}
    assert prof == {10: 2, 23: 1, None: 1}
    with pytest.raises(ValueError):
        A.time_based_analysis(df, "week")


def test_top_n_ties_are_deterministic(spark):
    df = df_of(spark)
    top = A.top_n(df, "ip_address", 2).collect()
    assert [(r.ip_address, r["count"]) for r in top] == [("1.1.1.1", 2), ("", 1)]
    ends = A.top_endpoints(df, 1).collect()
    assert ends[0].endpoint == "/usr/admin" and ends[0].requests == 2


def test_distribution_and_classes(spark):
    df = df_of(spark)
    r = A.response_time_distribution(df).collect()[0]
    assert r.median_response_time == 10 and list(r.iqr_response_time) == [0, 20]
    classes = {x.status_class: x["count"] for x in A.status_class_counts(df).collect()}
    assert classes == {"success": 1, "client_error": 1, "server_error": 1, None: 1}
    assert {(x.is_valid_timestamp, x.is_valid_status): x["count"] for x in A.validity_summary(df).collect()} == {
        (True, True): 3, (False, False): 1}


def test_export_is_zone_independent(spark, conf):
    out = []
    for zone in ("UTC", "Asia/Kolkata"):
        conf("spark.sql.session.timeZone", zone)
        out.append(sorted(export(df_of(spark)).select("timestamp").collect(), key=str))
    assert out[0] == out[1]


def test_iso_text_in_dst_gap(spark, conf):
    from logsift.functions.timecols import iso_utc

    conf("spark.sql.session.timeZone", "America/New_York")
    df = clean_logs(lines_df(spark, [line(ts="10/Mar/2024:02:30:00 +0000")]))
    assert df.select(iso_utc("timestamp")).collect()[0][0] == "2024-03-10T02:30:00+00:00"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Australia/Lord_Howe"])
def test_buckets_in_dst_gap(spark, conf, zone):
    from logsift.operators.metrics import traffic_metrics

    conf("spark.sql.session.timeZone", zone)
    df = clean_logs(lines_df(spark, [line(ts="10/Mar/2024:02:30:00 +0000"), line(ts="06/Oct/2024:02:10:00 +0000")]))
    got = sorted(r.timestamp for r in export(traffic_metrics(df, keys=("endpoint",))).collect())
    assert got == [dt.datetime(2024, 3, 10, 2, 0), dt.datetime(2024, 10, 6, 2, 0)]
    hours = sorted(r.hour for r in A.time_based_analysis(df, "hour").collect())
    assert hours == [dt.datetime(2024, 3, 10, 2, 0), dt.datetime(2024, 10, 6, 2, 0)]


def test_read_cleaned_time_range(spark):
    from logsift.session import shared_dir
    from logsift.sources.files import read_cleaned, write_cleaned

    path = shared_dir(spark, "test-range")
    items = [line(ts="31/Jan/2024:23:59:59 +0000"), line(ts="01/Feb/2024:00:00:00 +0000"),
             line(ts="15/Mar/2024:10:00:00 +0000")]
    write_cleaned(clean_logs(lines_df(spark, items), keep=("id",)), path)
    df = read_cleaned(spark, path, start=dt.datetime(2024, 2, 1), end=dt.datetime(2024, 3, 1))
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partitionfilters" in plan.lower()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_utc_instant_round_trip(spark, conf, zone):
    from pyspark.sql import functions as F

    from logsift.functions.timecols import bucket_start, utc_instant, utc_wallclock

    conf("spark.sql.session.timeZone", zone)
    df = clean_logs(lines_df(spark, [line(ts="10/Mar/2024:02:30:07 +0000"), line(ts="31/Jan/2024:23:59:59 -0300")]))
    rows = df.select(F.unix_micros("timestamp").alias("a"), F.unix_micros(utc_instant(utc_wallclock("timestamp"))).alias("b"),
                     F.unix_micros(bucket_start("timestamp", "month")).alias("m")).collect()
    assert all(r.a == r.b for r in rows)
    assert sorted(r.m for r in rows) == [1706745600000000, 1709251200000000]


def test_discrete_quantiles_brute_force(spark):
    import math
    import random

    from pyspark.sql import functions as F

    rnd = random.Random(5)
    for n in (1, 2, 7, 30, 101):
        vals = [rnd.randrange(-20, 50) for _ in range(n)] + [None, None]
        df = spark.createDataFrame([(v,) for v in vals], "x int")
        probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)
        qs = A.discrete_quantiles(df, {"x": probs})["x"]
        got = df.limit(1).select(*[q.alias(f"q{i}") for i, q in enumerate(qs)]).collect()[0]
        data = sorted(v for v in vals if v is not None)
        for i, p in enumerate(probs):
            k = max(1, math.ceil(round(p * len(data), 9)))
            assert got[i] == data[k - 1], (n, p)
        approx = df.select(F.percentile_approx("x", list(probs), 2_000_000_000)).collect()[0][0]
        assert list(approx) == [data[max(1, math.ceil(round(p * len(data), 9))) - 1] for p in probs]


def test_distribution_plan_has_no_sketch_aggregate(spark):
    df = df_of(spark)
    plan = A.response_time_distribution(df)._jdf.queryExecution().executedPlan().toString()
    assert "percentile_approx" not in plan


def test_empty_input_gives_zeros_and_nulls(spark):
    from logsift.operators import detect_rules as R
    from logsift.operators import detect_stats as S
    from logsift.operators.metrics import traffic_metrics

    df = clean_logs(lines_df(spark, [line()])).limit(0)
    o = A.overview(df).collect()[0]
    assert o.total_requests == 0 and o.avg_response_time is None and o.unique_visitors == 0
    d = A.response_time_distribution(df).collect()[0]
    assert d.median_response_time is None and list(d.iqr_response_time) == [None, None]
    assert A.descriptive_stats(df).collect()[0].total_requests == 0
    assert R.slow_requests(df).count() == 0 and R.high_rate_ips(df).count() == 0
    assert R.anomaly_totals(R.anomaly_report(df)).collect()[0].total_anomalies == 0
    assert S.outliers_iqr(df, ["response_time"]).count() == 0
    assert S.z_score(traffic_metrics(df)).count() == 0


def test_fixture_lines_independent_of_zone(spark, conf):
    from conftest import SF_SMALL
    from logsift.sources import fixtures

    out = []
    for zone in ("UTC", "America/New_York"):
        conf("spark.sql.session.timeZone", zone)
        out.append(sorted(r.log_line for r in fixtures.log_lines(spark, SF_SMALL).collect()))
    assert out[0] == out[1] and len(out[0]) == 1000


def test_read_cleaned_with_flags_stored_as_texts(spark, tmp_path):
    from pyspark.sql import functions as F
    from logsift.schemas import CLEANED
    from logsift.sources.files import read_cleaned, write_cleaned

    texts = ["true", "false", "no flag at all", None]
    when = dt.datetime(2024, 2, 3, 4, 5, 6)
    rows = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "flag string, n int")
    values = {"timestamp": F.lit(when), "year": F.lit(2024), "month": F.lit(2), "endpoint": F.col("n").cast("string"),
              "is_valid_timestamp": F.col("flag"), "is_valid_status": F.col("flag")}
    old = rows.select(*[values[f.name].alias(f.name) if f.name in values else F.lit(None).cast(f.dataType).alias(f.name) for f in CLEANED.fields])
    write_cleaned(old, f"{tmp_path}/old")
    got = read_cleaned(spark, f"{tmp_path}/old", start=dt.datetime(2024, 2, 1), string_flags=True)
    assert {f.name: f.dataType for f in got.schema} == {f.name: f.dataType for f in CLEANED.fields}
    assert {r.endpoint: (r.is_valid_timestamp, r.is_valid_status) for r in got.collect()} == {
        "0": (True, True), "1": (False, False), "2": (None, None), "3": (None, None)}
    assert read_cleaned(spark, f"{tmp_path}/none", string_flags=True).schema == CLEANED
