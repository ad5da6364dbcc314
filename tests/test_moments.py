import datetime as dt
import math
import random
import statistics

from pyspark.sql import functions as F

from logsift.operators import moments as M
from logsift.operators.detect_stats import normal_behavior, z_score
from logsift.session import shared_dir
from logsift.sources.metrics_json import metrics_to_json, parse_metric_json
from logsift.streaming import final_moments, stream_z_score
from logsift.streaming.detect import running

SCHEMA = "timestamp timestamp, ip_address string, endpoint string, request_count int, response_time double"


def rows(seed, n=1500, keys=12, level=0):
    rng = random.Random(seed)
    start = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
    out = []
    for k in range(n):
        key = rng.randrange(keys)
        ip = None if key == 0 else f"ip{key}"
        count = level + (7 if key == 1 else rng.randrange(1, 40) + (400 if rng.random() < 0.004 else 0))
        out.append((start + dt.timedelta(hours=k // 3), ip, f"/e{key % 4}", count, float(rng.randrange(100))))
    return out + [(start, "once", "/e", 5, 1.0)]


def close(a, b):
    return a is None and b is None or a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6)


def by_key(df):
    return {(r.ip_address, r.endpoint): r for r in df.collect()}


def test_merged_slices_equal_one_pass(spark):
    # A high level shows what plain sums of squares would lose.
    for level in (0, 1_000_000_00):
        metrics = spark.createDataFrame(rows(1, level=level), SCHEMA)
        want = by_key(normal_behavior(metrics))
        for bucket in ("hour", "day", "month"):
            slices = M.traffic_moments(metrics, bucket=bucket)
            got = by_key(M.baseline(M.merge_moments(slices)))
            assert got.keys() == want.keys()
            for key, r in got.items():
                w = want[key]
                assert close(r.avg_request_count, w.avg_request_count) and (r.first_seen, r.last_seen) == (w.first_seen, w.last_seen)
                assert close(r.stddev_request_count, w.stddev_request_count)


def test_merging_merged_slices_is_the_same(spark):
    metrics = spark.createDataFrame(rows(2), SCHEMA)
    slices = M.traffic_moments(metrics)
    half = F.dayofmonth("slice") % 2 == 0
    parts = M.merge_moments(slices.filter(half)).unionByName(M.merge_moments(slices.filter(~half)))
    once, twice = by_key(M.merge_moments(slices)), by_key(M.merge_moments(parts))
    assert all(close(once[k].m2, twice[k].m2) and once[k].n == twice[k].n for k in once) and once.keys() == twice.keys()


def test_new_rows_are_judged_by_the_stored_baseline(spark):
    old, new = spark.createDataFrame(rows(3), SCHEMA), spark.createDataFrame(
        [(None, "ip2", "/e2", 4000, 1.0), (None, None, "/e0", 4000, 1.0), (None, "ip1", "/e1", 8, 1.0), (None, "stranger", "/e", 1, 1.0),
         (None, "once", "/e", 900, 1.0), (None, "ip2", "/e2", 20, 1.0)], SCHEMA)
    got = {(r.ip_address, r.request_count): r for r in M.score_against(new, M.baseline(M.merge_moments(M.traffic_moments(old)))).collect()}
    assert len(got) == 6
    assert got["ip2", 4000].anomaly == 1 and got[None, 4000].anomaly == 1 and got["ip2", 20].anomaly == 0
    # Constant, unknown and single-bucket baselines have no spread.
    assert all(got[k].z_score is None and got[k].anomaly == 0 for k in (("ip1", 8), ("stranger", 1), ("once", 900)))
    assert M.score_against(new, M.baseline(M.merge_moments(M.traffic_moments(old.limit(0))))).filter("anomaly = 1").count() == 0
    assert by_key(M.merge_moments(M.traffic_moments(old.limit(0)))) == {}


def test_running_moments_equal_those_of_every_prefix():
    values = [3.0, 3.0, 9.5, -2.0, 1e6, 4.0]
    n, mean, m2 = running(values, 0, 0.0, 0.0)
    for k in range(1, len(values) + 1):
        assert n[k - 1] == k and math.isclose(mean[k - 1], statistics.fmean(values[:k]))
        assert math.isclose(m2[k - 1], statistics.pvariance(values[:k]) * k, abs_tol=1e-6)


def stream(spark, base, name):
    source = parse_metric_json(spark.readStream.option("maxFilesPerTrigger", 1).text(f"{base}/json"), "value")
    query = (stream_z_score(source).writeStream.outputMode("append").format("parquet").trigger(availableNow=True)
             .option("checkpointLocation", f"{base}/c").start(f"{base}/judged"))
    query.awaitTermination()
    assert query.exception() is None
    return spark.read.parquet(f"{base}/judged")


def test_replayed_stream_flags_equal_the_batch_flags(spark):
    base = shared_dir(spark, "test-stream-z")
    metrics = spark.createDataFrame(rows(4, 900), SCHEMA)
    ordered = metrics.orderBy("timestamp").cache()
    half = ordered.limit(400)
    metrics_to_json(half).coalesce(2).write.text(f"{base}/json")
    stream(spark, base, "a")
    # A restart goes on from the stored state.
    metrics_to_json(ordered.exceptAll(half)).coalesce(2).write.mode("append").text(f"{base}/json")
    spark.createDataFrame([("{broken",), ('{"ip_address": "x"}',)], "value string").coalesce(1).write.mode("append").text(f"{base}/json")
    judged = stream(spark, base, "b")
    assert judged.count() == metrics.count()
    last = final_moments(judged)
    want = by_key(M.merge_moments(M.traffic_moments(metrics)))
    got = by_key(last)
    assert got.keys() == want.keys()
    assert all(got[k].n == want[k].n and close(got[k].mean, want[k].mean) and close(got[k].m2, want[k].m2)
               and got[k].first_seen == want[k].first_seen and got[k].last_seen == want[k].last_seen for k in want)
    keep = ["timestamp", "ip_address", "endpoint", "request_count", "anomaly"]
    replayed, batch = M.score_against(metrics, M.baseline(last)).select(keep), z_score(metrics).select(keep)
    assert replayed.exceptAll(batch).count() == 0 and batch.exceptAll(replayed).count() == 0
    assert batch.filter("anomaly = 1").count() > 0


def test_a_row_is_judged_by_the_rows_before_it(spark):
    base = shared_dir(spark, "test-stream-before")
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    counts = [10, 12, 11, 13, 500, 12]
    data = spark.createDataFrame([(start + dt.timedelta(hours=k), "a", "/", c, 1.0) for k, c in enumerate(counts)], SCHEMA)
    metrics_to_json(data.coalesce(1)).write.text(f"{base}/json")
    got = sorted(stream(spark, base, "a").collect(), key=lambda r: r.n)
    assert [r.request_count for r in got] == counts and [r.anomaly for r in got] == [0, 0, 0, 0, 1, 0]
    assert got[0].z_score is None and got[1].z_score is None
    for k in range(2, 6):
        assert math.isclose(got[k].z_score, (counts[k] - statistics.fmean(counts[:k])) / statistics.stdev(counts[:k]))


def test_rolling_flags_batch_after_batch_equal_one_run(spark):
    from logsift.operators.detect_stats import rolling_anomaly, rolling_anomaly_next, rolling_tails

    metrics = spark.createDataFrame(rows(6, 600, keys=5), SCHEMA).cache()
    keys = ("ip_address", "endpoint")
    cut = [dt.datetime(2024, 3, d, tzinfo=dt.timezone.utc) for d in (1, 3, 4, 7)] + [dt.datetime(2030, 1, 1, tzinfo=dt.timezone.utc)]
    for options in ({}, {"block_seconds": 3600 * 7}, {"include_current": False}):
        want = rolling_anomaly(metrics, keys, 11, 2.0, **options)
        got, tails = None, metrics.limit(0)
        for lo, hi in zip(cut, cut[1:]):
            batch = metrics.filter((F.col("timestamp") >= F.lit(lo)) & (F.col("timestamp") < F.lit(hi)))
            out = rolling_anomaly_next(batch, tails, keys, 11, threshold=2.0, **options)
            got = out if got is None else got.unionByName(out)
            tails = rolling_tails(tails.unionByName(batch), keys, 11)
        columns = ["timestamp", "ip_address", "endpoint", "request_count", "response_time", "time_series_anomaly"]
        shown = lambda df: df.select(*columns, F.round("rolling_mean", 6), F.round("rolling_std", 6))
        assert shown(got).exceptAll(shown(want)).count() == 0 and shown(want).exceptAll(shown(got)).count() == 0
        assert want.filter("time_series_anomaly = 1").count() > 0
    assert tails.groupBy(*keys).count().agg(F.max("count")).first()[0] == 11
