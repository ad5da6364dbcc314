"""A hot key holding a third of all rows must not end up in one task."""

from pyspark.sql import functions as F

from conftest import line, lines_df
from logsift.functions.clean import clean_logs
from logsift.operators import detect_rules as R
from logsift.operators import geo
from logsift.operators.geo import geo_enrich
from logsift.operators.metrics import traffic_metrics
from logsift.sources.geo import ranges_from_cidr


def skewed(spark, n=3000):
    items = []
    for i in range(n):
        ip = "10.0.1.7" if i % 3 == 0 else f"10.{i % 200}.{i % 13}.{i % 250}"
        items.append(line(ip=ip, ts=f"01/Jan/2024:{i % 24:02d}:{i % 60:02d}:00 +0000", rt=str(i)))
    return clean_logs(lines_df(spark, items))


def test_a_hot_address_meets_the_ranges_once(spark, monkeypatch):
    ranges = ranges_from_cidr(spark.createDataFrame([("10.0.0.0/16", "A", "c", "r")],
                                                    "network string, country string, city string, region string"))
    want = 1000 + sum(1 for i in range(3000) if i % 3 and i % 200 == 0)
    for limit in (1 << 20, 0):
        out = geo_enrich(skewed(spark), ranges, max_bytes=limit)
        assert out.filter(F.col("country") == "A").count() == want
    # The merge gets every address once.
    seen = []
    locate = geo.locate
    monkeypatch.setattr(geo, "locate", lambda addresses, *rest: (seen.append(addresses), locate(addresses, *rest))[1])
    geo_enrich(skewed(spark), ranges, max_bytes=0)
    assert seen[0].count() == seen[0].distinct().count() == skewed(spark).select("ip_address").distinct().count()


def test_per_key_detectors_aggregate_before_the_shuffle(spark):
    df = skewed(spark)
    for out in (R.high_rate_ips(df, limit=500), traffic_metrics(df), R.suspicious_user_agents(df)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "partial_count" in plan
    hot = R.high_rate_ips(df, limit=500).collect()
    assert [(r.ip_address, r.request_count) for r in hot] == [("10.0.1.7", 1000)]


def test_equal_requests_of_a_report_are_spread_over_tasks(spark, conf):
    """One request repeated very often is repeated again from a row for each input partition."""
    one = clean_logs(lines_df(spark, [line(request="DELETE /x HTTP/1.0", status="404")]))
    many = one.select("*", F.explode(F.sequence(F.lit(1), F.lit(40_000))).alias("_k")).drop("_k")
    report = R.anomaly_report(many.repartition(16), limit=10)
    rows = report.filter("category = 'method'")
    assert rows.count() == 40_000 and rows.distinct().count() == 1
    assert report.filter("category = 'ip'").collect()[0]["count"] == 40_000
    conf("spark.sql.adaptive.enabled", "false")  # tiny partitions are put together otherwise
    report = R.anomaly_report(many.repartition(16), limit=10).filter("category = 'method'")
    spread = report.withColumn("_task", F.spark_partition_id()).groupBy("_task").count().collect()
    assert len(spread) > 4 and max(r["count"] for r in spread) < 20_000
