"""Dashboards from stored hourly slices, and all panels of a refresh in one scan.

A slice is one row for each UTC hour: exact sums, and three mergeable sketches:
HyperLogLog of the visitors, KLL of the response times, and frequent-item
sketches of address and endpoint. A question over any range of hours merges the
slices' rows and never reads a request again. Slices of new hours are appended;
the same hour in several slices (late rows, several writers) merges as well.

Errors, stated by the sketches: distinct visitors have a relative standard error
of 1.04 / sqrt(2 ** HLL_BITS); a quantile's rank is off by at most about
KLL_ERROR at 99 % confidence; a heavy hitter's estimate is never below its true
count and at most ``over`` above it, so every value more frequent than that is
found.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logsift.functions.timecols import bucket_start, trunc_utc, utc_wallclock

# 4,096 registers: 1.6 % standard error.
HLL_BITS = 12
# Parameter of the quantile sketches, and the rank error that it gives.
KLL_K, KLL_ERROR = 400, 0.01
# Places of a frequent-item sketch (a power of two follows from it inside the sketch).
TOP_PLACES = 1024


def traffic_slices(df: DataFrame, bucket: str = "hour") -> DataFrame:
    """One row per hour of the cleaned table: slice, requests, counts and sums of response
    times and sizes, the longest response, and the sketches."""
    rt, size = F.col("response_time").cast("long"), F.col("response_size").cast("long")
    return df.groupBy(bucket_start("timestamp", bucket).alias("slice")).agg(
        F.count(F.lit(1)).alias("requests"), F.count(rt).alias("timed"), F.sum(rt).alias("time_sum"), F.max(rt).alias("time_max"),
        F.count(size).alias("sized"), F.sum(size).alias("size_sum"),
        F.hll_sketch_agg("ip_address", F.lit(HLL_BITS)).alias("visitors"),
        F.kll_sketch_agg_bigint(rt, F.lit(KLL_K)).alias("times"),
        F.expr(f"approx_top_k_accumulate(ip_address, {TOP_PLACES})").alias("top_ip"),
        F.expr(f"approx_top_k_accumulate(endpoint, {TOP_PLACES})").alias("top_endpoint"))


def _between(slices: DataFrame, start, end) -> DataFrame:
    """Slices that begin in [start, end); None leaves a side open."""
    if start is not None:
        slices = slices.filter(F.col("slice") >= F.lit(start))
    return slices if end is None else slices.filter(F.col("slice") < F.lit(end))


def overview_from_slices(slices: DataFrame, start=None, end=None) -> DataFrame:
    """The columns of ``analytics.overview``; unique_visitors is the sketch's estimate."""
    return _between(slices, start, end).agg(
        F.coalesce(F.sum("requests"), F.lit(0)).alias("total_requests"),
        F.try_divide(F.sum("time_sum").cast("double"), F.sum("timed")).alias("avg_response_time"),
        F.max("time_max").alias("max_response_time"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("visitors")), F.lit(0)).alias("unique_visitors"),
        F.try_divide(F.sum("size_sum").cast("double"), F.sum("sized")).alias("avg_response_size"))


def distribution_from_slices(slices: DataFrame, start=None, end=None) -> DataFrame:
    """The columns of ``analytics.response_time_distribution`` from the merged quantile
    sketches; NULL where no slice holds a response time."""
    some = _between(slices, start, end).filter("timed > 0")
    merged = some.agg(F.count(F.lit(1)).alias("n"), F.kll_merge_agg_bigint("times").alias("times"))
    value = {q: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_bigint("times", F.lit(q))) for q in (0.25, 0.5, 0.75)}
    return merged.select(value[0.5].alias("median_response_time"), F.array(value[0.25], value[0.75]).alias("iqr_response_time"))


def heavy_from_slices(slices: DataFrame, column: str = "top_ip", k: int = 10, start=None, end=None) -> DataFrame:
    """(item, count) of the k most frequent values in the merged frequent-item sketches."""
    merged = _between(slices, start, end).agg(F.expr(f"approx_top_k_combine({column}, {TOP_PLACES})").alias("top"))
    found = merged.select(F.explode(F.expr(f"approx_top_k_estimate(top, {int(k)})")).alias("x"))
    return found.select(F.col("x.item").alias("item"), F.col("x.count").alias("count"))


# Panels by the columns that they group by.
PANELS = {"summary": (), "hourly": ("hour",), "status": ("status_code",), "trend": ("day", "status_code"),
          "top_ips": ("ip_address",), "top_methods": ("method",), "top_endpoints": ("endpoint",)}
_KEYS = ("hour", "day", "status_code", "ip_address", "method", "endpoint")


def dashboard_refresh(df: DataFrame, n: int = 10) -> DataFrame:
    """All panels of a dashboard in one scan: panel, its keys (the others NULL), and
    requests, answered (with a status), and avg/stddev/min/max of response_time.

    A row is counted once for each grouping set and combined before the one
    shuffle. The top panels keep their first n rows: the limit on the rank is
    applied in every task before rows meet. Rows of other panels are windows of
    their own, so nothing but top rows is gathered."""
    rt = F.col("response_time")
    rows = df.select(F.hour(utc_wallclock("timestamp")).alias("hour"), trunc_utc("timestamp", "day").alias("day"),
                     "status_code", "ip_address", "method", "endpoint", "response_time")
    # The answers counted for a status panel would be its own key: a copy stays countable.
    rows = rows.withColumn("_answered", F.col("status_code").isNotNull())
    sets = [[F.col(c) for c in keys] for keys in PANELS.values()]
    counted = rows.groupingSets(sets, *[F.col(c) for c in _KEYS]).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("requests"), F.count_if("_answered").alias("answered"),
        F.avg(rt).alias("avg_response_time"), F.stddev(rt).alias("stddev_response_time"),
        F.min(rt).alias("min_response_time"), F.max(rt).alias("max_response_time"))
    # Bit i (from the left) of a grouping id is set if key i is not grouped by.
    number = {name: sum(1 << (len(_KEYS) - 1 - i) for i, c in enumerate(_KEYS) if c not in keys) for name, keys in PANELS.items()}
    panel = F.coalesce(*[F.when(F.col("_set") == k, F.lit(name)) for name, k in number.items()])
    top = F.col("panel").startswith("top_")
    group = F.when(top, F.col("panel")).otherwise(F.concat_ws(
        "|", "panel", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("hour", "day", "status_code")]))
    order = [F.col("requests").desc(), *[F.col(c).asc_nulls_first() for c in ("ip_address", "method", "endpoint")]]
    ranked = counted.withColumn("panel", panel).withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    # A table without rows has no panels, not a summary of nothing.
    return ranked.filter(F.col("_rank") <= n).filter("requests > 0").select(
        "panel", *_KEYS, "requests", "answered", "avg_response_time", "stddev_response_time", "min_response_time", "max_response_time")
