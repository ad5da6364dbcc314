"""Baselines that are kept apart from the rows they judge.

A baseline is stored as moments: for each key and time slice the number of
buckets, the mean of their request counts, the sum of squared deviations from
it, and the first and last bucket. Moments of slices merge exactly (the parallel
variance formula), so a baseline over any set of slices comes from the stored
rows alone, and new rows are judged by joining it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logsift.functions.timecols import bucket_start

KEYS = ("ip_address", "endpoint")


def traffic_moments(metrics: DataFrame, keys: tuple[str, ...] = KEYS, bucket: str = "day",
                    value_col: str = "request_count") -> DataFrame:
    """slice (its start), keys..., n, mean, m2, first_seen, last_seen of metric rows."""
    value = F.col(value_col).cast("double")
    return metrics.filter(value.isNotNull()).groupBy(bucket_start("timestamp", bucket).alias("slice"), *keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * F.count(F.lit(1))).alias("m2"),
        F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen"))


def merge_moments(moments: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One row per key: the moments of all its slices together.

    The deviation of each slice's mean from the common mean is added to what it
    has inside; both steps use one partitioning by the keys."""
    w = Window.partitionBy(*keys)
    total = F.sum("n").over(w)
    apart = F.col("mean") - F.sum(F.col("n") * F.col("mean")).over(w) / total
    step = moments.select(*keys, "n", "mean", (F.col("m2") + F.col("n") * apart * apart).alias("m2"), "first_seen", "last_seen")
    return step.groupBy(*keys).agg(
        F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"), F.sum("m2").alias("m2"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


def baseline(moments: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Merged moments as the columns of ``normal_behavior`` (stddev NULL for one bucket)."""
    std = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    return moments.select(*keys, F.col("mean").alias("avg_request_count"), std.alias("stddev_request_count"), "first_seen", "last_seen")


def score_against(metrics: DataFrame, known: DataFrame, keys: tuple[str, ...] = KEYS, threshold: float = 3.0,
                  floor: float = 1e-9) -> DataFrame:
    """Metric rows with a stored baseline's columns, z_score and anomaly (0/1).

    Keys match NULL-safely; a key without a baseline, with one bucket, or with a
    constant one has no z_score and is no anomaly. A deviation under ``floor`` of
    the mean is rounding, not spread."""
    other = known.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                         *[c for c in known.columns if c not in keys])
    cond = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    out = metrics.join(other, cond, "left").drop(*[f"_k{i}" for i in range(len(keys))])
    spread = F.when(F.col("stddev_request_count") > floor * F.abs(F.col("avg_request_count")), F.col("stddev_request_count"))
    out = out.withColumn("z_score", F.try_divide(F.col("request_count") - F.col("avg_request_count"), spread))
    return out.withColumn("anomaly", F.when(F.abs(F.col("z_score")) > threshold, 1).otherwise(0))
