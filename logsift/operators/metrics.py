"""Traffic metrics: the bridge from request rows to per-bucket counts.

The detectors that need ``request_count`` (z-score, rolling window,
clustering, isolation forest) run on this table. Pre-aggregating into time
buckets also bounds every later per-key group by the number of buckets,
however hot a key is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsift.functions.timecols import bucket_start


def traffic_metrics(df: DataFrame, keys: tuple[str, ...] = ("ip_address", "endpoint"),
                    bucket: str = "hour") -> DataFrame:
    """Cleaned rows -> timestamp (bucket start), keys..., request_count, response_time (avg).

    Rows without a valid timestamp have no bucket and are left out (they
    stay visible through ``validity_summary``). request_count is BIGINT.
    """
    return (
        df.filter(F.col("timestamp").isNotNull())
        .groupBy(bucket_start("timestamp", bucket).alias("timestamp"), *keys)
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            F.avg("response_time").alias("response_time"),
        )
    )
