"""JSON traffic-metric messages -> typed metric rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsift.schemas import METRIC


def parse_metric_json(df: DataFrame, json_col: str = "json") -> DataFrame:
    """One JSON object per row -> timestamp, ip_address, endpoint, request_count, response_time.

    Malformed JSON gives an all-NULL row; a wrongly typed field gives NULL in
    that field only.
    """
    return df.select(F.from_json(F.col(json_col), METRIC, {"mode": "PERMISSIVE"}).alias("data")).select("data.*")


def metrics_to_json(metrics: DataFrame) -> DataFrame:
    """Metric rows -> one JSON text per row (column ``json``)."""
    cols = [c for c in METRIC.fieldNames() if c in metrics.columns]
    return metrics.select(F.to_json(F.struct(*cols)).alias("json"))
