"""Declared schemas of the engine's tables."""

from pyspark.sql import types as T

# Parsed (all text) columns, in pattern group order.
PARSED_FIELDS = (
    "ip_address",
    "timestamp_raw",
    "request",
    "status_code",
    "response_size",
    "referrer",
    "user_agent",
    "response_time",
)

# The columns that stored tables and dashboards share.
# The cleaned fact table. Validity flags are booleans.
CLEANED = T.StructType(
    [
        T.StructField("ip_address", T.StringType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("status_code", T.IntegerType(), True),
        T.StructField("response_size", T.IntegerType(), True),
        T.StructField("referrer", T.StringType(), True),
        T.StructField("user_agent", T.StringType(), True),
        T.StructField("response_time", T.IntegerType(), True),
        T.StructField("method", T.StringType(), True),
        T.StructField("endpoint", T.StringType(), True),
        T.StructField("protocol", T.StringType(), True),
        T.StructField("year", T.IntegerType(), True),
        T.StructField("month", T.IntegerType(), True),
        T.StructField("is_valid_timestamp", T.BooleanType(), True),
        T.StructField("is_valid_status", T.BooleanType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("city", T.StringType(), True),
        T.StructField("region", T.StringType(), True),
    ]
)

CLEANED_COLUMNS = tuple(f.name for f in CLEANED.fields)
GEO_COLUMNS = ("country", "city", "region")

# One traffic metric event (JSON messages and the output of traffic_metrics).
METRIC = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("ip_address", T.StringType(), True),
        T.StructField("endpoint", T.StringType(), True),
        T.StructField("request_count", T.IntegerType(), True),
        T.StructField("response_time", T.DoubleType(), True),
    ]
)

# Common shape of every row of the anomaly report.
REPORT = T.StructType(
    [
        T.StructField("category", T.StringType(), False),
        T.StructField("anomaly_type", T.StringType(), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("ip_address", T.StringType(), True),
        T.StructField("subject", T.StringType(), True),
        T.StructField("endpoint", T.StringType(), True),
        T.StructField("event_time", T.StringType(), True),
        T.StructField("count", T.LongType(), True),
        T.StructField("metric", T.DoubleType(), True),
        T.StructField("peak", T.DoubleType(), True),
        T.StructField("threshold", T.DoubleType(), True),
        T.StructField("description", T.StringType(), True),
    ]
)
