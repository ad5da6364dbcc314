"""Derive access-log inputs from the shared test tables.

``events`` rows become combined-format log lines, one address a user, with
periodic edge lines (malformed ones, offsets, one-digit days, odd requests,
overflowing sizes, users with names, inner quotes, text before the address,
IPv6 addresses, '-' sizes, hostile user agents); ``nation`` x ``region`` becomes
an address range table. Everything is derived by Spark, so work grows with the
tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# English month abbreviations used in log timestamps.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
# Status codes cycled by event id.
STATUSES = ("200", "303", "304", "403", "404", "500", "502")

# First address of the ranges and of the users (10.0.0.0), the odd step between two
# users' addresses (a bijection modulo 2^32, so every user has an own address), the
# width of nation 0's range (nation k has k + 1 times as much) and the gap behind each.
RANGE_BASE = 167772160
USER_STEP = 99991
RANGE_UNIT = 100000
RANGE_GAP = 30000


# Declared schemas of the input tables used here: reading with a schema skips
# the footer-inference job that a schema-less read runs first.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sql_array(values) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


# The adapter as one SQL expression (one plan-building call instead of dozens).
# The time text is built from calendar fields of the TIMESTAMP_NTZ, so it does
# not depend on the session time zone.
_ADDRESS = f"({RANGE_BASE} + user_id * {USER_STEP}) % 4294967296"
_LOG_LINE_SQL = f"""
CASE WHEN event_id % 101 = 0 THEN concat('garbage ', CAST(event_id AS STRING))
ELSE concat(
  CASE WHEN event_id % 43 = 10 THEN 'proxy: ' ELSE '' END,
  CASE WHEN event_id % 53 = 11
    THEN concat('2001:db8:', lower(hex(user_id % 40)), '::', lower(hex(user_id div 65536)), ':', lower(hex(user_id % 65536)))
    ELSE concat(CAST({_ADDRESS} div 16777216 AS STRING), '.', CAST({_ADDRESS} div 65536 % 256 AS STRING), '.',
                CAST({_ADDRESS} div 256 % 256 AS STRING), '.', CAST({_ADDRESS} % 256 AS STRING)) END,
  CASE WHEN event_id % 37 = 8 THEN ' - bob [' ELSE ' - - [' END,
  CASE WHEN event_id % 19 = 4 THEN CAST(day(ts) AS STRING) ELSE lpad(CAST(day(ts) AS STRING), 2, '0') END,
  '/', element_at({_sql_array(MONTHS)}, month(ts)), '/',
  CAST(year(ts) AS STRING), ':', lpad(CAST(hour(ts) AS STRING), 2, '0'), ':',
  lpad(CAST(minute(ts) AS STRING), 2, '0'), ':', lpad(CAST(second(ts) AS STRING), 2, '0'),
  CASE WHEN event_id % 17 = 3 THEN ' +0530] "' ELSE ' +0000] "' END,
  CASE WHEN event_id % 29 = 6 THEN '' WHEN event_id % 23 = 5 THEN 'GET' ELSE concat(
    CASE event_type WHEN 'signup' THEN 'POST' WHEN 'purchase' THEN 'PUT' WHEN 'error' THEN 'DELETE' ELSE 'GET' END,
    ' /usr/', event_type, ' HTTP/1.0') END, '" ',
  element_at({_sql_array(STATUSES)}, CAST(event_id % 7 AS INT) + 1), ' ',
  CASE WHEN event_id % 103 = 0 THEN '-' WHEN event_id % 31 = 7 THEN '99999999999'
       ELSE CAST(CAST(floor(value * 10) AS BIGINT) AS STRING) END,
  ' "-" "',
  CASE WHEN event_id % 97 = 0 THEN 'sqlmap/1.7' WHEN event_id % 89 = 0 THEN 'Nikto/2.5'
       WHEN event_id % 41 = 9 THEN 'Mozilla "5.0" x' ELSE 'Mozilla/5.0' END,
  '" ', CAST(CAST(floor(value * 15) AS BIGINT) AS STRING))
END"""


def event_log_lines(events: DataFrame, keep_id: bool = False) -> DataFrame:
    """events -> one ``log_line`` per event."""
    cols = [F.col("event_id")] if keep_id else []
    return events.select(*cols, F.expr(_LOG_LINE_SQL).alias("log_line"))


def log_lines(spark: SparkSession, sf_dir: str, keep_id: bool = False) -> DataFrame:
    return event_log_lines(table(spark, sf_dir, "events"), keep_id=keep_id)


def nation_ranges(nation: DataFrame, region: DataFrame) -> DataFrame:
    """nation x region -> for each nation an IPv4 range, most of them wider than a
    /16, with gaps between them, and the IPv6 range 2001:db8:<nation>::/48."""
    k = F.col("n_nationkey").cast("long")
    named = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        k.alias("k"), F.col("n_name").alias("country"), F.lit("Unknown").alias("city"), F.col("r_name").alias("region"))
    start = F.lit(RANGE_BASE).cast("long") + F.expr("k * (k + 1) div 2") * RANGE_UNIT
    names = ["country", "city", "region"]
    none, text = F.lit(None).cast("long"), F.lit(None).cast("string")
    head = F.concat(F.lit("20010db8"), F.lpad(F.lower(F.hex("k")), 4, "0"))
    return named.select(
        start.alias("start_ip"), (start + (F.col("k") + 1) * RANGE_UNIT - RANGE_GAP - 1).alias("end_ip"),
        text.alias("start_v6"), text.alias("end_v6"), *names,
    ).unionByName(named.select(
        none.alias("start_ip"), none.alias("end_ip"), F.rpad(head, 32, "0").alias("start_v6"), F.rpad(head, 32, "f").alias("end_v6"), *names))


def geo_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nation_ranges(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"))
