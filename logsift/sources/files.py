"""Log text and cleaned-Parquet readers."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsift.schemas import CLEANED

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files (one request per line) -> ``log_line``."""
    return spark.read.text(path).withColumnRenamed("value", "log_line")


def write_cleaned(df: DataFrame, path: str, partition_by=("year", "month"), mode: str = "errorifexists") -> None:
    """Write the cleaned table as Parquet partitioned by calendar fields (the
    batch counterpart of the streaming sink). Rows are rebalanced by those
    fields first: a folder gets files of the advisory size, not one a task, and
    a large folder is still written by many tasks. ``partition_by`` may name any
    columns, such as a day."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def read_cleaned(spark: SparkSession, path: str, start=None, end=None, string_flags: bool = False) -> DataFrame:
    """Cleaned logs written by the ingest job, read with the declared schema.

    A missing path gives an empty table with the schema. ``start``/``end``
    (datetime, UTC) add year/month partition predicates next to the timestamp
    predicate, so partitions outside the range are never listed or read.
    ``string_flags`` reads older files that hold the validity flags as texts
    ("true", "false"); other texts become NULL.
    """
    flags = {f.name for f in CLEANED.fields if f.dataType == T.BooleanType()} if string_flags else set()
    stored = T.StructType([T.StructField(f.name, T.StringType()) if f.name in flags else f for f in CLEANED.fields])
    try:
        df = spark.read.schema(stored).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], CLEANED)
        raise
    df = df.withColumns({c: F.col(c).try_cast("boolean") for c in sorted(flags)}) if flags else df
    ym = F.col("year") * 12 + F.col("month")

    def instant(d):  # of a UTC wall clock; a literal, so it reaches the scan
        return F.timestamp_micros(F.lit((d.replace(tzinfo=timezone.utc) - EPOCH) // timedelta(microseconds=1)))

    if start is not None:
        df = df.filter((ym >= start.year * 12 + start.month) & (F.col("timestamp") >= instant(start)))
    if end is not None:
        df = df.filter((ym <= end.year * 12 + end.month) & (F.col("timestamp") < instant(end)))
    return df
