"""Streaming ingest: raw lines -> cleaned, located rows -> partitioned Parquet.

The cleaning is the same column expressions as in batch; the location join
is a stream-static join against the range table. The Parquet sink is
exactly-once through its checkpoint and ``_spark_metadata`` log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logsift.functions.clean import clean_logs


def kafka_log_lines(spark: SparkSession, bootstrap_servers: str, topic: str, starting_offsets: str = "latest",
                    **options) -> DataFrame:
    """Kafka topic -> streaming ``log_line`` (needs the Kafka connector on the classpath)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load().selectExpr("CAST(value AS STRING) AS log_line")


def text_log_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New text files in a folder -> streaming ``log_line``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).withColumnRenamed("value", "log_line")


def _trigger(writer, trigger):
    if trigger is None:
        return writer
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def write_cleaned_stream(df: DataFrame, output_path: str, checkpoint_path: str, partition_by=None,
                         trigger: str | None = None, files: int = 8) -> StreamingQuery:
    """Append a streaming frame to Parquet, optionally partitioned (e.g. year, month).

    ``trigger``: None (as fast as possible), 'availableNow', 'once' or an
    interval such as '1 minute' (fewer, larger files). A batch gives each folder
    at most ``files`` files: its rows are dealt to so many tasks by their content.
    """
    if partition_by:
        df = df.repartition(*partition_by, F.pmod(F.xxhash64(*df.columns), F.lit(files)))
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint_path).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _trigger(writer, trigger).start(output_path)


def ingest(lines: DataFrame, ranges: DataFrame | None, output_path: str, checkpoint_path: str,
           partition_by=("year", "month"), trigger: str | None = None, **geo_options) -> StreamingQuery:
    """Raw line stream -> parse, clean, locate -> partitioned Parquet. Returns the running query."""
    return write_cleaned_stream(clean_logs(lines, ranges, **geo_options), output_path, checkpoint_path,
                                partition_by, trigger)


def memory_sink(df: DataFrame, name: str, output_mode: str = "append", trigger: str | None = None) -> StreamingQuery:
    """In-memory table ``name`` for interactive use. No checkpoint: a memory
    sink cannot be restarted from one."""
    writer = df.writeStream.format("memory").queryName(name).outputMode(output_mode)
    return _trigger(writer, trigger).start()
