"""Structured Streaming sources, sinks and keyed detectors."""

from logsift.streaming.detect import final_moments, stream_z_score
from logsift.streaming.ingest import (
    ingest,
    kafka_log_lines,
    memory_sink,
    text_log_lines,
    write_cleaned_stream,
)
from logsift.streaming.table import compact, ingest_table, read_table, vacuum, write_table_stream

__all__ = ["compact", "final_moments", "ingest", "ingest_table", "kafka_log_lines", "memory_sink", "read_table", "stream_z_score",
           "text_log_lines", "vacuum", "write_cleaned_stream", "write_table_stream"]
