"""Batch sources: log text, cleaned Parquet, metric JSON, IP ranges, fixture tables."""
