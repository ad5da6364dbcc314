"""Named queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

Inputs are derived from the shared tables (``events`` -> log lines,
``nation`` x ``region`` -> IP ranges), so every query's work grows with them.
Output instants are shown as their UTC wall clock (TIMESTAMP_NTZ) so the
results do not depend on the session time zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsift.functions.clean import clean_logs
from logsift.functions.parse import parse_lenient, parse_strict
from logsift.functions.timecols import utc_wallclock
from logsift.operators import analytics as A
from logsift.operators import detect_ml as D
from logsift.operators import detect_rules as R
from logsift.operators import detect_stats as S
from logsift.operators import moments as M
from logsift.operators import slices as L
from logsift.operators.metrics import traffic_metrics
from logsift.session import input_state, persist, shared_dir
from logsift.sources import fixtures
from logsift.sources.files import read_cleaned, write_cleaned
from logsift.sources.metrics_json import metrics_to_json, parse_metric_json
from logsift.streaming.detect import final_moments, stream_z_score
from logsift.streaming.ingest import ingest, text_log_lines
from logsift.streaming.table import compact, ingest_table, read_table

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries (chosen so that each gives a
# non-empty answer on the sf0.01 tables; the operators' defaults are the
# original's).
HIGH_RATE_LIMIT = 60
BLOCKED = ("NATION_3", "NATION_7")
ZSCORE_KEYS = ("endpoint",)
ROLLING_KEYS = ("endpoint",)
ROLLING_WINDOW = 11
ROLLING_THRESHOLD = 2.5
KMEANS_K = 3


def export(df: DataFrame) -> DataFrame:
    """Instants -> UTC wall clock (TIMESTAMP_NTZ); other columns unchanged."""
    cols = [
        utc_wallclock(f.name).alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.log_lines(spark, sf_dir)


def cleaned(spark: SparkSession, sf_dir: str, geo: bool = False) -> DataFrame:
    return clean_logs(lines(spark, sf_dir), fixtures.geo_ranges(spark, sf_dir) if geo else None)


# Cleaned tables written by this session: input folder -> (state of the input files, path).
_STORED: dict[tuple[str, str], tuple[tuple, str]] = {}


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned, located log table as the analytics read it: derived from
    the input tables by Spark (parse, clean, locate), written as Parquet
    partitioned by year/month to the shared folder, and read back with its
    declared schema. Runs a job; later calls of the session read the same
    table as long as the input files are the same (names, sizes, times)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    state = input_state(spark, *[f"{key[1]}/{t}.parquet" for t in fixtures.TABLE_SCHEMAS])
    if key not in _STORED or _STORED[key][0] != state:
        path = shared_dir(spark, "cleaned")
        write_cleaned(cleaned(spark, sf_dir, geo=True), path)
        _STORED[key] = (state, path)
    return read_cleaned(spark, _STORED[key][1])


def ingest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch ingest: parse, clean and locate all lines, write partitioned
    Parquet to the shared folder, read it back."""
    path = shared_dir(spark, "ingest")
    write_cleaned(cleaned(spark, sf_dir, geo=True), path)
    return read_cleaned(spark, path)


def metrics(spark: SparkSession, sf_dir: str, keys=("ip_address", "endpoint"), bucket="hour") -> DataFrame:
    return traffic_metrics(stored(spark, sf_dir), keys=keys, bucket=bucket)


def stream_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written as text files, ingested by a streaming query (availableNow)
    into Parquet partitioned by year/month, and read back."""
    base = shared_dir(spark, "stream-roundtrip")
    lines(spark, sf_dir).write.text(f"{base}/lines")
    query = ingest(text_log_lines(spark, f"{base}/lines"), fixtures.geo_ranges(spark, sf_dir), f"{base}/cleaned",
                   f"{base}/checkpoint", partition_by=("year", "month"), trigger="availableNow")
    query.awaitTermination()
    return read_cleaned(spark, f"{base}/cleaned")


def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines ingested by several micro-batches into a table behind a manifest,
    its files compacted, and read back."""
    base = shared_dir(spark, "table-roundtrip")
    lines(spark, sf_dir).repartition(6).write.text(f"{base}/lines")
    query = ingest_table(text_log_lines(spark, f"{base}/lines", max_files_per_trigger=2), fixtures.geo_ranges(spark, sf_dir),
                         f"{base}/table", f"{base}/checkpoint", trigger="availableNow")
    query.awaitTermination()
    compact(spark, f"{base}/table")
    return read_table(spark, f"{base}/table")


def slices_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: exact sums out of the stored hourly slices, and whether the sketches'
    answers lie within their stated errors of the requests' own."""
    df = stored(spark, sf_dir)
    slices = persist(L.traffic_slices(df), "slices")
    seen, spread = L.overview_from_slices(slices), L.distribution_from_slices(slices)
    visitors = seen.select("unique_visitors").scalar()
    values = {0.25: spread.select(F.col("iqr_response_time")[0]).scalar(), 0.5: spread.select("median_response_time").scalar(),
              0.75: spread.select(F.col("iqr_response_time")[1]).scalar()}
    rt = F.col("response_time")
    ranks = [(F.count_if(rt < v) <= (q + L.KLL_ERROR) * F.count(rt)) & (F.count_if(rt <= v) >= (q - L.KLL_ERROR) * F.count(rt)) for q, v in values.items()]
    distinct = F.count_distinct("ip_address")
    return df.agg(
        F.first(seen.select("total_requests").scalar()).alias("total_requests"),
        F.first(seen.select("max_response_time").scalar()).alias("max_response_time"),
        F.first(seen.select("avg_response_time").scalar()).alias("avg_response_time"),
        F.first(seen.select("avg_response_size").scalar()).alias("avg_response_size"),
        (F.abs(F.first(visitors) - distinct) <= 4 * 1.04 / 2 ** (L.HLL_BITS / 2) * distinct).alias("visitors_within"),
        (ranks[0] & ranks[1] & ranks[2]).alias("quantiles_within"))


def stored_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baseline per key, merged from the stored moments of its days."""
    slices = persist(M.traffic_moments(metrics(spark, sf_dir, keys=ZSCORE_KEYS), ZSCORE_KEYS), "moments")
    return M.baseline(M.merge_moments(slices, ZSCORE_KEYS), ZSCORE_KEYS)


def stream_z_score_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON metric messages through the streaming detector; the rows judged again
    by the baselines that the stream ends with."""
    base = shared_dir(spark, "stream-z-score")
    rows = metrics(spark, sf_dir, keys=ZSCORE_KEYS)
    metrics_to_json(rows).repartition(4).write.text(f"{base}/json")
    stream = parse_metric_json(spark.readStream.option("maxFilesPerTrigger", 2).text(f"{base}/json"), "value")
    query = (stream_z_score(stream, ZSCORE_KEYS).writeStream.outputMode("append").format("parquet").trigger(availableNow=True)
             .option("checkpointLocation", f"{base}/checkpoint").start(f"{base}/judged"))
    query.awaitTermination()
    known = M.baseline(final_moments(spark.read.parquet(f"{base}/judged"), ZSCORE_KEYS), ZSCORE_KEYS)
    return M.score_against(rows, known, ZSCORE_KEYS)


def _q(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return export(fn(spark, sf_dir))

    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def _registry() -> dict[str, Query]:
    c = stored  # analytics and detectors: the stored, located table
    raw = cleaned  # parse and ingest: raw lines
    q: dict[str, Query] = {
        # parse / clean / enrich
        "parse_logs": lambda s, d: parse_lenient(lines(s, d)),
        "parse_logs_strict": lambda s, d: parse_strict(lines(s, d)),
        "clean_logs": lambda s, d: raw(s, d, geo=True),
        "geo_enrich": lambda s, d: raw(s, d, geo=True).select("ip_address", "country", "city", "region"),
        "ingest_batch": ingest_batch,
        "status_class": lambda s, d: A.status_class_counts(c(s, d)),
        "validity_summary": lambda s, d: A.validity_summary(c(s, d)),
        # descriptive analytics
        "descriptive_stats": lambda s, d: A.descriptive_stats(c(s, d)),
        "requests_by_hour": lambda s, d: A.time_based_analysis(c(s, d), "hour"),
        "requests_by_day": lambda s, d: A.time_based_analysis(c(s, d), "day"),
        "requests_by_month": lambda s, d: A.time_based_analysis(c(s, d), "month"),
        "top_ips": lambda s, d: A.top_n(c(s, d), "ip_address", 10),
        "top_methods": lambda s, d: A.top_n(c(s, d), "method", 10),
        "top_endpoints_by_count": lambda s, d: A.top_n(c(s, d), "endpoint", 10),
        "response_time_distribution": lambda s, d: A.response_time_distribution(c(s, d)),
        "status_code_trend": lambda s, d: A.status_code_trend(c(s, d)),
        "common_patterns": lambda s, d: A.common_patterns_table(c(s, d)),
        "overview": lambda s, d: A.overview(c(s, d)),
        "hourly_profile": lambda s, d: A.hourly_profile(c(s, d)),
        "status_distribution": lambda s, d: A.status_distribution(c(s, d)),
        "top_endpoints": lambda s, d: A.top_endpoints(c(s, d)),
        "dashboard_refresh": lambda s, d: L.dashboard_refresh(c(s, d)),
        "slices_check": slices_check,
        # metrics and statistical detectors
        "traffic_metrics": lambda s, d: metrics(s, d),
        "json_metrics": lambda s, d: parse_metric_json(metrics_to_json(metrics(s, d))),
        "normal_behavior": lambda s, d: S.normal_behavior(metrics(s, d)),
        "z_score": lambda s, d: S.z_score(metrics(s, d, keys=ZSCORE_KEYS), keys=ZSCORE_KEYS, threshold=3),
        "rolling_anomaly": lambda s, d: S.rolling_anomaly(
            metrics(s, d, keys=ROLLING_KEYS), keys=ROLLING_KEYS, window_size=ROLLING_WINDOW,
            threshold=ROLLING_THRESHOLD),
        # the original's partitioning (per IP over (IP, endpoint) metrics), split by day
        "rolling_anomaly_ip": lambda s, d: S.rolling_anomaly(
            metrics(s, d), keys=("ip_address",), window_size=ROLLING_WINDOW, threshold=ROLLING_THRESHOLD,
            block_seconds=86400),
        "outliers_zscore": lambda s, d: S.outliers_zscore(c(s, d), columns=("response_time",)),
        "outliers_iqr": lambda s, d: S.outliers_iqr(c(s, d), columns=("response_time", "response_size")),
        "z_score_ip": lambda s, d: S.z_score(metrics(s, d), threshold=3),
        "metric_outliers_iqr": lambda s, d: S.statistical_outlier_detection(metrics(s, d), method="iqr"),
        "metric_outliers": lambda s, d: S.outliers_zscore(metrics(s, d)),
        # rule detectors and report
        "suspicious_methods": lambda s, d: R.suspicious_methods(c(s, d)),
        "high_rate_ips": lambda s, d: R.high_rate_ips(c(s, d), limit=HIGH_RATE_LIMIT),
        "slow_requests": lambda s, d: R.slow_requests(c(s, d)),
        "suspicious_user_agents": lambda s, d: R.suspicious_user_agents(c(s, d)),
        "suspicious_status": lambda s, d: R.suspicious_status(c(s, d)),
        "blocked_countries": lambda s, d: R.blocked_countries(c(s, d), countries=BLOCKED),
        "anomaly_report": lambda s, d: R.anomaly_report(c(s, d), limit=HIGH_RATE_LIMIT,
                                                        countries=BLOCKED),
        "anomaly_totals": lambda s, d: R.anomaly_totals(
            R.anomaly_report(c(s, d), limit=HIGH_RATE_LIMIT, countries=BLOCKED)),
        # model-based detectors (no SQL oracle)
        "kmeans_clusters": lambda s, d: D.kmeans_clusters(metrics(s, d), k=KMEANS_K).drop(
            "features", "scaled_features", "centre_distances"),
        "kmeans_check": lambda s, d: D.kmeans_check(D.kmeans_clusters(metrics(s, d), k=KMEANS_K)),
        "isolation_forest": lambda s, d: D.isolation_forest(metrics(s, d)),
        "isolation_forest_check": lambda s, d: D.isolation_forest_check(D.isolation_forest(metrics(s, d))),
        # streaming ingest
        "stream_roundtrip": stream_roundtrip,
        "table_roundtrip": table_roundtrip,
        # baselines kept apart from what they judge
        "stored_baseline": stored_baseline,
        "z_score_stored": lambda s, d: M.score_against(metrics(s, d, keys=ZSCORE_KEYS), stored_baseline(s, d), ZSCORE_KEYS),
        "stream_z_score": stream_z_score_replayed,
    }
    return {k: _q(v) for k, v in q.items()}


QUERIES: dict[str, Query] = _registry()

FLAGSHIP = "overview"
