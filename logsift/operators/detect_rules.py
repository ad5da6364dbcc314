"""Rule-based detectors over the cleaned log table, and the combined report.

Every rule is a filter and/or a grouped count, so it is pushed to the scan
and aggregated map-side; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsift.config import DEFAULT_CONFIG, DetectorConfig
from logsift.functions.timecols import iso_utc
from logsift.schemas import REPORT

# Report category -> severity shown to users.
SEVERITY = {
    "ip": "High",
    "performance": "Medium",
    "security": "Critical",
    "method": "Medium",
    "status": "Medium",
    "geo": "High",
}
# Anomaly type names per category.
TYPE_NAME = {
    "ip": "High Request Rate",
    "performance": "slow_requests",
    "security": "suspicious_user_agents",
    "method": "Suspicious HTTP Method",
    "status": "Suspicious Status Code",
    "geo": "Blocked Country",
}
CATEGORIES = ("ip", "performance", "security", "method", "status", "geo")
# The three lists of the original combined report.
REPORT_LISTS = ("ip", "performance", "security")


def _event_time(ts: str = "timestamp") -> Column:
    return F.coalesce(iso_utc(ts), F.lit("Unknown"))


def agent_pattern(words) -> str:
    """Case-insensitive regex matching any of the words literally."""
    return "(?i)(" + "|".join(r"\Q" + w + r"\E" for w in words) + ")"


def suspicious_methods(df: DataFrame, config: DetectorConfig = DEFAULT_CONFIG) -> DataFrame:
    """Requests whose method is one of the configured ones (case-sensitive)."""
    return df.filter(F.col("method").isin(list(config.suspicious_http_methods))).select(
        F.lit(TYPE_NAME["method"]).alias("type"), "ip_address", "method", "endpoint",
        _event_time().alias("timestamp"),
    )


def high_rate_ips(df: DataFrame, config: DetectorConfig = DEFAULT_CONFIG, limit: int | None = None) -> DataFrame:
    """IPs with more than ``limit`` requests over the whole input ('' counts, NULL does not)."""
    limit = config.max_requests_per_ip if limit is None else limit
    return (
        df.filter(F.col("ip_address").isNotNull())
        .groupBy("ip_address")
        .agg(F.count(F.lit(1)).alias("request_count"))
        .filter(F.col("request_count") > limit)
        .select(F.lit(TYPE_NAME["ip"]).alias("type"), "ip_address", "request_count",
                F.lit(limit).alias("max_allowed_requests"))
    )


def slow_requests(df: DataFrame, config: DetectorConfig = DEFAULT_CONFIG, max_ms: int | None = None) -> DataFrame:
    """One summary row (count, avg, max) of requests slower than ``max_ms``; no row if none."""
    max_ms = config.max_response_time_ms if max_ms is None else max_ms
    return (
        df.filter(F.col("response_time") > max_ms)
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg("response_time").alias("avg_response_time"),
            F.max("response_time").alias("max_response_time"),
        )
        .filter(F.col("count") > 0)
        .select(F.lit(TYPE_NAME["performance"]).alias("type"), "count", "avg_response_time", "max_response_time")
    )


def suspicious_user_agents(df: DataFrame, config: DetectorConfig = DEFAULT_CONFIG) -> DataFrame:
    """Request count per user agent that contains a configured word (any case)."""
    pattern = agent_pattern(config.unusual_user_agents)
    return (
        df.filter(F.col("user_agent").rlike(pattern))
        .groupBy("user_agent")
        .count()
        .select(F.lit(TYPE_NAME["security"]).alias("type"), "user_agent", "count")
    )


def suspicious_status(df: DataFrame, config: DetectorConfig = DEFAULT_CONFIG) -> DataFrame:
    """Requests answered with a configured status code."""
    return df.filter(F.col("status_code").isin(list(config.suspicious_status_codes))).select(
        F.lit(TYPE_NAME["status"]).alias("type"), "ip_address", "status_code", "endpoint",
        _event_time().alias("timestamp"),
    )


def blocked_countries(df: DataFrame, config: DetectorConfig = DEFAULT_CONFIG, countries=None) -> DataFrame:
    """Requests from a configured country (needs location columns); empty list -> no rows."""
    countries = list(config.geoblocking_countries if countries is None else countries)
    cond = F.col("country").isin(countries) if countries else F.lit(False)
    return df.filter(cond).select(
        F.lit(TYPE_NAME["geo"]).alias("type"), "ip_address", "country", "endpoint",
        _event_time().alias("timestamp"),
    )


def anomaly_report(df: DataFrame, config: DetectorConfig = DEFAULT_CONFIG, categories=CATEGORIES,
                   limit: int | None = None, max_ms: int | None = None, countries=None) -> DataFrame:
    """All selected detectors as one table with a common schema (see ``schemas.REPORT``).

    One scan and one shuffle: every request gives an entry for each rule that it
    meets, and entries are counted by what the report shows of them before they
    are shuffled. Requests that show the same are then repeated as often as they
    were counted. The blocked-country rule needs location columns; on a table
    without them it is left out.
    """
    limit = config.max_requests_per_ip if limit is None else limit
    max_ms = config.max_response_time_ms if max_ms is None else max_ms
    countries = list(config.geoblocking_countries if countries is None else countries)
    text = F.lit(None).cast("string")
    rt = F.col("response_time").cast("double")

    def entry(category: str, subject=text, ip=text, endpoint=text, time=text, value=None):
        value = F.lit(None).cast("double") if value is None else value
        return F.struct(F.lit(category).alias("category"), ip.alias("ip_address"), subject.cast("string").alias("subject"),
                        endpoint.alias("endpoint"), time.alias("event_time"), value.alias("value"))

    request = {"ip": F.col("ip_address"), "endpoint": F.col("endpoint"), "time": _event_time()}
    rules = {
        "ip": (F.col("ip_address").isNotNull(), entry("ip", F.col("ip_address"), F.col("ip_address"))),
        "performance": (F.col("response_time") > max_ms, entry("performance", F.lit("response_time"), value=rt)),
        "security": (F.col("user_agent").rlike(agent_pattern(config.unusual_user_agents)), entry("security", F.col("user_agent"))),
        "method": (F.col("method").isin(list(config.suspicious_http_methods)), entry("method", F.col("method"), **request)),
        "status": (F.col("status_code").isin(list(config.suspicious_status_codes)), entry("status", F.col("status_code"), **request)),
    }
    if "country" in df.columns and countries:
        rules["geo"] = (F.col("country").isin(countries), entry("geo", F.col("country"), **request))
    chosen = [F.when(F.coalesce(cond, F.lit(False)), e) for c, (cond, e) in rules.items() if c in categories]
    if not chosen:
        return df.sparkSession.createDataFrame([], REPORT)
    entries = df.select(F.inline(F.filter(F.array(*chosen), lambda e: e.isNotNull())))
    single = F.col("category").isin("method", "status", "geo")
    # Equal requests are counted for each input partition: however many there are, none of the rows
    # that they are repeated from stands for more than a partition holds.
    entries = entries.withColumn("_part", F.when(single, F.spark_partition_id()).otherwise(-1))
    found = entries.groupBy("category", "ip_address", "subject", "endpoint", "event_time", "_part").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("metric"), F.max("value").alias("peak"))
    found = found.filter((F.col("category") != "ip") | (F.col("n") > limit))
    again = F.explode(F.array_repeat(F.lit(0), F.when(single, F.col("n")).otherwise(1).cast("int"))).alias("_again")
    rows = found.select("*", again).withColumn("count", F.when(single, F.lit(1).cast("long")).otherwise(F.col("n")))
    cat = F.col("category")

    def by_category(values: dict):
        return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), cat)

    n = F.col("count").cast("string")
    description = (
        F.when(cat == "ip", F.concat(F.lit("address "), F.col("subject"), F.lit(" made "), n, F.lit(f" requests, more than {limit}")))
        .when(cat == "performance", F.concat(n, F.lit(f" requests took over {max_ms} ms, the longest "),
                                             F.col("peak").cast("long").cast("string"), F.lit(" ms")))
        .when(cat == "security", F.concat(n, F.lit(" requests by agent "), F.col("subject")))
        .when(cat == "method", F.concat(F.lit("method "), F.col("subject"), F.lit(" on "), F.coalesce("endpoint", F.lit("-"))))
        .when(cat == "status", F.concat(F.lit("answered "), F.col("subject"), F.lit(" on "), F.coalesce("endpoint", F.lit("-"))))
        .otherwise(F.concat(F.lit("request from "), F.col("subject"))))
    threshold = F.when(cat == "ip", F.lit(float(limit))).when(cat == "performance", F.lit(float(max_ms)))
    rows = rows.select("*", by_category(TYPE_NAME).alias("anomaly_type"), by_category(SEVERITY).alias("severity"),
                       threshold.alias("threshold"), description.alias("description"))
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in REPORT.fields])


def anomaly_totals(report: DataFrame, lists=REPORT_LISTS) -> DataFrame:
    """One row: entries per category and their total over ``lists``.

    An entry is what the original's JSON list held: one per IP, one for the
    slow-request summary, and one for all suspicious agents together.
    """
    cat = F.col("category")
    counts = {c: F.count_if(cat == c) for c in CATEGORIES}
    entries = {c: (F.least(counts[c], F.lit(1)) if c == "security" else counts[c]) for c in CATEGORIES}
    total = sum((entries[c] for c in lists[1:]), entries[lists[0]]) if lists else F.lit(0)
    return report.agg(
        *[entries[c].alias(f"{c}_anomalies") for c in CATEGORIES],
        total.alias("total_anomalies"),
    )
