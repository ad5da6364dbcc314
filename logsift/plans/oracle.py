"""DuckDB SQL equivalents of the named queries (the correctness oracle).

Each string is one statement over the pre-registered tables. The shared CTEs
repeat the adapter and the cleaning rules in DuckDB's dialect; timestamps are
UTC wall clock (TIMESTAMP), like the Spark queries' output.
"""

from __future__ import annotations

from logsift.functions.parse import LENIENT_PATTERN, STRICT_PATTERN
from logsift.plans import catalog as C
from logsift.sources.fixtures import RANGE_BASE, RANGE_GAP, RANGE_UNIT, USER_STEP

_P1 = LENIENT_PATTERN
_P2 = "^" + STRICT_PATTERN

_ADDRESS = f"((({RANGE_BASE} + user_id * {USER_STEP}) % 4294967296))"
_LINES = f"""lines AS MATERIALIZED (
  SELECT CASE WHEN event_id % 101 = 0 THEN 'garbage ' || CAST(event_id AS VARCHAR)
  ELSE CASE WHEN event_id % 43 = 10 THEN 'proxy: ' ELSE '' END
    || CASE WHEN event_id % 53 = 11
         THEN '2001:db8:' || printf('%x', user_id % 40) || '::' || printf('%x', user_id // 65536) || ':' || printf('%x', user_id % 65536)
         ELSE concat_ws('.', {_ADDRESS} // 16777216, {_ADDRESS} // 65536 % 256, {_ADDRESS} // 256 % 256, {_ADDRESS} % 256) END
    || CASE WHEN event_id % 37 = 8 THEN ' - bob [' ELSE ' - - [' END
    || CASE WHEN event_id % 19 = 4 THEN CAST(day(ts) AS VARCHAR) ELSE strftime(ts, '%d') END
    || strftime(ts, '/%b/%Y:%H:%M:%S') || CASE WHEN event_id % 17 = 3 THEN ' +0530] "' ELSE ' +0000] "' END
    || CASE WHEN event_id % 29 = 6 THEN '' WHEN event_id % 23 = 5 THEN 'GET' ELSE
         CASE event_type WHEN 'signup' THEN 'POST' WHEN 'purchase' THEN 'PUT' WHEN 'error' THEN 'DELETE' ELSE 'GET' END
         || ' /usr/' || event_type || ' HTTP/1.0' END || '" '
    || (['200','303','304','403','404','500','502'])[CAST(event_id % 7 AS INTEGER) + 1] || ' '
    || CASE WHEN event_id % 103 = 0 THEN '-' WHEN event_id % 31 = 7 THEN '99999999999'
            ELSE CAST(CAST(floor(value * 10) AS BIGINT) AS VARCHAR) END
    || ' "-" "' || CASE WHEN event_id % 97 = 0 THEN 'sqlmap/1.7' WHEN event_id % 89 = 0 THEN 'Nikto/2.5'
                        WHEN event_id % 41 = 9 THEN 'Mozilla "5.0" x' ELSE 'Mozilla/5.0' END
    || '" ' || CAST(CAST(floor(value * 15) AS BIGINT) AS VARCHAR) END AS log_line
  FROM events)"""

_FIELDS = ("ip_address", "timestamp_raw", "request", "status_code", "response_size", "referrer", "user_agent",
           "response_time")

_PARSED = "parsed AS MATERIALIZED (\n  SELECT " + ",\n    ".join(
    f"regexp_extract(log_line, '{_P1}', {i + 1}) AS {n}" for i, n in enumerate(_FIELDS)
) + "\n  FROM lines)"

_CLEANED = r"""cleaned AS MATERIALIZED (
  SELECT ip_address, ts AS "timestamp", status_code, response_size, referrer, user_agent, response_time,
    method, endpoint, protocol,
    CAST(year(ts) AS INTEGER) AS "year", CAST(month(ts) AS INTEGER) AS "month",
    ts IS NOT NULL AS is_valid_timestamp, status_code IS NOT NULL AS is_valid_status
  FROM (
    SELECT ip_address,
      CASE WHEN length(timestamp_raw) > 0
           THEN try_strptime(timestamp_raw, '%d/%b/%Y:%H:%M:%S %z') AT TIME ZONE 'UTC' END AS ts,
      CASE WHEN regexp_matches(status_code, '^\d{3}$') THEN TRY_CAST(status_code AS INTEGER) END AS status_code,
      CASE WHEN regexp_matches(response_size, '^\d+$') THEN TRY_CAST(response_size AS INTEGER) ELSE 0 END
        AS response_size,
      referrer, user_agent,
      CASE WHEN regexp_matches(response_time, '^\d+$') THEN TRY_CAST(response_time AS INTEGER) ELSE 0 END
        AS response_time,
      CASE WHEN length(request) > 0 THEN regexp_extract(request, '^(\S+)', 1) END AS method,
      CASE WHEN length(request) > 0 THEN regexp_extract(request, '^\S+\s(\S+)', 1) END AS endpoint,
      CASE WHEN length(request) > 0 THEN regexp_extract(request, '(\S+)$', 1) END AS protocol
    FROM parsed) t)"""

_GEO = rf"""ranges AS MATERIALIZED (
  SELECT n_nationkey AS k, CAST({RANGE_BASE} + n_nationkey * (n_nationkey + 1) // 2 * {RANGE_UNIT} AS BIGINT) AS start_ip,
         CAST({RANGE_BASE} + n_nationkey * (n_nationkey + 1) // 2 * {RANGE_UNIT} + (n_nationkey + 1) * {RANGE_UNIT}
              - {RANGE_GAP} - 1 AS BIGINT) AS end_ip,
         n_name AS country, 'Unknown' AS city, r_name AS region
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
ipnum AS MATERIALIZED (
  SELECT *, CASE WHEN regexp_matches(ip_address, '^\d+\.\d+\.\d+\.\d+$')
    THEN CAST(split_part(ip_address, '.', 1) AS BIGINT) * 16777216
       + CAST(split_part(ip_address, '.', 2) AS BIGINT) * 65536
       + CAST(split_part(ip_address, '.', 3) AS BIGINT) * 256
       + CAST(split_part(ip_address, '.', 4) AS BIGINT) END AS ip_num,
    CASE WHEN starts_with(ip_address, '2001:db8:') THEN split_part(ip_address, ':', 3) END AS net
  FROM cleaned),
located AS MATERIALIZED (
  SELECT ip_address, any_value(r.country) AS country, any_value(r.city) AS city, any_value(r.region) AS region
  FROM (SELECT DISTINCT ip_address, ip_num, net FROM ipnum) a
  JOIN ranges r ON a.ip_num BETWEEN r.start_ip AND r.end_ip OR a.net = printf('%x', r.k) GROUP BY ip_address),
cleaned_geo AS MATERIALIZED (
  SELECT c.*, coalesce(r.country, 'Unknown') AS country,
         coalesce(r.city, 'Unknown') AS city, coalesce(r.region, 'Unknown') AS region
  FROM cleaned c LEFT JOIN located r USING (ip_address))"""


def _metrics_cte(name: str, keys: tuple[str, ...], count_type: str = "BIGINT") -> str:
    k = ", ".join(keys)
    return f"""{name} AS MATERIALIZED (
  SELECT date_trunc('hour', "timestamp") AS "timestamp", {k},
         CAST(count(*) AS {count_type}) AS request_count, avg(response_time) AS response_time
  FROM cleaned WHERE "timestamp" IS NOT NULL
  GROUP BY date_trunc('hour', "timestamp"), {k})"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join((_LINES, _PARSED, _CLEANED) + ctes) + "\n"


def _top(col: str, n: int = 10) -> str:
    return (f"SELECT {col}, count(*) AS count FROM cleaned GROUP BY {col} "
            f"ORDER BY count DESC, {col} ASC NULLS FIRST LIMIT {n}")


def _iso(ts: str = '"timestamp"') -> str:
    return f"coalesce(strftime({ts}, '%Y-%m-%dT%H:%M:%S+00:00'), 'Unknown')"


_METHODS = "('DELETE', 'PUT')"
_STATUSES = "(401, 403, 500, 502, 503)"
_AGENTS = "'(?i)(sqlmap|nikto|nmap)'"
_BLOCKED = "(" + ", ".join(f"'{c}'" for c in C.BLOCKED) + ")"


def _report_sql() -> str:
    lim = C.HIGH_RATE_LIMIT
    return f"""
  SELECT 'ip' AS category, 'High Request Rate' AS anomaly_type, 'High' AS severity, ip_address,
         ip_address AS subject, CAST(NULL AS VARCHAR) AS endpoint, CAST(NULL AS VARCHAR) AS event_time,
         count(*) AS count, CAST(NULL AS DOUBLE) AS metric, CAST(NULL AS DOUBLE) AS peak,
         CAST({lim} AS DOUBLE) AS threshold,
         'address ' || ip_address || ' made ' || count(*) || ' requests, more than {lim}' AS description
  FROM cleaned_geo WHERE ip_address IS NOT NULL GROUP BY ip_address HAVING count(*) > {lim}
  UNION ALL
  SELECT 'performance', 'slow_requests', 'Medium', NULL, 'response_time', NULL, NULL, count(*),
         avg(response_time), CAST(max(response_time) AS DOUBLE), 5000.0,
         count(*) || ' requests took over 5000 ms, the longest ' || max(response_time) || ' ms'
  FROM cleaned_geo WHERE response_time > 5000 HAVING count(*) > 0
  UNION ALL
  SELECT 'security', 'suspicious_user_agents', 'Critical', NULL, user_agent, NULL, NULL, count(*),
         NULL, NULL, NULL, count(*) || ' requests by agent ' || user_agent
  FROM cleaned_geo WHERE regexp_matches(user_agent, {_AGENTS}) GROUP BY user_agent
  UNION ALL
  SELECT 'method', 'Suspicious HTTP Method', 'Medium', ip_address, method, endpoint, {_iso()}, 1,
         NULL, NULL, NULL, 'method ' || method || ' on ' || coalesce(endpoint, '-')
  FROM cleaned_geo WHERE method IN {_METHODS}
  UNION ALL
  SELECT 'status', 'Suspicious Status Code', 'Medium', ip_address, CAST(status_code AS VARCHAR), endpoint,
         {_iso()}, 1, NULL, NULL, NULL, 'answered ' || status_code || ' on ' || coalesce(endpoint, '-')
  FROM cleaned_geo WHERE status_code IN {_STATUSES}
  UNION ALL
  SELECT 'geo', 'Blocked Country', 'High', ip_address, country, endpoint, {_iso()}, 1, NULL, NULL, NULL,
         'request from ' || country
  FROM cleaned_geo WHERE country IN {_BLOCKED}"""


def _sql() -> dict[str, str]:
    w = _with()
    wg = _with(_GEO)
    q = {}
    q["parse_logs"] = "WITH " + ",\n".join((_LINES, _PARSED)) + "\nSELECT * FROM parsed"
    q["parse_logs_strict"] = "WITH " + _LINES + ",\n" + rf"""strict AS (
  SELECT regexp_extract(log_line, '{_P2}', 1) AS ip_address,
         regexp_extract(log_line, '{_P2}', 2) AS timestamp_raw,
         regexp_extract(log_line, '{_P2}', 3) AS request,
         regexp_extract(log_line, '{_P2}', 4) AS status_code,
         regexp_extract(log_line, '{_P2}', 5) AS response_size,
         regexp_extract(log_line, '{_P2}', 6) AS referrer,
         regexp_extract(log_line, '{_P2}', 7) AS user_agent,
         regexp_extract(log_line, '{_P2}', 8) AS response_time,
         string_split_regex(trim(regexp_extract(log_line, '{_P2}', 3)), '\s+') AS tok
  FROM lines WHERE regexp_matches(log_line, '{_P2}'))
SELECT ip_address,
  try_strptime(timestamp_raw, '%d/%b/%Y:%H:%M:%S %z') AT TIME ZONE 'UTC' AS "timestamp",
  CASE WHEN length(request) > 0 THEN tok[1] END AS method,
  CASE WHEN length(request) > 0 THEN tok[2] END AS endpoint,
  CASE WHEN length(request) > 0 THEN tok[3] END AS protocol,
  TRY_CAST(status_code AS INTEGER) AS status_code, TRY_CAST(response_size AS INTEGER) AS response_size,
  referrer, user_agent, TRY_CAST(response_time AS INTEGER) AS response_time
FROM strict WHERE length(request) = 0 OR len(tok) = 3"""
    q["clean_logs"] = wg + "SELECT * FROM cleaned_geo"
    q["geo_enrich"] = wg + "SELECT ip_address, country, city, region FROM cleaned_geo"
    q["status_class"] = w + """SELECT CASE WHEN status_code IS NULL THEN NULL WHEN status_code < 300 THEN 'success'
  WHEN status_code < 400 THEN 'redirect' WHEN status_code < 500 THEN 'client_error'
  ELSE 'server_error' END AS status_class, count(*) AS count FROM cleaned GROUP BY 1"""
    q["validity_summary"] = w + ("SELECT is_valid_timestamp, is_valid_status, count(*) AS count FROM cleaned "
                                 "GROUP BY 1, 2")
    q["descriptive_stats"] = w + """SELECT avg(response_time) AS avg_response_time,
  stddev_samp(response_time) AS stddev_response_time, min(response_time) AS min_response_time,
  max(response_time) AS max_response_time, count(status_code) AS total_requests FROM cleaned"""
    for unit in ("hour", "day", "month"):
        q[f"requests_by_{unit}"] = w + (f"""SELECT date_trunc('{unit}', "timestamp") AS "{unit}", count(*) AS count """
                                        f"FROM cleaned GROUP BY 1 ORDER BY 1")
    q["top_ips"] = w + _top("ip_address")
    q["top_methods"] = w + _top("method")
    q["top_endpoints_by_count"] = w + _top("endpoint")
    q["response_time_distribution"] = w + """SELECT quantile_disc(response_time, 0.5) AS median_response_time,
  quantile_disc(response_time, [0.25, 0.75]) AS iqr_response_time FROM cleaned"""
    q["status_code_trend"] = w + """SELECT date_trunc('day', "timestamp") AS "day", status_code, count(*) AS count
  FROM cleaned GROUP BY 1, 2 ORDER BY 1, 2"""
    q["common_patterns"] = w + " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{c}' AS dimension, {c} AS value, count(*) AS count FROM cleaned GROUP BY {c} "
        f"ORDER BY count DESC, {c} ASC NULLS FIRST LIMIT 10)"
        for c in ("ip_address", "method", "endpoint")
    )
    q["overview"] = w + """SELECT count(*) AS total_requests, avg(response_time) AS avg_response_time,
  max(response_time) AS max_response_time, count(DISTINCT ip_address) AS unique_visitors,
  avg(response_size) AS avg_response_size FROM cleaned"""
    q["hourly_profile"] = w + """SELECT CAST(hour("timestamp") AS INTEGER) AS "hour", count(*) AS requests,
  avg(response_time) AS avg_response_time FROM cleaned GROUP BY 1 ORDER BY 1"""
    q["status_distribution"] = w + "SELECT status_code, count(*) AS count FROM cleaned GROUP BY 1"
    q["top_endpoints"] = w + """SELECT endpoint, count(*) AS requests, avg(response_time) AS avg_response_time
  FROM cleaned GROUP BY endpoint ORDER BY requests DESC, endpoint ASC NULLS FIRST LIMIT 10"""
    measures = """count(*) AS requests, count(status_code) AS answered, avg(response_time) AS avg_response_time,
  stddev_samp(response_time) AS stddev_response_time, min(response_time) AS min_response_time, max(response_time) AS max_response_time"""
    keys = {"hour": 'CAST(hour("timestamp") AS INTEGER)', "day": """date_trunc('day', "timestamp")""", "status_code": "status_code",
            "ip_address": "ip_address", "method": "method", "endpoint": "endpoint"}
    kinds = {"hour": "INTEGER", "day": "TIMESTAMP", "status_code": "INTEGER"}

    def panel(name, own):
        listed = ", ".join(f'{keys[k] if k in own else f"CAST(NULL AS {kinds.get(k, 'VARCHAR')})"} AS "{k}"' for k in keys)
        top = f"ORDER BY requests DESC, {own[0]} ASC NULLS FIRST LIMIT 10" if name.startswith("top_") else ""
        return f"SELECT * FROM (SELECT '{name}' AS panel, {listed}, {measures} FROM cleaned {'GROUP BY ALL' if own else ''} {top})"

    q["dashboard_refresh"] = w + " UNION ALL ".join(panel(name, own) for name, own in {
        "summary": (), "hourly": ("hour",), "status": ("status_code",), "trend": ("day", "status_code"), "top_ips": ("ip_address",),
        "top_methods": ("method",), "top_endpoints": ("endpoint",)}.items())
    q["slices_check"] = w + """SELECT count(*) AS total_requests, max(response_time) AS max_response_time,
  avg(response_time) AS avg_response_time, avg(response_size) AS avg_response_size, TRUE AS visitors_within, TRUE AS quantiles_within FROM cleaned"""
    # metrics and statistical detectors
    m = ("ip_address", "endpoint")
    q["traffic_metrics"] = _with(_metrics_cte("metrics", m)) + "SELECT * FROM metrics"
    q["json_metrics"] = _with(_metrics_cte("metrics", m, "INTEGER")) + (
        'SELECT "timestamp", ip_address, endpoint, request_count, response_time FROM metrics')
    q["normal_behavior"] = _with(_metrics_cte("metrics", m)) + """SELECT ip_address, endpoint,
  avg(request_count) AS avg_request_count, stddev_samp(request_count) AS stddev_request_count,
  min("timestamp") AS first_seen, max("timestamp") AS last_seen FROM metrics GROUP BY ip_address, endpoint"""
    zk = ", ".join(C.ZSCORE_KEYS)
    q["z_score"] = _with(_metrics_cte("metrics", C.ZSCORE_KEYS)) + f"""SELECT *,
  CASE WHEN abs(z_score) > 3 THEN 1 ELSE 0 END AS anomaly FROM (
  SELECT *, (request_count - avg_request_count) / nullif(stddev_request_count, 0) AS z_score FROM (
    SELECT *, avg(request_count) OVER w AS avg_request_count, stddev_samp(request_count) OVER w
           AS stddev_request_count, min("timestamp") OVER w AS first_seen, max("timestamp") OVER w AS last_seen
    FROM metrics WINDOW w AS (PARTITION BY {zk})) a) b"""
    # A stored or streamed baseline over all rows judges them as the batch detector does.
    q["z_score_stored"] = q["stream_z_score"] = q["z_score"]
    q["stored_baseline"] = _with(_metrics_cte("metrics", C.ZSCORE_KEYS)) + f"""SELECT {zk},
  avg(request_count) AS avg_request_count, stddev_samp(request_count) AS stddev_request_count,
  min("timestamp") AS first_seen, max("timestamp") AS last_seen FROM metrics GROUP BY {zk}"""
    q["z_score_ip"] = q["z_score"].replace(f"PARTITION BY {zk}", "PARTITION BY ip_address, endpoint").replace(
        _metrics_cte("metrics", C.ZSCORE_KEYS), _metrics_cte("metrics", m))
    rk = ", ".join(C.ROLLING_KEYS)
    q["rolling_anomaly"] = _with(_metrics_cte("metrics", C.ROLLING_KEYS)) + f"""SELECT *,
  CASE WHEN rolling_std > 0 AND abs(request_count - rolling_mean) / rolling_std > {C.ROLLING_THRESHOLD}
       THEN 1 ELSE 0 END AS time_series_anomaly FROM (
  SELECT *, avg(request_count) OVER w AS rolling_mean, stddev_samp(request_count) OVER w AS rolling_std
  FROM metrics WINDOW w AS (PARTITION BY {rk} ORDER BY "timestamp", request_count, response_time
                            ROWS BETWEEN {C.ROLLING_WINDOW} PRECEDING AND CURRENT ROW)) a"""
    q["rolling_anomaly_ip"] = _with(_metrics_cte("metrics", m)) + f"""SELECT *,
  CASE WHEN rolling_std > 0 AND abs(request_count - rolling_mean) / rolling_std > {C.ROLLING_THRESHOLD}
       THEN 1 ELSE 0 END AS time_series_anomaly FROM (
  SELECT *, avg(request_count) OVER w AS rolling_mean, stddev_samp(request_count) OVER w AS rolling_std
  FROM metrics WINDOW w AS (PARTITION BY ip_address
    ORDER BY "timestamp" NULLS FIRST, endpoint NULLS FIRST, request_count NULLS FIRST, response_time NULLS FIRST
    ROWS BETWEEN {C.ROLLING_WINDOW} PRECEDING AND CURRENT ROW)) a"""
    q["outliers_zscore"] = wg + """SELECT c.*, CASE WHEN abs((response_time - s.m) / nullif(s.sd, 0)) > 3
  THEN 1 ELSE 0 END AS response_time_outlier
  FROM cleaned_geo c, (SELECT avg(response_time) AS m, stddev_samp(response_time) AS sd FROM cleaned_geo) s"""
    q["outliers_iqr"] = wg + """SELECT c.* EXCLUDE (q1t, q3t, q1s, q3s) FROM (
  SELECT c.*, s.*,
    CASE WHEN response_time < q1t - 1.5 * (q3t - q1t) OR response_time > q3t + 1.5 * (q3t - q1t)
         THEN 1 ELSE 0 END AS response_time_outlier,
    CASE WHEN response_size < q1s - 1.5 * (q3s - q1s) OR response_size > q3s + 1.5 * (q3s - q1s)
         THEN 1 ELSE 0 END AS response_size_outlier
  FROM cleaned_geo c, (SELECT quantile_disc(response_time, 0.25) AS q1t, quantile_disc(response_time, 0.75) AS q3t,
                          quantile_disc(response_size, 0.25) AS q1s, quantile_disc(response_size, 0.75) AS q3s
                   FROM cleaned_geo) s) c"""
    q["metric_outliers"] = _with(_metrics_cte("metrics", m)) + """SELECT c.*,
  CASE WHEN abs((request_count - s.m1) / nullif(s.sd1, 0)) > 3 THEN 1 ELSE 0 END AS request_count_outlier,
  CASE WHEN abs((response_time - s.m2) / nullif(s.sd2, 0)) > 3 THEN 1 ELSE 0 END AS response_time_outlier
  FROM metrics c, (SELECT avg(request_count) AS m1, stddev_samp(request_count) AS sd1,
                          avg(response_time) AS m2, stddev_samp(response_time) AS sd2 FROM metrics) s"""
    q["metric_outliers_iqr"] = _with(_metrics_cte("metrics", m)) + """SELECT c.*,
  CASE WHEN request_count < s.a - 1.5 * (s.b - s.a) OR request_count > s.b + 1.5 * (s.b - s.a)
       THEN 1 ELSE 0 END AS request_count_outlier,
  CASE WHEN response_time < s.c - 1.5 * (s.d - s.c) OR response_time > s.d + 1.5 * (s.d - s.c)
       THEN 1 ELSE 0 END AS response_time_outlier
  FROM metrics c, (SELECT quantile_disc(request_count, 0.25) AS a, quantile_disc(request_count, 0.75) AS b,
                          quantile_disc(response_time, 0.25) AS c, quantile_disc(response_time, 0.75) AS d FROM metrics) s"""
    # What holds of any right clustering and forest.
    q["kmeans_check"] = _with(_metrics_cte("metrics", m)) + """SELECT count(*) AS n_rows, count(*) AS size_sum,
  CAST(0 AS BIGINT) AS misplaced FROM metrics"""
    q["isolation_forest_check"] = _with(_metrics_cte("metrics", m)) + """SELECT count(*) AS n_rows,
  CAST(0 AS BIGINT) AS null_scores, CAST(0 AS BIGINT) AS out_of_range, true AS flagged_share_kept FROM metrics"""
    # rule detectors
    q["suspicious_methods"] = w + f"""SELECT 'Suspicious HTTP Method' AS type, ip_address, method, endpoint,
  {_iso()} AS "timestamp" FROM cleaned WHERE method IN {_METHODS}"""
    q["high_rate_ips"] = w + f"""SELECT 'High Request Rate' AS type, ip_address, count(*) AS request_count,
  {C.HIGH_RATE_LIMIT} AS max_allowed_requests FROM cleaned WHERE ip_address IS NOT NULL
  GROUP BY ip_address HAVING count(*) > {C.HIGH_RATE_LIMIT}"""
    q["slow_requests"] = w + """SELECT 'slow_requests' AS type, count(*) AS count,
  avg(response_time) AS avg_response_time, max(response_time) AS max_response_time
  FROM cleaned WHERE response_time > 5000 HAVING count(*) > 0"""
    q["suspicious_user_agents"] = w + f"""SELECT 'suspicious_user_agents' AS type, user_agent, count(*) AS count
  FROM cleaned WHERE regexp_matches(user_agent, {_AGENTS}) GROUP BY user_agent"""
    q["suspicious_status"] = w + f"""SELECT 'Suspicious Status Code' AS type, ip_address, status_code, endpoint,
  {_iso()} AS "timestamp" FROM cleaned WHERE status_code IN {_STATUSES}"""
    q["blocked_countries"] = wg + f"""SELECT 'Blocked Country' AS type, ip_address, country, endpoint,
  {_iso()} AS "timestamp" FROM cleaned_geo WHERE country IN {_BLOCKED}"""
    q["stream_roundtrip"] = wg + "SELECT * FROM cleaned_geo"
    q["table_roundtrip"] = q["stream_roundtrip"]
    q["ingest_batch"] = wg + "SELECT * FROM cleaned_geo"
    q["anomaly_report"] = wg + _report_sql()
    q["anomaly_totals"] = _with(_GEO, "report AS (" + _report_sql() + ")") + """SELECT
  count_if(category = 'ip') AS ip_anomalies, count_if(category = 'performance') AS performance_anomalies,
  least(count_if(category = 'security'), 1) AS security_anomalies,
  count_if(category = 'method') AS method_anomalies, count_if(category = 'status') AS status_anomalies,
  count_if(category = 'geo') AS geo_anomalies,
  count_if(category = 'ip') + count_if(category = 'performance') + least(count_if(category = 'security'), 1)
    AS total_anomalies
FROM report"""
    return q


ORACLE_SQL: dict[str, str] = _sql()
