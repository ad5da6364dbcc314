"""Typed cleaning of parsed access-log columns.

Bad values are flagged, never dropped: timestamp and status become NULL,
sizes become 0, and the ``is_valid_*`` flags record what happened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsift.functions.parse import parse_lenient
from logsift.functions.timecols import utc_wallclock

# Fixed value: the timestamp layout of the combined log format.
CLF_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"

# The layouts that the cleaning accepts.
# The leading day/time/offset of a raw timestamp; trailing text is ignored
# and one-digit days are padded, as the lenient legacy parser did.
_CLF_HEAD = r"^(\d{1,2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2} [+-]\d{4})"
_CLF_CANONICAL = r"^\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2} [+-]\d{4}\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clf_timestamp(raw) -> Column:
    """Raw ``dd/MMM/yyyy:HH:mm:ss Z`` text -> TIMESTAMP, NULL when invalid.

    Independent of the session's parser policy and time zone.
    """
    raw = _col(raw)
    fmt = F.lit(CLF_TIME_FORMAT)
    head = F.regexp_extract(raw, _CLF_HEAD, 1)
    padded = F.when(head.rlike(r"^\d/"), F.concat(F.lit("0"), head)).otherwise(head)
    normalised = F.when(F.length(head) > 0, F.try_to_timestamp(padded, fmt))
    # Fast path: a text already in canonical form is handed to the parser as
    # is (the normalisation would not change it), skipping the extraction.
    return (F.when(raw.rlike(_CLF_CANONICAL), F.try_to_timestamp(raw, fmt))
            .otherwise(normalised).cast("timestamp"))


def status_code(raw) -> Column:
    raw = _col(raw)
    return F.when(raw.rlike(r"^\d{3}$"), raw.try_cast("int"))


def count_or_zero(raw) -> Column:
    """Digits -> int (NULL on int overflow); ``-``, empty or other text -> 0."""
    raw = _col(raw)
    return F.when(raw.rlike(r"^\d+$"), raw.try_cast("int")).otherwise(F.lit(0))


def request_parts(request) -> tuple[Column, Column, Column]:
    """method, endpoint, protocol (what follows the last space) of a request text; NULL when the request is empty."""
    request = _col(request)
    present = F.length(request) > 0
    return (
        F.when(present, F.regexp_extract(request, r"^(\S+)", 1)),
        F.when(present, F.regexp_extract(request, r"^\S+\s(\S+)", 1)),
        F.when(present, F.element_at(F.split(request, r"\s", -1), -1)),
    )


def typed_columns(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parsed text columns -> typed cleaned columns (without location)."""
    ts = clf_timestamp("timestamp_raw")
    method, endpoint, protocol = request_parts("request")
    step = parsed.select(
        *[F.col(k) for k in keep],
        F.col("ip_address"),
        ts.alias("timestamp"),
        status_code("status_code").alias("status_code"),
        count_or_zero("response_size").alias("response_size"),
        F.col("referrer"),
        F.col("user_agent"),
        count_or_zero("response_time").alias("response_time"),
        method.alias("method"),
        endpoint.alias("endpoint"),
        protocol.alias("protocol"),
    )
    utc = utc_wallclock("timestamp")
    return step.select(
        "*",
        F.year(utc).alias("year"),
        F.month(utc).alias("month"),
        F.col("timestamp").isNotNull().alias("is_valid_timestamp"),
        F.col("status_code").isNotNull().alias("is_valid_status"),
    )


def clean_logs(lines: DataFrame, ranges: DataFrame | None = None, line_col: str = "log_line",
               keep: tuple[str, ...] = (), **geo_options) -> DataFrame:
    """Raw lines -> the cleaned fact table.

    With ``ranges`` (a range table, see ``geo_enrich``) the location columns
    country/city/region are added; without it they are left out. Lazy, but
    ``geo_enrich`` reads the range table at once.
    """
    parsed = parse_lenient(lines, line_col, keep=keep)
    typed = typed_columns(parsed, keep=keep)
    if ranges is None:
        return typed
    from logsift.operators.geo import geo_enrich

    return geo_enrich(typed, ranges, **geo_options)
