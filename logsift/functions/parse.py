"""Parse combined-format access-log lines into text columns.

Two grammars are supported:

* lenient (``parse_lenient``): unanchored search, ident/user must be ``- -``,
  ``-`` allowed for sizes, lazy quoted fields. Lines that do not match keep
  every field as ``''`` (never dropped).
* strict (``parse_strict``): anchored at line start, any ident/user, digits
  only for sizes, no quote inside quoted fields. Lines that do not match are
  dropped; so are lines whose non-empty request does not split into exactly
  three tokens (the per-line original raised on those).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsift.schemas import PARSED_FIELDS

# The two line grammars (8 groups: ip, timestamp, request,
# status, size, referrer, user agent, response time).
LENIENT_PATTERN = r'(\S+) - - \[(.*?)\] "(.*?)" (\d{3}) (\d+|-) "(.*?)" "(.*?)" (\d+|-)'
STRICT_PATTERN = r'(\S+) \S+ \S+ \[([^\]]+)\] "([^"]*)" (\d+) (\d+) "([^"]*)" "([^"]*)" (\d+)'


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# One pass over the line: the first branch finds the leftmost match of the
# grammar (the lazy prefix visits start positions in the same order as a
# regex search, and the tail always matches, so the groups equal a search's);
# the second branch matches every other line with empty groups, which is
# what a failed search yields. The eight groups come out joined by a
# separator and are split apart.
_SEP = "\u0001"
_ONE_PASS = "^(?:(?s:.*?)" + LENIENT_PATTERN + "(?s:.*)|(?s:.*))$"
_ONE_PASS_GROUPS = _SEP.join(f"${i}" for i in range(1, 9))


def parse_lenient(df: DataFrame, line_col: str = "log_line", keep: tuple[str, ...] = ()) -> DataFrame:
    """Lines -> eight text columns (ip_address ... response_time); keeps ``keep`` columns.

    The line is matched once (about 3x cheaper than one search per field);
    the group array is its own projection so it is computed once per row.
    A line that itself contains the separator character falls back to one
    regex search per field, so the result is exact for every input.
    """
    line = F.col(line_col)
    step = df.select(
        *[F.col(k) for k in keep],
        line.alias("_line"),
        F.split(F.regexp_replace(line, _ONE_PASS, _ONE_PASS_GROUPS), _SEP, -1).alias("_groups"),
    )
    clean_split = F.instr(F.col("_line"), _SEP) == 0
    return step.select(
        *[F.col(k) for k in keep],
        *[
            F.when(clean_split, F.col("_groups").getItem(i))
            .otherwise(F.regexp_extract(F.col("_line"), LENIENT_PATTERN, i + 1))
            .alias(name)
            for i, name in enumerate(PARSED_FIELDS)
        ],
    )


def lenient_fields_by_search(line) -> list[Column]:
    """The eight parsed columns as independent expressions (one search each)."""
    line = _col(line)
    return [F.regexp_extract(line, LENIENT_PATTERN, i + 1).alias(name) for i, name in enumerate(PARSED_FIELDS)]


# Strict timestamps accept what '%d/%b/%Y:%H:%M:%S %z' accepts in the per-line
# original: one- or two-digit day and time fields, any-case month names and
# offsets written +HHMM, +HH:MM or Z.
_STRICT_TS = r"^(\d{1,2})/([A-Za-z]{3})/(\d{4}):(\d{1,2}):(\d{1,2}):(\d{1,2})\s+(Z|[+-]\d{2}:?\d{2})$"


def strict_timestamp(raw) -> Column:
    raw = _col(raw)
    ok = raw.rlike(_STRICT_TS)

    def g(i):
        return F.regexp_extract(raw, _STRICT_TS, i)

    offset = F.when(g(7) == "Z", F.lit("+0000")).otherwise(F.regexp_replace(g(7), ":", ""))
    text = F.concat_ws(
        "",
        F.lpad(g(1), 2, "0"),
        F.lit("/"),
        F.initcap(F.lower(g(2))),
        F.lit("/"),
        g(3),
        F.lit(":"),
        F.lpad(g(4), 2, "0"),
        F.lit(":"),
        F.lpad(g(5), 2, "0"),
        F.lit(":"),
        F.lpad(g(6), 2, "0"),
        F.lit(" "),
        offset,
    )
    fmt = F.lit("dd/MMM/yyyy:HH:mm:ss Z")
    # Canonical texts need no rewriting (the parser ignores the month's case).
    canonical = raw.rlike(r"^\d{2}/[A-Za-z]{3}/\d{4}:\d{2}:\d{2}:\d{2} [+-]\d{4}\z")
    return (F.when(canonical, F.try_to_timestamp(raw, fmt))
            .when(ok, F.try_to_timestamp(text, fmt)).cast("timestamp"))


# Strict grammar in one pass, anchored at the line start. A failed match
# takes the second branch and yields empty groups; a successful one always
# has a non-empty first group (the address), which tells the two apart.
_STRICT_ONE_PASS = "^(?:" + STRICT_PATTERN + "(?s:.*)|(?s:.*))$"


def parse_strict(df: DataFrame, line_col: str = "log_line", keep: tuple[str, ...] = ()) -> DataFrame:
    """Strict grammar, typed record per matching line; other lines are dropped.

    Output: ip_address, timestamp, method, endpoint, protocol, status_code,
    response_size, referrer, user_agent, response_time (+ ``keep``).

    Lines are kept or dropped by expanding a zero- or one-element array (a
    flat-map) rather than by a filter: a filter on parsed fields would be
    pushed below the parsing projection and re-run the parse inside it.
    """
    line = F.col(line_col)
    anchored = "^" + STRICT_PATTERN
    step = df.select(
        *[F.col(k) for k in keep],
        line.alias("_line"),
        F.split(F.regexp_replace(line, _STRICT_ONE_PASS, _ONE_PASS_GROUPS), _SEP, -1).alias("_groups"),
    )
    clean_split = F.instr(F.col("_line"), _SEP) == 0
    matched = F.when(clean_split, F.length(F.col("_groups").getItem(0)) > 0).otherwise(
        F.col("_line").rlike(anchored))
    g = [
        F.when(clean_split, F.col("_groups").getItem(i)).otherwise(F.regexp_extract(F.col("_line"), anchored, i + 1))
        .alias(name)
        for i, name in enumerate(PARSED_FIELDS)
    ]
    step = step.select(*[F.col(k) for k in keep], matched.alias("_matched"), *g)
    tokens = F.split(F.trim(F.col("request")), r"\s+", -1)
    has_request = F.length("request") > 0
    record = F.struct(
        F.col("ip_address"),
        strict_timestamp("timestamp_raw").alias("timestamp"),
        F.when(has_request, tokens.getItem(0)).alias("method"),
        F.when(has_request, tokens.getItem(1)).alias("endpoint"),
        F.when(has_request, tokens.getItem(2)).alias("protocol"),
        F.col("status_code").try_cast("int").alias("status_code"),
        F.col("response_size").try_cast("int").alias("response_size"),
        F.col("referrer"),
        F.col("user_agent"),
        F.col("response_time").try_cast("int").alias("response_time"),
    )
    kept = F.col("_matched") & (~has_request | (F.size(tokens) == 3))
    return step.select(*[F.col(k) for k in keep], F.inline(F.when(kept, F.array(record))))
