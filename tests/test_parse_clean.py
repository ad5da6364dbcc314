import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import line, lines_df
from logsift.functions.clean import clean_logs
from logsift.functions.parse import parse_lenient, parse_strict
from logsift.functions.timecols import utc_wallclock


def cleaned_rows(spark, items):
    df = clean_logs(lines_df(spark, items), keep=("id",))
    out = df.withColumn("ts_utc", utc_wallclock("timestamp")).orderBy("id").collect()
    return {r["id"]: r for r in out}


def test_sample_line_parses(spark):
    r = cleaned_rows(spark, [line()])[0]
    assert r.ip_address == "1.2.3.4"
    assert r.ts_utc == dt.datetime(2037, 12, 27, 12, 0, 0)
    assert (r.status_code, r.response_size, r.response_time) == (200, 4900, 120)
    assert (r.method, r.endpoint, r.protocol) == ("GET", "/usr/admin", "HTTP/1.0")
    assert (r.year, r.month) == (2037, 12)
    assert r.is_valid_timestamp and r.is_valid_status


def test_garbage_line_is_flagged_not_dropped(spark):
    r = cleaned_rows(spark, ["garbage"])[0]
    assert r.ip_address == "" and r.referrer == "" and r.user_agent == ""
    assert r.timestamp is None and r.status_code is None
    assert r.response_size == 0 and r.response_time == 0
    assert r.method is None and r.endpoint is None and r.protocol is None
    assert r.year is None and r.month is None
    assert r.is_valid_timestamp is False and r.is_valid_status is False


def test_bad_time_empty_request_dash_sizes(spark):
    r = cleaned_rows(spark, ['9.9.9.9 - - [bad] "" 200 - "-" "UA" -'])[0]
    assert r.timestamp is None and r.status_code == 200
    assert r.response_size == 0 and r.response_time == 0
    assert r.method is None and r.endpoint is None and r.protocol is None


def test_one_token_request_and_int_overflow(spark):
    rows = cleaned_rows(spark, [line(request="GET"), line(size="99999999999")])
    assert (rows[0].method, rows[0].endpoint, rows[0].protocol) == ("GET", "", "GET")
    assert rows[1].response_size is None


def test_lenient_vs_strict_grammar(spark):
    items = [
        line(agent='U"A'),  # 0: quote inside a quoted field
        line(ident="- bob"),  # 1: named user
        "prefix " + line(ip="5.6.7.8"),  # 2: text before the IP
        line(size="-"),  # 3: dash size
        line(),  # 4: plain
    ]
    df = lines_df(spark, items)
    lenient = {r.id: r for r in parse_lenient(df, keep=("id",)).collect()}
    strict = {r.id: r for r in parse_strict(df, keep=("id",)).collect()}
    assert lenient[0].user_agent == 'U"A'
    assert lenient[1].ip_address == ""
    assert lenient[2].ip_address == "5.6.7.8"
    assert sorted(strict) == [1, 4]
    assert strict[1].ip_address == "1.2.3.4"
    assert (strict[4].method, strict[4].endpoint, strict[4].protocol) == ("GET", "/usr/admin", "HTTP/1.0")
    assert strict[4].status_code == 200 and strict[4].response_time == 120


def test_strict_drops_requests_without_three_tokens(spark):
    df = lines_df(spark, [line(request="GET /a"), line(request=""), line(request="GET /a HTTP/1.1")])
    out = {r.id: r for r in parse_strict(df, keep=("id",)).collect()}
    assert sorted(out) == [1, 2]
    assert out[1].method is None and out[1].endpoint is None and out[1].protocol is None


TIME_CASES = [
    ("27/Dec/2037:12:00:00 +0200", dt.datetime(2037, 12, 27, 10, 0, 0)),
    ("7/Dec/2037:12:00:00 +0000", dt.datetime(2037, 12, 7, 12, 0, 0)),
    ("27/Dec/2037:12:00:00 +0000 tail", dt.datetime(2037, 12, 27, 12, 0, 0)),
    ("7/Dec/2037:12:00:00 +0000x", dt.datetime(2037, 12, 7, 12, 0, 0)),  # 26 chars, not canonical
    ("27/Dec/12345:12:00:00 +000", None),
    ("31/Feb/2037:12:00:00 +0000", None),
    ("27/Dec/2037:25:00:00 +0000", None),
    ("27/Dec/2037:12:00:00", None),
    ("10/Mar/2024:02:30:00 +0000", dt.datetime(2024, 3, 10, 2, 30, 0)),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("policy", ["CORRECTED", "LEGACY", "EXCEPTION"])
def test_timestamps_independent_of_session(spark, conf, zone, policy):
    conf("spark.sql.session.timeZone", zone)
    conf("spark.sql.legacy.timeParserPolicy", policy)
    rows = cleaned_rows(spark, [line(ts=t) for t, _ in TIME_CASES])
    for i, (_, want) in enumerate(TIME_CASES):
        assert rows[i].ts_utc == want, (zone, policy, TIME_CASES[i])
    dst = rows[len(TIME_CASES) - 1]
    assert (dst.year, dst.month) == (2024, 3)
    hours = clean_logs(lines_df(spark, [line(ts="10/Mar/2024:02:30:00 +0000")])).select(
        F.hour(utc_wallclock("timestamp"))).collect()
    assert hours[0][0] == 2


TRICKY = [
    line(agent="A\u0001B"),  # separator inside a field -> per-field fallback
    line(agent="x\ny"),  # line terminator inside a quoted field: no match across it
    line() + "\r\n",
    line(ip="1.1.1.1") + " " + line(ip="2.2.2.2"),  # two candidate matches: the leftmost wins
    'a - - [x] "" 123 - "" "" - tail',
    "",
    None,
    line(request='GET /"quoted" HTTP/1.0'),
    line(status="2000"),
]


def test_single_pass_equals_per_field_search(spark):
    from logsift.functions.parse import lenient_fields_by_search

    df = spark.createDataFrame([(i, s) for i, s in enumerate(TRICKY)], "id int, log_line string")
    one = sorted(parse_lenient(df, keep=("id",)).collect())
    each = sorted(df.select("id", *lenient_fields_by_search("log_line")).collect())
    assert one == each
    assert one[3].ip_address == "1.1.1.1"


def test_single_pass_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from logsift.functions.parse import lenient_fields_by_search

    alphabet = st.sampled_from(list(' -[]"/:0123456789abcGET\t\u0001\n') + ["HTTP/1.0", "- - ["])
    texts = st.lists(alphabet, max_size=40).map("".join)
    parts = st.lists(st.one_of(texts, st.sampled_from([line(), line(size="-"), "] \"", '" 200 ', '" "'])),
                     min_size=1, max_size=6).map("".join)
    seen = []

    @settings(max_examples=200, deadline=None)
    @given(parts)
    def collect(s):
        seen.append(s)

    collect()
    df = spark.createDataFrame(list(enumerate(seen)), "id int, log_line string")
    one = sorted(parse_lenient(df, keep=("id",)).collect())
    each = sorted(df.select("id", *lenient_fields_by_search("log_line")).collect())
    assert one == each


def test_strict_single_pass_equals_anchored_search(spark):
    from logsift.functions.parse import STRICT_PATTERN

    items = TRICKY + [line(), line(ident="a b"), "x" + line(), line(agent="A\u0001B", ident="u v")]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(items)], "id int, log_line string")
    got = sorted(r.id for r in parse_strict(df, keep=("id",)).collect())
    pat = "^" + STRICT_PATTERN
    want = sorted(r.id for r in df.filter(F.col("log_line").rlike(pat)).select(
        "id", F.regexp_extract("log_line", pat, 3).alias("req")).collect()
        if r.req == "" or len(r.req.split()) == 3)
    assert got == want
    u = [r for r in parse_strict(df, keep=("id",)).collect() if r.id == len(items) - 1][0]
    assert u.user_agent == "A\u0001B"


@pytest.mark.parametrize("policy", ["CORRECTED", "LEGACY", "EXCEPTION"])
def test_clf_timestamp_on_raw_text(spark, conf, policy):
    from logsift.functions.clean import clf_timestamp

    conf("spark.sql.legacy.timeParserPolicy", policy)
    texts = ["27/Dec/2037:12:00:00 +0000\n", "27/Dec/2037:12:00:00 +0000", "7/Dec/2037:12:00:00 +0000x", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, raw string")
    got = [r[0] for r in df.orderBy("id").select(utc_wallclock(clf_timestamp("raw"))).collect()]
    assert got == [dt.datetime(2037, 12, 27, 12), dt.datetime(2037, 12, 27, 12), dt.datetime(2037, 12, 7, 12),
                   None, None]


@pytest.mark.parametrize("policy", ["CORRECTED", "LEGACY", "EXCEPTION"])
def test_strict_timestamps(spark, conf, policy):
    from logsift.functions.parse import strict_timestamp

    conf("spark.sql.legacy.timeParserPolicy", policy)
    texts = ["27/Dec/2037:12:00:00 +0200", "27/dec/2037:12:00:00 +0000", "7/Dec/2037:1:2:3 +00:00",
             "27/Dec/2037:12:00:00 Z", "31/Feb/2037:12:00:00 +0000", "27/Dec/2037:12:00:00 +0000 x", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, raw string")
    got = [r[0] for r in df.orderBy("id").select(utc_wallclock(strict_timestamp("raw"))).collect()]
    assert got == [dt.datetime(2037, 12, 27, 10), dt.datetime(2037, 12, 27, 12), dt.datetime(2037, 12, 7, 1, 2, 3),
                   dt.datetime(2037, 12, 27, 12), None, None, None, None]
