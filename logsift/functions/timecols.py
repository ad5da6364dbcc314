"""Time helpers that do not depend on the session time zone.

Instants are stored as TIMESTAMP (an absolute point in time). Calendar fields
and truncations are taken from the UTC wall clock, held as TIMESTAMP_NTZ, so a
query gives the same answer in every session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


UNITS = ("minute", "hour", "day", "month")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_wallclock(ts) -> Column:
    """TIMESTAMP instant -> TIMESTAMP_NTZ of its UTC wall clock."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(ts)), _epoch_ntz())


def utc_instant(ntz) -> Column:
    """TIMESTAMP_NTZ read as UTC wall clock -> TIMESTAMP instant (epoch arithmetic, no zone)."""
    n = _col(ntz)
    whole = F.unix_date(F.to_date(n)).cast("long") * 86400 + F.hour(n) * 3600 + F.minute(n) * 60
    micros = whole * 1_000_000 + (F.date_part(F.lit("SECOND"), n) * 1_000_000).cast("long")
    return F.timestamp_micros(micros)


def trunc_utc(ts, unit: str) -> Column:
    """Truncate an instant to minute/hour/day/month of its UTC wall clock (NTZ)."""
    if unit not in UNITS:
        raise ValueError(f"Invalid interval: choose one of {', '.join(UNITS)}")
    u = utc_wallclock(ts)
    day = F.to_date(u).cast("timestamp_ntz")
    if unit == "day":
        return day
    if unit == "hour":
        return F.timestamp_add("HOUR", F.hour(u), day)
    if unit == "minute":
        return F.timestamp_add("MINUTE", F.hour(u) * 60 + F.minute(u), day)
    return F.make_date(F.year(u), F.month(u), F.lit(1)).cast("timestamp_ntz")


_STEP_MICROS = {"minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def bucket_start(ts, unit: str) -> Column:
    """Start instant (TIMESTAMP) of the UTC calendar bucket holding ``ts``.

    Fixed-width units are exact integer arithmetic on epoch microseconds;
    months go through the UTC calendar date. No session zone is involved.
    """
    if unit not in UNITS:
        raise ValueError(f"Invalid interval: choose one of {', '.join(UNITS)}")
    if unit in _STEP_MICROS:
        us = F.unix_micros(_col(ts))
        return F.timestamp_micros(us - F.pmod(us, F.lit(_STEP_MICROS[unit])))
    u = utc_wallclock(ts)
    first = F.make_date(F.year(u), F.month(u), F.lit(1))
    return F.timestamp_seconds(F.unix_date(first).cast("long") * 86400)


def iso_utc(ts) -> Column:
    """ISO-8601 text of an instant in UTC with a ``+00:00`` offset.

    Built from the UTC calendar fields: formatting goes through no session
    zone, so wall-clock times that a zone skips (DST gaps) stay intact.
    """
    u = utc_wallclock(ts)
    return F.format_string("%04d-%02d-%02dT%02d:%02d:%02d+00:00", F.year(u), F.month(u), F.dayofmonth(u),
                           F.hour(u), F.minute(u), F.second(u))
