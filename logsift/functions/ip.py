"""Address texts <-> numbers."""

from __future__ import annotations

import ipaddress

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(0|[1-9][0-9]{0,2})"
_IPV4 = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ipv4_to_long(ip) -> Column:
    """Dotted IPv4 text -> its 32-bit value as BIGINT; NULL for anything else
    (empty, IPv6, octets above 255 or with leading zeros)."""
    ip = _col(ip)
    parts = F.split(ip, r"\.", -1)
    octets = [parts.getItem(i).try_cast("long") for i in range(4)]
    in_range = octets[0] <= 255
    for o in octets[1:]:
        in_range = in_range & (o <= 255)
    value = octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]
    return F.when(ip.rlike(_IPV4) & in_range, value)


def long_to_ipv4(value) -> Column:
    v = _col(value)
    return F.concat_ws(
        ".",
        F.shiftright(v, 24).cast("string"),
        F.pmod(F.shiftright(v, 16), F.lit(256)).cast("string"),
        F.pmod(F.shiftright(v, 8), F.lit(256)).cast("string"),
        F.pmod(v, F.lit(256)).cast("string"),
    )


def ipv6_digits(text: str | None) -> str | None:
    """IPv6 text -> its 32 hexadecimal digits (whose order is the addresses'); None
    for anything else. A dotted IPv4 tail is accepted, a zone is not."""
    try:
        return None if text is None or "%" in text else ipaddress.IPv6Address(text).packed.hex()
    except ValueError:
        return None


def ipv6_to_hex(ip) -> Column:
    """``ipv6_digits`` of a column, in Arrow batches, once for each distinct text of a batch."""

    @F.arrow_udf("string")
    def digits(texts: pa.Array) -> pa.Array:
        coded = texts.dictionary_encode()
        known = pa.array([ipv6_digits(t) for t in coded.dictionary.to_pylist()], pa.string())
        return known.take(coded.indices)

    return digits(_col(ip))
