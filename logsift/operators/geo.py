"""Location enrichment: the range that holds an address.

The range table is packed on the driver into sorted start and end arrays with
coded locations; its size is checked first. The arrays are broadcast once and
every batch of rows finds its ranges by a vectorised binary search, so the
fact side is neither shuffled nor compared with more than one range a row. A
table over ``max_bytes`` is merged with the distinct addresses in one order
(``asof``), and the located addresses are joined back. Only streams over such a
table are joined on buckets (a stream has no order to merge by).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsift.functions.ip import ipv4_to_long, ipv6_digits, ipv6_to_hex
from logsift.operators.asof import address_key, locate
from logsift.schemas import GEO_COLUMNS

UNKNOWN = "Unknown"
BUCKET_BITS = 16
# Leading digits of IPv4 addresses written as IPv6.
MAPPED = "00000000000000000000ffff"
MAX_BYTES = 256 << 20
# Bytes of a packed range besides its names: two bounds and a code.
_FOUR_BYTES, _SIX_BYTES = 20, 68


def complete(ranges: DataFrame) -> DataFrame:
    """``ranges`` with all its columns; ``start_v6``/``end_v6`` (32 hexadecimal
    digits) are optional."""
    for c in ("start_v6", "end_v6"):
        if c not in ranges.columns:
            ranges = ranges.withColumn(c, F.lit(None).cast("string"))
    return ranges


def packed_bytes(ranges: DataFrame) -> int:
    """Upper bound of the packed size (names counted for every range). Runs one job."""
    names = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in GEO_COLUMNS), F.lit(0))
    row = F.when(F.col("start_ip").isNotNull(), F.lit(_FOUR_BYTES)).otherwise(_SIX_BYTES) + names
    return ranges.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0).cast("long"))).first()[0]


def pack(ranges: DataFrame) -> tuple:
    """((starts, ends, codes) of IPv4, the same of IPv6, location columns)."""
    places = [F.coalesce(F.col(c), F.lit(UNKNOWN)).alias(c) for c in GEO_COLUMNS]
    table = ranges.select("start_ip", "end_ip", "start_v6", "end_v6", *places).toArrow()
    names = [table.column(c).cast(pa.string()).combine_chunks() for c in GEO_COLUMNS]
    coded = pc.binary_join_element_wise(*names, "\x1f").dictionary_encode()
    code = np.asarray(coded.indices).astype(np.int64)
    # Codes number the locations in the order of their first range.
    first = pa.array(np.unique(code, return_index=True)[1])
    parts = []
    for start, end, kind in (("start_ip", "end_ip", np.int64), ("start_v6", "end_v6", "S32")):
        here = np.flatnonzero(np.asarray(table.column(start).is_valid()))
        low = np.array(table.column(start).take(pa.array(here)).to_pylist(), dtype=kind)
        high = np.array(table.column(end).take(pa.array(here)).to_pylist(), dtype=kind)
        order = np.argsort(low, kind="stable")
        parts.append((low[order], high[order], code[here][order].astype(np.int32)))
    return parts[0], parts[1], [c.take(first) for c in names]


def _search(part: tuple, address: np.ndarray) -> np.ndarray:
    """Location code of each address, -1 if no range holds it."""
    low, high, code = part
    if not len(low):
        return np.full(len(address), -1, np.int32)
    at = np.searchsorted(low, address, "right") - 1
    inside = (at >= 0) & (address <= high[at])
    return np.where(inside, code[at], -1).astype(np.int32)


def _locator(sent):
    """An Arrow function (IPv4 value, other text) -> location of each row."""

    @F.arrow_udf("struct<" + ", ".join(f"{c}: string" for c in GEO_COLUMNS) + ">")
    def locate(four: pa.Array, text: pa.Array) -> pa.Array:
        part4, part6, places = sent.value
        code = np.full(len(four), -1, np.int32)
        at4 = np.flatnonzero(np.asarray(four.is_valid()))
        if len(at4):
            code[at4] = _search(part4, np.asarray(four.take(pa.array(at4)), dtype=np.int64))
        at6 = np.flatnonzero(np.asarray(text.is_valid()))
        if len(at6):
            coded = text.take(pa.array(at6)).dictionary_encode()
            digits = [ipv6_digits(t) for t in coded.dictionary.to_pylist()]
            found = np.full(len(digits), -1, np.int32)
            # A mapped address (::ffff:1.2.3.4) is looked up as IPv4.
            own = [k for k, d in enumerate(digits) if d is not None and not d.startswith(MAPPED)]
            mapped = [k for k, d in enumerate(digits) if d is not None and d.startswith(MAPPED)]
            found[own] = _search(part6, np.array([digits[k] for k in own], dtype="S32"))
            found[mapped] = _search(part4, np.array([int(digits[k][len(MAPPED):], 16) for k in mapped], np.int64))
            code[at6] = found[np.asarray(coded.indices)]
        take = pa.array(code, mask=code < 0)
        return pa.StructArray.from_arrays([p.take(take) for p in places], names=list(GEO_COLUMNS))

    return locate


def _other_text(ip_col: str):
    """The text where it may be an IPv6 address."""
    return F.when(F.contains(F.col(ip_col), F.lit(":")), F.col(ip_col))


def _addresses(df: DataFrame, ip_col: str) -> DataFrame:
    """``df`` with ``_four`` (IPv4 value, also of mapped addresses) and ``_six`` (IPv6 digits)."""
    step = df.withColumn("_six", ipv6_to_hex(_other_text(ip_col)))
    mapped = F.col("_six").startswith(MAPPED)
    return step.withColumn("_four", F.when(mapped, F.conv(F.substring("_six", 25, 8), 16, 10).cast("long")).otherwise(
        ipv4_to_long(ip_col))).withColumn("_six", F.when(~mapped, F.col("_six")))


def _bucket_join(df: DataFrame, ranges: DataFrame) -> DataFrame:
    """``df`` (with ``_four`` and ``_six``) and the columns of the range that holds each row's address."""
    names = [F.col(c).alias(f"_g_{c}") for c in GEO_COLUMNS]
    hexes = 4  # leading digits of an IPv6 bucket
    four = ranges.filter(F.col("start_ip").isNotNull()).select(
        F.lpad(F.hex("start_ip"), 32, "0").alias("_start"), F.lpad(F.hex("end_ip"), 32, "0").alias("_end"), *names,
        F.explode(F.sequence(F.shiftright("start_ip", BUCKET_BITS), F.shiftright("end_ip", BUCKET_BITS))).alias("_bucket"))

    def lead(c):
        return F.conv(F.substring(c, 1, hexes), 16, 10).cast("long")

    # Buckets of IPv6 are numbered behind those of IPv4.
    behind = F.lit(1 << 32 - BUCKET_BITS).cast("long")
    six = ranges.filter(F.col("start_v6").isNotNull()).select(
        F.upper("start_v6").alias("_start"), F.upper("end_v6").alias("_end"), *names,
        F.explode(F.sequence(lead("start_v6") + behind, lead("end_v6") + behind)).alias("_bucket"))
    right = four.unionByName(six)
    left = df.withColumn("_key", F.when(F.col("_four").isNotNull(), F.lpad(F.hex("_four"), 32, "0")).otherwise(F.upper("_six")))
    left = left.withColumn("_own", F.coalesce(F.shiftright("_four", BUCKET_BITS), lead("_six") + behind, F.lit(-1).cast("long")))
    cond = (left["_own"] == right["_bucket"]) & left["_key"].between(right["_start"], right["_end"])
    return left.join(right, cond, "left").drop("_key", "_own", "_start", "_end", "_bucket")


def geo_enrich(df: DataFrame, ranges: DataFrame, ip_col: str = "ip_address", max_bytes: int = MAX_BYTES) -> DataFrame:
    """Add country, city, region to every row (``Unknown`` when no range holds the address).

    ``ranges``: start_ip, end_ip (inclusive, BIGINT) of IPv4 ranges, or start_v6,
    end_v6 (32 lower-case hexadecimal digits) of IPv6 ranges, and country, city,
    region. Of ranges that overlap the one with the last start counts, so nested
    networks have to go through ``asof.innermost`` first. Rows are never dropped or duplicated.
    Reads ``ranges`` at once (one job for its size, one to pack it).
    """
    base = [c for c in df.columns if c not in GEO_COLUMNS]
    ranges = complete(ranges)
    rows = df.select(*base)
    if packed_bytes(ranges) <= max_bytes:
        sent = df.sparkSession.sparkContext.broadcast(pack(ranges))
        found = rows.withColumn("_place", _locator(sent)(ipv4_to_long(ip_col), _other_text(ip_col)))
        place = {c: F.col(f"_place.{c}") for c in GEO_COLUMNS}
    elif df.isStreaming:
        found = _bucket_join(_addresses(rows, ip_col), ranges)
        place = {c: F.col(f"_g_{c}") for c in GEO_COLUMNS}
    else:
        # Only the distinct addresses meet the ranges; adaptive execution splits a hot address on the way back.
        distinct = _addresses(rows.select(F.col(ip_col).alias("_ip")).distinct(), "_ip")
        located = locate(distinct.select(F.col("_ip").alias("ip"), address_key(F.col("_four"), F.col("_six")).alias("key")), ranges.select(
            address_key(F.col("start_ip"), F.col("start_v6")).alias("start"), address_key(F.col("end_ip"), F.col("end_v6")).alias("end"), *GEO_COLUMNS))
        located = located.select(F.col("ip").alias("_ip"), *[F.col(c).alias(f"_g_{c}") for c in GEO_COLUMNS])
        found = rows.join(located, rows[ip_col] == located["_ip"], "left")
        place = {c: F.col(f"_g_{c}") for c in GEO_COLUMNS}
    return found.select(*base, *[F.coalesce(place[c], F.lit(UNKNOWN)).alias(c) for c in GEO_COLUMNS])
