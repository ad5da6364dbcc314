"""Locations from a range table of any size, by a distributed as-of merge.

Range starts and distinct addresses are put in one order: range-partitioned by
key and sorted inside each partition. Going through a partition, the last start
is carried forward to the addresses behind it; a range holds the address if it
does not end before it. What a partition's first addresses need from the
partitions before is one row for each partition. No side is broadcast and no
address meets more than one range, however the ranges are spread.

Keys are texts: a family digit and 32 hexadecimal digits. Ranges must not
overlap; ``innermost`` makes nested networks ready for the search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsift.schemas import GEO_COLUMNS
from logsift.session import persist


def address_key(four: Column, six: Column) -> Column:
    """The key of an IPv4 value, else of 32 IPv6 digits; NULL without either."""
    return F.when(four.isNotNull(), F.concat(F.lit("4"), F.lpad(F.hex(four), 32, "0"))).when(
        six.isNotNull(), F.concat(F.lit("6"), F.upper(six)))


def _carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sorted partition: addresses with the last start before them ('met'),
    addresses before any start ('open'), and the partition's last start ('last')."""
    part = TaskContext.get().partitionId()
    last: pa.Table | None = None
    names = ["ip", "key", "end", *GEO_COLUMNS]
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([last, table]) if last is not None else table
        table = table.combine_chunks()
        start = np.asarray(table.column("is_start"))
        before = np.maximum.accumulate(np.where(start, np.arange(len(start)), -1))
        rows = np.flatnonzero(~start)
        at = pa.array(before[rows], mask=before[rows] < 0)
        met = table.select(["end", *GEO_COLUMNS]).take(at)
        own = table.select(["ip", "key"]).take(pa.array(rows))
        inside = np.asarray(pc.fill_null(pc.less_equal(own.column("key"), met.column("end")), False))
        role = np.where(before[rows] < 0, "open", np.where(inside, "met", ""))
        out = pa.table([*own.columns, *met.columns, pa.array(role), pa.array(np.full(len(rows), part, np.int32))],
                       names=[*names, "role", "part"]).filter(pa.array(role != ""))
        yield from out.to_batches()
        if before[-1] >= 0:
            last = table.slice(int(before[-1]), 1)
    if last is not None:
        row = last.select(names).append_column("role", pa.array(["last"])).append_column("part", pa.array([part], pa.int32()))
        yield from row.to_batches()


def locate(addresses: DataFrame, ranges: DataFrame) -> DataFrame:
    """(ip, country, city, region) of the addresses that a range holds.
    ``addresses``: ip (distinct texts) and key; ``ranges``: start, end (keys) and the location."""
    places = [F.coalesce(F.col(c), F.lit("Unknown")).alias(c) for c in GEO_COLUMNS]
    nothing = [F.lit(None).cast("string").alias(c) for c in ("end", *GEO_COLUMNS)]
    starts = ranges.select(F.lit(None).cast("string").alias("ip"), F.col("start").alias("key"), F.lit(True).alias("is_start"), "end", *places)
    both = addresses.filter("key IS NOT NULL").select("ip", "key", F.lit(False).alias("is_start"), *nothing).unionByName(starts)
    ordered = both.repartitionByRange(F.col("key")).sortWithinPartitions("key", F.desc("is_start"))
    text = ", ".join(f"{c} string" for c in ("ip", "key", "end", *GEO_COLUMNS, "role"))
    merged = persist(ordered.mapInArrow(_carried, text + ", part int"), "asof")
    # The last start of each partition (one row each) goes to the partitions behind it.
    lasts = {r["part"]: r for r in merged.filter("role = 'last'").collect()}
    parts = sorted({r["part"] for r in merged.filter("role = 'open'").select("part").distinct().collect()})
    carry = []
    for part in parts:
        before = [p for p in lasts if p < part]
        if before:
            found = lasts[max(before)]
            carry.append((part, found["end"], *[found[c] for c in GEO_COLUMNS]))
    met = merged.filter("role = 'met'").select("ip", *GEO_COLUMNS)
    if not carry:
        return met
    kind = "part int, end string, " + ", ".join(f"{c} string" for c in GEO_COLUMNS)
    carried = F.broadcast(addresses.sparkSession.createDataFrame(carry, kind))
    late = merged.filter("role = 'open'").select("ip", "key", "part").join(carried, "part").filter("key <= end")
    return met.unionByName(late.select("ip", *GEO_COLUMNS))


def _bits(hexes: Column, digits: int) -> Column:
    """Hexadecimal digits (a multiple of eight) as a text of bits."""
    parts = [F.lpad(F.bin(F.conv(F.substring(hexes, k + 1, 8), 16, 10).cast("long")), 32, "0") for k in range(0, digits, 8)]
    return F.concat(*parts)


def _hexes(bits: Column) -> Column:
    return F.lower(F.concat(*[F.lpad(F.conv(F.substring(bits, k + 1, 32), 2, 16), 8, "0") for k in range(0, 128, 32)]))


def innermost(ranges: DataFrame) -> DataFrame:
    """Nested networks as ranges in which the last start wins, which is how addresses
    are looked up: a row for every place where the innermost network changes.

    Places are the networks' first addresses and those behind their last ones. The
    innermost network that holds a place has the longest prefix of its bits, found
    by joining the place's prefixes of all lengths that occur; a row ends where its
    network ends. Ranges that are no network (an aligned power of two) are an error.
    Of equal networks with different locations the first by name is taken.
    """
    names = [F.coalesce(F.col(c), F.lit("Unknown")).alias(c) for c in GEO_COLUMNS]
    four = F.col("start_ip").isNotNull()
    low = F.when(four, F.concat(F.lit("4"), _bits(F.lpad(F.hex("start_ip"), 8, "0"), 8))).otherwise(F.concat(F.lit("6"), _bits(F.col("start_v6"), 32)))
    high = F.when(four, F.concat(F.lit("4"), _bits(F.lpad(F.hex("end_ip"), 8, "0"), 8))).otherwise(F.concat(F.lit("6"), _bits(F.col("end_v6"), 32)))
    bounds = ranges.filter("start_ip IS NOT NULL OR start_v6 IS NOT NULL").select(low.alias("low"), high.alias("high"), *names)
    # The prefix: what is left when the zeros of the first address and the ones of the last are cut off alike.
    free = F.least(F.length("low") - F.length(F.rtrim("low", F.lit("0"))), F.length("high") - F.length(F.rtrim("high", F.lit("1"))))
    nets = bounds.withColumn("length", F.length("low") - free)
    whole = F.substring("low", F.lit(1), F.col("length")) == F.substring("high", F.lit(1), F.col("length"))
    prefix = F.when(whole, F.substring("low", F.lit(1), F.col("length"))).otherwise(F.raise_error(F.lit("a range is not a network")))
    nets = persist(nets.withColumn("prefix", prefix).groupBy("prefix", "length").agg(
        F.first("low").alias("low"), F.first("high").alias("high"), F.min(F.struct(*GEO_COLUMNS)).alias("place")), "networks")
    # Behind a network: its prefix plus one, if there is any address left.
    bits = F.length("low")
    cut = F.rtrim("prefix", F.lit("1"))
    behind = F.when(F.length(cut) > 1, F.rpad(F.concat(F.substring(cut, F.lit(1), F.length(cut) - 1), F.lit("1")), bits, "0"))
    places = nets.select(F.explode(F.array("low", behind)).alias("at")).filter("at IS NOT NULL").distinct()
    lengths = sorted(r[0] for r in nets.select("length").distinct().collect())  # 162 at most
    keyed = places.select("at", F.explode(F.array(*[F.lit(k) for k in lengths]) if lengths else F.array().cast("array<int>")).alias("length"))
    keyed = keyed.filter(F.col("length") <= F.length("at")).withColumn("prefix", F.substring("at", F.lit(1), F.col("length")))
    found = keyed.join(nets, ["prefix", "length"]).groupBy("at").agg(F.max_by(F.struct("high", "place"), "length").alias("net"))
    is4, at, end = F.col("at").startswith("4"), F.substring("at", 2, 128), F.substring(F.col("net.high"), 2, 128)
    return found.select(
        F.when(is4, F.conv(at, 2, 10).cast("long")).alias("start_ip"), F.when(is4, F.conv(end, 2, 10).cast("long")).alias("end_ip"),
        F.when(~is4, _hexes(at)).alias("start_v6"), F.when(~is4, _hexes(end)).alias("end_v6"),
        *[F.col(f"net.place.{c}").alias(c) for c in GEO_COLUMNS])
