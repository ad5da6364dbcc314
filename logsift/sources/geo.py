"""Address range tables for location lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsift.functions.ip import ipv4_to_long, ipv6_to_hex


def ranges_from_cidr(df: DataFrame, network_col: str = "network") -> DataFrame:
    """Rows of ``a.b.c.d/len`` or ``x:y::/len`` plus country/city/region -> start_ip,
    end_ip (IPv4) or start_v6, end_v6 (IPv6), and the names.

    Missing names become 'Unknown'. Rows with an invalid network are dropped.
    """
    net = F.col(network_col)
    address = F.get(F.split(net, "/"), F.lit(0))
    length = F.get(F.split(net, "/"), F.lit(1)).try_cast("int")
    four = F.when(length.between(0, 32), ipv4_to_long(address))
    size = F.pow(F.lit(2.0), F.lit(32) - length).cast("long")
    start = four - F.pmod(four, size)
    six = F.col("_six")
    # Whole digits of the prefix, then the digit that it ends in, then zeros or fs.
    whole = F.floor(length / 4).cast("int")
    digit = F.conv(F.substring(F.concat(six, F.lit("0")), whole + 1, F.lit(1)), 16, 10).cast("int")
    step = F.pow(F.lit(2.0), F.lit(4) - F.pmod(length, F.lit(4))).cast("int")
    low = digit - F.pmod(digit, step)
    head = F.substring(six, F.lit(1), whole)

    def bound(last, fill):
        return F.when(six.isNotNull(), F.rpad(F.when(whole < 32, F.concat(head, F.lower(F.hex(last)))).otherwise(head), 32, fill))

    digits = ipv6_to_hex(F.when(length.between(0, 128) & F.contains(address, F.lit(":")), address))
    out = df.withColumn("_six", digits).select(
        start.alias("start_ip"), (start + size - 1).alias("end_ip"),
        bound(low, "0").alias("start_v6"), bound(low + step - 1, "f").alias("end_v6"),
        *[F.coalesce(F.col(c), F.lit("Unknown")).alias(c) for c in ("country", "city", "region")],
    )
    return out.filter(F.col("start_ip").isNotNull() | F.col("start_v6").isNotNull())


def read_cidr_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header ``network,country,city,region`` -> range table."""
    raw = spark.read.option("header", True).schema(
        "network string, country string, city string, region string"
    ).csv(path)
    return ranges_from_cidr(raw)
