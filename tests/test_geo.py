import pytest

from conftest import SF_SMALL, line, lines_df
from logsift.functions.clean import clean_logs
from logsift.functions.ip import ipv4_to_long, ipv6_to_hex, long_to_ipv4
from logsift.operators.geo import geo_enrich
from logsift.operators.asof import innermost
from logsift.sources import fixtures
from logsift.sources.geo import ranges_from_cidr, read_cidr_csv


def ranges(spark):
    rows = [("10.0.1.0/24", "A", "CityA", "RegA"), ("192.168.0.0/16", "B", None, "RegB"),
            ("8.0.0.0/7", "C", "CityC", "RegC"), ("2001:db9::/32", "D", "CityD", "RegD")]
    return ranges_from_cidr(spark.createDataFrame(rows, "network string, country string, city string, "
                                                        "region string"))


def test_ipv4_to_long(spark):
    df = spark.createDataFrame([("10.0.1.7",), ("255.255.255.255",), ("256.1.1.1",), ("01.2.3.4",), ("",),
                                ("::1",), (None,)], "ip string")
    out = [r[0] for r in df.select(ipv4_to_long("ip")).collect()]
    assert out == [167772423, 4294967295, None, None, None, None, None]
    back = df.limit(2).select(long_to_ipv4(ipv4_to_long("ip"))).collect()
    assert [r[0] for r in back] == ["10.0.1.7", "255.255.255.255"]


def test_cidr_ranges(spark):
    r = {x.country: x for x in ranges(spark).collect()}
    assert (r["A"].start_ip, r["A"].end_ip) == (167772416, 167772671)
    assert r["B"].city == "Unknown"
    assert (r["C"].start_ip, r["C"].end_ip) == (8 << 24, (10 << 24) - 1)


def _enriched(spark, **options):
    ips = ["10.0.1.9", "192.168.77.1", "9.200.1.1", "172.16.0.1", "", "2001:db8::1", "10.0.2.1", "2001:db9::7", "::ffff:10.0.1.9"]
    df = lines_df(spark, [line(ip=ip) for ip in ips])
    out = clean_logs(df, ranges(spark), keep=("id",), **options)
    return {r.id: (r.country, r.city, r.region) for r in out.collect()}


def test_geo_enrich_values_and_unknown(spark):
    got = _enriched(spark)
    assert got[0] == ("A", "CityA", "RegA")
    assert got[1] == ("B", "Unknown", "RegB")
    assert got[2] == ("C", "CityC", "RegC")
    for i in (3, 4, 5, 6):
        assert got[i] == ("Unknown", "Unknown", "Unknown")
    assert got[7] == ("D", "CityD", "RegD") and got[8] == got[0]


def test_join_path_equals_broadcast_path(spark):
    assert _enriched(spark) == _enriched(spark, max_bytes=0)


def test_ipv6_texts(spark):
    import ipaddress

    texts = ["::", "::1", "1::", "2001:db8::1", "2001:DB8:0:0:0:0:0:1", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8",
             "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1::2::3", ":::", "1:::2", "g::1", "12345::", "", ":", "1.2.3.4", "::ffff:1.2.3.4",
             "::1.2.3.256", "64:ff9b::192.0.2.33", "fe80::1%eth0", "1:2:3:4:5:6:7:8::", "::1:2:3:4:5:6:7:8", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "ip string").select(ipv6_to_hex("ip")).collect()]
    want = []
    for t in texts:
        try:
            want.append(None if t is None or "%" in t else ipaddress.IPv6Address(t).packed.hex())
        except ValueError:
            want.append(None)
    assert got == want


def test_ipv6_networks_of_all_lengths(spark):
    import ipaddress

    nets = [f"2001:db8:85a3:8d3:1319:8a2e:370:7348/{n}" for n in range(129)] + ["2001:db8::/129", "x::/3", "1::"]
    out = ranges_from_cidr(spark.createDataFrame([(n, "A", "b", "c") for n in nets], "network string, country string, city string, region string"))
    got = {(r.start_v6, r.end_v6) for r in out.collect()}
    want = {(n.network_address.packed.hex(), n.broadcast_address.packed.hex()) for n in (ipaddress.ip_network(x, strict=False) for x in nets[:129])}
    assert got == want


def test_cidr_csv(spark, tmp_path):
    (tmp_path / "geo.csv").write_text("network,country,city,region\n10.0.0.0/8,A,,R\nbad,B,b,b\n2001::/16,C,c,c\n")
    rows = {r.country: r for r in read_cidr_csv(spark, str(tmp_path / "geo.csv")).collect()}
    assert set(rows) == {"A", "C"} and rows["A"].city == "Unknown" and rows["C"].start_v6 == "2001" + "0" * 28


def test_rows_never_dropped_or_duplicated(spark):
    lines = fixtures.log_lines(spark, SF_SMALL)
    out = clean_logs(lines, fixtures.geo_ranges(spark, SF_SMALL))
    assert out.count() == lines.count()


def test_fact_side_is_neither_shuffled_nor_joined(spark):
    """Four million ranges are searched in place; addresses are located right."""
    many = spark.range(4_000_000).selectExpr("id * 1000 AS start_ip", "id * 1000 + 899 AS end_ip", "concat('C', id % 250) AS country",
                                             "concat('city', id % 5000) AS city", "'r' AS region")
    lines = fixtures.log_lines(spark, SF_SMALL)
    out = clean_logs(lines, many)
    plan = out._jdf.queryExecution().executedPlan().toString()
    for op in ("Exchange", "Join", "BatchEvalPython"):
        assert op not in plan, op
    for r in out.filter("ip_address LIKE '%.%'").select("ip_address", "country").limit(200).collect():
        a, b, c, d = map(int, r.ip_address.split("."))
        n = (a << 24) + (b << 16) + (c << 8) + d
        assert r.country == (f"C{n // 1000 % 250}" if n % 1000 < 900 and n // 1000 < 4_000_000 else "Unknown")


def test_bucketed_join_equals_brute_force(spark):
    """Random non-overlapping ranges of all widths (some spanning many /16
    buckets) and random addresses: the search and the bucketed join must equal
    a plain between-join."""
    import random

    rnd = random.Random(11)
    cuts = sorted(rnd.sample(range(0, 2**32), 60))
    ranges = [(cuts[i], cuts[i + 1] - 1, f"C{i}", "x", "y") for i in range(0, len(cuts) - 1, 2)]
    rdf = spark.createDataFrame(ranges, "start_ip long, end_ip long, country string, city string, region string")
    ips = [rnd.randrange(0, 2**32) for _ in range(400)] + [r[0] for r in ranges] + [r[1] for r in ranges]
    texts = [f"{i >> 24}.{(i >> 16) & 255}.{(i >> 8) & 255}.{i & 255}" for i in ips]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id int, ip_address string")
    want = {}
    for k, ip in enumerate(ips):
        hit = [r[2] for r in ranges if r[0] <= ip <= r[1]]
        want[k] = hit[0] if hit else "Unknown"
    for limit in (1 << 20, 0):
        got = {r.id: r.country for r in geo_enrich(df, rdf, max_bytes=limit).collect()}
        assert got == want


def test_merge_equals_the_broadcast_search(spark, conf):
    """IPv4 and crowded IPv6 ranges (all under 2001::/16), partitions that begin inside and between ranges."""
    conf("spark.sql.shuffle.partitions", "7")
    four = spark.range(300_000).selectExpr("id * 1000 AS start_ip", "id * 1000 + 899 AS end_ip", "CAST(NULL AS STRING) AS start_v6",
                                           "CAST(NULL AS STRING) AS end_v6", "concat('C', id % 250) AS country", "'x' AS city", "'r' AS region")
    six = spark.range(80_000).selectExpr("CAST(NULL AS BIGINT) AS start_ip", "CAST(NULL AS BIGINT) AS end_ip",
                                         "concat('2001', lower(lpad(hex(id * 16), 12, '0')), repeat('0', 16)) AS start_v6",
                                         "concat('2001', lower(lpad(hex(id * 16 + 9), 12, '0')), repeat('f', 16)) AS end_v6",
                                         "concat('S', id % 90) AS country", "CAST(NULL AS STRING) AS city", "'r' AS region")
    ranges = four.unionByName(six)
    v4 = spark.range(4000).selectExpr("concat_ws('.', id % 20, id * 7 % 256, id * 31 % 256, id % 256) AS ip_address")
    v6 = spark.range(4000).selectExpr("concat('2001:0:', lower(hex(id % 23)), ':', lower(hex(id * 37 % 65536)), '::', lower(hex(id % 9 + 1))) AS ip_address")
    odd = spark.createDataFrame([(x,) for x in (None, "", "nobody", "::ffff:0.0.3.7", "2000::1", "2002::1", "255.255.255.255", "0.0.0.0", "2001::")],
                                "ip_address string")
    rows = v4.unionByName(v6).unionByName(odd).unionByName(spark.range(3000).selectExpr("'0.1.2.3' AS ip_address")).repartition(64)
    wide, merged = geo_enrich(rows, ranges), geo_enrich(rows, ranges, max_bytes=0)
    assert merged.count() == rows.count()
    assert wide.exceptAll(merged).count() == 0 and merged.exceptAll(wide).count() == 0
    assert merged.filter("country LIKE 'S%'").count() > 1000 and merged.filter("country LIKE 'C%'").count() > 1000


def test_merge_carries_a_start_over_empty_partitions(spark, conf):
    """One wide range whose addresses fill many partitions that hold no start."""
    conf("spark.sql.shuffle.partitions", "16")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    ranges = spark.createDataFrame([(0, 2**31, "A", "a", "a"), (2**31 + 10, 2**31 + 20, "B", "b", "b")],
                                   "start_ip long, end_ip long, country string, city string, region string")
    rows = spark.range(5000).selectExpr("concat_ws('.', id % 130, id * 3 % 256, id % 256, 5) AS ip_address")
    got = {r.country: r["count"] for r in geo_enrich(rows, ranges, max_bytes=0).groupBy("country").count().collect()}
    want = {r.country: r["count"] for r in geo_enrich(rows, ranges).groupBy("country").count().collect()}
    assert got == want and got["A"] > 4000
    assert {r.country for r in geo_enrich(rows, ranges.limit(0), max_bytes=-1).select("country").collect()} == {"Unknown"}


def test_nested_networks_longest_prefix_wins(spark):
    import ipaddress
    import random

    rnd = random.Random(5)
    nets = {ipaddress.ip_network("0.0.0.0/0"), ipaddress.ip_network("255.255.255.255/32"), ipaddress.ip_network("::/0"), ipaddress.ip_network("ffff::/16")}
    for _ in range(150):
        nets.add(ipaddress.ip_network((rnd.choice((10, 10, 11, 200)) << 24 | rnd.randrange(1 << 8) << 16 | rnd.randrange(1 << 16), rnd.randrange(6, 33)), strict=False))
        nets.add(ipaddress.ip_network(((0x20010DB8 << 96) | rnd.randrange(1 << 6) << 90 | rnd.randrange(1 << 90), rnd.randrange(20, 129)), strict=False))
    nets.discard(ipaddress.ip_network("0.0.0.0/0"))
    places = {n: f"N{k}" for k, n in enumerate(sorted(nets, key=str))}
    ranges = ranges_from_cidr(spark.createDataFrame([(str(n), p, "c", "r") for n, p in places.items()],
                                                    "network string, country string, city string, region string"))
    addresses = {a for n in nets for a in (n[0], n[-1], n[rnd.randrange(n.num_addresses)])}
    addresses |= {a + d for a in list(addresses) for d in (-1, 1) if 0 <= int(a) + d < 1 << a.max_prefixlen}
    df = spark.createDataFrame([(str(a),) for a in addresses if a.version == 4 or not a.ipv4_mapped], "ip_address string")
    want = {}
    for a in addresses:
        held = [n for n in nets if n.version == a.version and a in n]
        want[str(a)] = places[max(held, key=lambda n: n.prefixlen)] if held else "Unknown"
    flat = innermost(ranges)
    for limit in (1 << 26, 0):
        got = {r.ip_address: r.country for r in geo_enrich(df, flat, max_bytes=limit).collect()}
        assert got == {k: want[k] for k in got} and len(got) > 1000
    assert innermost(ranges.limit(0)).count() == 0
    odd = spark.createDataFrame([(3, 9, "A", "a", "a")], "start_ip long, end_ip long, country string, city string, region string")
    from logsift.operators.geo import complete
    with pytest.raises(Exception, match="not a network"):
        innermost(complete(odd)).collect()
