from __future__ import annotations

import ipaddress
import random
import time

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from tidewatch.functions.net import ip_key, long_to_ip
from tidewatch.operators import geo as geo_operators
from tidewatch.operators.geo import BROADCAST_BYTES, PIECE_BYTES, disjoint_ranges, finest_bits, geo_enrich, visible_stretches
from tidewatch.sources.landed import SCHEMAS

GEO6 = SCHEMAS["geo_ranges6"]


def make_ranges(rnd):
    out, at = [], 0
    while at < 4_000_000:
        lo = at + rnd.choice([0, 1, 300, 70000])
        hi = lo + rnd.choice([0, 10, 255, 65535, 200000])
        i = len(out)
        lon = rnd.choice([0.0, 1.5, -7.25])
        out.append((lo, hi, lon, 2.0, f"n{i}", None, f"i{i}", rnd.choice([None, "c"]), None, rnd.choice([None, "r"]), None))
        at = hi + 1
    return out


@pytest.mark.parametrize("limit", [BROADCAST_BYTES, 60_000, 0])
def test_both_ways_equal_brute_force(spark, limit):
    rnd = random.Random(11)
    ranges = make_ranges(rnd)
    numbers = [rnd.randrange(0, 4_400_000) for _ in range(400)]
    numbers += [r[0] for r in ranges] + [r[1] for r in ranges] + [numbers[0]] * 200
    data = [(i, n) for i, n in enumerate(numbers)]
    df = spark.createDataFrame(data, "id int, n bigint").select("id", long_to_ip(F.col("n")).alias("sip"), F.lit("0.0.0.0").alias("dip"))
    odd = spark.createDataFrame([(-1, "0.0.0.0", "1.1"), (-2, None, "::1"), (-3, "300.1.1.1", "0.0.0.9")], "id int, sip string, dip string")
    geo = spark.createDataFrame(ranges, SCHEMAS["geo_ranges"])
    got = geo_enrich(df.unionByName(odd), ["sip", "dip"], geo, limit)
    assert got.columns[:3] == ["id", "sip", "dip"] and "dip_region_zh" in got.columns

    def place(n):
        r = next((r for r in ranges if r[0] <= n <= r[1]), None)
        return (None, None, None) if r is None else (r[4], r[7], (r[2], r[3]) if r[2] else None)

    want = {i: place(n) if n else (None, None, None) for i, n in data} | {-1: (None,) * 3, -2: (None,) * 3, -3: (None,) * 3}
    have = {r["id"]: (r["sip_country_name"], r["sip_city_name_en"], tuple(r["sip_location"]) if r["sip_location"] else None) for r in got.collect()}
    assert have == want
    assert got.filter("id = -3").first()["dip_country_name"] == place(9)[0]


def test_rows_are_walked_once_and_few_addresses_are_sent(spark, monkeypatch):
    """Beyond a broadcast of the ranges, rows are shuffled once for each column of many addresses, busy buckets by several tasks, and not at
    all for a column of few."""
    monkeypatch.setattr(geo_operators, "WALK_ROWS", 40)
    rnd = random.Random(5)
    ranges = make_ranges(rnd)
    data = [(i, rnd.choice([7, rnd.randrange(60_000), rnd.randrange(4_400_000)]), rnd.choice([None, 8, 400_000])) for i in range(3000)]
    df = spark.createDataFrame(data, "id int, n bigint, m bigint").select("id", long_to_ip(F.col("n")).alias("sip"), long_to_ip(F.col("m")).alias("dip"))
    df = df.withColumn("sip", F.when(F.col("id") % 50 == 0, "1.2.3").when(F.col("id") % 50 != 1, F.col("sip")))
    got = geo_enrich(df, ["sip", "dip"], spark.createDataFrame(ranges, SCHEMAS["geo_ranges"]), 5_000)
    plan = got._jdf.queryExecution().executedPlan().toString()

    def place(n):
        return next((r[4] for r in ranges if n and r[0] <= n <= r[1]), None)

    want = {i: (place(n) if i % 50 > 1 else None, place(m)) for i, n, m in data}
    assert {r["id"]: (r["sip_country_name"], r["dip_country_name"]) for r in got.collect()} == want and got.count() == 3000
    assert got.columns[3:5] == ["sip_location", "sip_country_name"]
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_finest_bits(spark):
    geo = spark.createDataFrame([(0, 2**24 - 1, 1.0, 1.0, *[None] * 7)], SCHEMAS["geo_ranges"])
    whole = disjoint_ranges(geo)
    size = PIECE_BYTES + len('{"location":{"lon":1.0,"lat":1.0}}')
    assert finest_bits(whole, 2**16 * size) == 8 and finest_bits(whole, 300 * size) == 16 and finest_bits(whole, size) == 24
    assert finest_bits(whole, 0) is None
    crowd = spark.createDataFrame([(i * 2, i * 2, 1.0, 1.0, *[None] * 7) for i in range(2000)], SCHEMAS["geo_ranges"])
    assert finest_bits(disjoint_ranges(crowd), 2000 * size) == 8 and finest_bits(disjoint_ranges(crowd.where("start_ip % 512 = 0")), 10**9) == 8
    assert rows(geo_enrich(spark.createDataFrame([("0.1.2.3",)], "ip string"), ["ip"], geo.limit(0)), "ip_country_name") == [(None,)]


@pytest.mark.parametrize("limit", [BROADCAST_BYTES, 0])
def test_overlapping_ranges_have_one_rule(spark, limit):
    rnd = random.Random(3)
    ranges = [(100, 1000), (200, 300), (200, 400), (200, 300), (50, 70000), (65536, 140000), (900, 100), (500, 500)]
    ranges += [(lo, lo + rnd.choice([0, 5, 90, 3000])) for lo in (rnd.randrange(200_000) for _ in range(150))]
    table = [(lo, hi, 1.0, 2.0, f"n{i:03d}", *[None] * 6) for i, (lo, hi) in enumerate(ranges)]
    numbers = sorted({n for lo, hi in ranges for n in (lo - 1, lo, hi, hi + 1) if n > 0} | {rnd.randrange(1, 250_000) for _ in range(500)})
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint").select("n", long_to_ip(F.col("n")).alias("sip"))
    got = geo_enrich(df, ["sip"], spark.createDataFrame(table, SCHEMAS["geo_ranges"]), limit)

    def place(n):
        held = [(lo, -hi, -i) for i, (lo, hi) in enumerate(ranges) if lo <= n <= hi]
        return f"n{-max(held)[2]:03d}" if held else None

    assert [(r["n"], r["sip_country_name"]) for r in got.orderBy("n").collect()] == [(n, place(n)) for n in numbers]


def held_by(ranges, n):
    """The range that counts for an address: starts last, then ends first."""
    found = [(lo, -hi) for lo, hi in ranges if lo <= n <= hi]
    return (max(found)[0], -max(found)[1]) if found else None


@pytest.mark.parametrize("seed", range(6))
def test_sweep_equals_brute_force(seed):
    rnd = random.Random(seed)
    ranges = {(lo, lo + rnd.randrange(0, rnd.choice([1, 8, 60, 200]))) for lo in (rnd.randrange(200) for _ in range(rnd.choice([1, 5, 60])))}
    order = sorted(ranges, key=lambda r: (r[0], -r[1]))
    out = list(visible_stretches((b, lo, hi, (lo, hi)) for b in (1, 2) for lo, hi in order))
    for bucket in (1, 2):
        own = {n: mark for b, lo, hi, mark in out if b == bucket for n in range(lo, hi + 1)}
        assert sum(hi - lo + 1 for b, lo, hi, _ in out if b == bucket) == len(own)
        assert own == {n: held_by(ranges, n) for n in range(500) if held_by(ranges, n)}


def test_many_nested_ranges_in_one_bucket(spark):
    ranges = [(i, 65_535 - i) for i in range(30_000)]
    began = time.perf_counter()
    assert len(list(visible_stretches((0, lo, hi, lo) for lo, hi in ranges))) == 59_999
    assert time.perf_counter() - began < 2
    table = spark.createDataFrame([(lo, hi, 1.0, 2.0, f"n{lo}", *[None] * 6) for lo, hi in ranges], SCHEMAS["geo_ranges"])
    df = spark.createDataFrame([(n,) for n in (1, 29_999, 30_000, 35_535, 35_536, 65_534)], "n bigint").select("n", long_to_ip(F.col("n")).alias("sip"))
    got = {r["n"]: r["sip_country_name"] for r in geo_enrich(df, ["sip"], table).collect()}
    assert got == {1: "n1", 29_999: "n29999", 30_000: "n29999", 35_535: "n29999", 35_536: "n29999", 65_534: "n1"}


def test_address_keys(spark):
    def key(text):
        try:
            address = ipaddress.ip_address(text)
        except ValueError:
            return None
        return f"{int(address) if address.version == 6 else int(address) + (0xFFFF << 32):032x}"

    texts = ["::", "::1", "1::", "2001:DB8::8a2e:370:7334", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::ffff:1.2.3.4", "64:ff9b::255.0.0.1", "1.2.3.4",
             "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1::2::3", ":::", "1:::2", "12345::", "g::", "::1.2.3", "::1.2.3.400", "1.2.3.4:5", "", " ::1", ":1:2:3:4:5:6:7:8", "1.2.3", "0.0.0.0"]
    rnd = random.Random(4)
    texts += [str(ipaddress.IPv6Address(rnd.getrandbits(128) & ~(((1 << rnd.choice([0, 16, 64])) - 1) << rnd.choice([0, 32])))) for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r["t"]: r["k"] for r in df.select("t", ip_key(F.col("t")).alias("k")).collect()} == {t: key(t) for t in texts}


@pytest.mark.parametrize("limit", [BROADCAST_BYTES, 0])
def test_mixed_addresses(spark, limit):
    rnd = random.Random(8)
    base = int(ipaddress.IPv6Address("2001:db8::"))
    ranges = [(base + (rnd.getrandbits(rnd.choice([20, 70, 100])) << rnd.choice([0, 8])), 1 << rnd.choice([0, 1, 16, 64, 80])) for _ in range(120)]
    ranges = [(lo, lo + size - 1 + rnd.choice([0, 0, 5])) for lo, size in ranges] + [(base, base), (1 << 125, (1 << 127) - 1), (base + 9, base + 3)]
    v6 = lambda n: str(ipaddress.IPv6Address(n))
    table6 = spark.createDataFrame([(v6(lo), v6(hi).upper(), 1.0, 2.0, f"{lo:x}-{hi:x}", *[None] * 6) for lo, hi in ranges], GEO6)
    table4 = spark.createDataFrame([(16909056, 16909063, 3.0, 4.0, "four", *[None] * 6)], SCHEMAS["geo_ranges"])
    numbers = sorted({n for lo, hi in ranges for n in (lo, hi, hi + 1)} | {(1 << 127) + 5})
    rows_ = [(i, rnd.choice([v6(n), ipaddress.IPv6Address(n).exploded]), n) for i, n in enumerate(numbers)]
    odd = [(-1, "1.2.3.4"), (-2, "::ffff:1.2.3.4"), (-3, "9.9.9.9"), (-4, "bad::1::"), (-5, None)]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows_] + odd, "id int, sip string")
    got = {r["id"]: r["sip_country_name"] for r in geo_enrich(df, ["sip"], table4, limit, table6).collect()}
    good = [(lo, hi) for lo, hi in ranges if lo <= hi]

    def place(n):
        held = held_by(good, n)
        return f"{held[0]:x}-{held[1]:x}" if held else None

    assert got == {i: place(n) for i, _, n in rows_} | {-1: "four", -2: "four", -3: None, -4: None, -5: None}


def test_addresses_are_read_once_per_text(spark, monkeypatch):
    """Texts are made distinct before they are read as addresses, and rows get their places by text; a mapped address takes what its IPv4 range
    lacks from the IPv6 one."""
    read = []
    monkeypatch.setattr(geo_operators, "ip_key", lambda c: read.append(str(c)) or ip_key(c))
    texts = ["2001:db8::1", "2001:DB8:0::1", "::ffff:0.0.0.9", "::FFFF:0:9", "::ffff:0.0.9.9", "0.0.0.9", "fe80::g", "2002::", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "id int, sip string")
    four = spark.createDataFrame([(9, 9, 1.0, 1.0, "four", *[None] * 6)], SCHEMAS["geo_ranges"])
    six = spark.createDataFrame([("2001:db8::", "2001:db8::ffff", 1.0, 1.0, "six", *[None] * 6), ("::ffff:0:0", "::ffff:ffff:ffff", 1.0, 1.0, "all", "zh", *[None] * 5)], SCHEMAS["geo_ranges6"])
    got = geo_enrich(df, ["sip"], four, ranges6=six)
    want = [("six", None)] * 2 + [("four", "zh")] * 2 + [("all", "zh"), ("four", None)] + [(None, None)] * 3
    assert [(r["sip_country_name"], r["sip_country_name_zh"]) for r in got.orderBy("id").collect()] == want * 3
    assert not [c for c in read if "sip" in c] and len(read) == 3


def test_no_ranges_and_no_addresses_of_one_kind(spark):
    none6, none4 = spark.createDataFrame([], GEO6), spark.createDataFrame([], SCHEMAS["geo_ranges"])
    df = spark.createDataFrame([("2001:db8::1",), ("1.2.3.4",)], "sip string")
    assert rows(geo_enrich(df, ["sip"], none4, ranges6=none6), "sip_country_name") == [(None,), (None,)]
