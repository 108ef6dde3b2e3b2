"""Typing, envelopes, routing and places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.net import long_to_ip
from tidewatch.operators.coerce import (
    coerce_by_suffix,
    index_name,
    merge_columns,
    rename_headers,
    split_rejects,
    stamp_eventdate,
    wrap_documents,
)
from tidewatch.operators.geo import geo_enrich
from tidewatch.plans.registry import Tables, query
from tidewatch.sources.landed import SCHEMAS, envelope_rows, row_count


def ntz(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def raw_orders(t: Tables) -> DataFrame:
    """Orders as text: numbers with commas, times in three lengths."""
    at = F.col("o_orderdate") + F.make_dt_interval(secs=F.pmod(F.col("o_orderkey") * 7919, F.lit(86400)))
    kind = F.pmod("o_orderkey", F.lit(3))
    text = (
        F.when(kind == 0, F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 1, F.date_format(at, "yyyy-M-d"))
        .otherwise(F.date_format(at, "yyyyMMdd"))
    )
    return t.orders.select(
        F.format_number(F.col("o_orderkey") * 1000, 0).alias("order_count"),
        F.when((kind == 1) & (F.length(text) < 9), F.date_format(at, "yyyy-MM-dd")).otherwise(text).alias("Start_Time"),
        F.col("o_totalprice").cast("string").alias("discount"),
        "o_orderstatus",
        F.col("o_orderdate").alias("day"),
    )


@query(
    "coerce_suffix",
    """
    SELECT o_orderkey * 1000 AS order_count,
           CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + to_seconds((o_orderkey * 7919) % 86400)
                ELSE o_orderdate END - INTERVAL 8 HOUR AS "Start_Time",
           o_orderstatus, o_orderdate - INTERVAL 8 HOUR AS eventdate, 0::BIGINT AS n_errors
    FROM orders
    """,
)
def coerce_suffix(t: Tables) -> DataFrame:
    typed = coerce_by_suffix(raw_orders(t), exclude=("discount",))
    stamped = stamp_eventdate(typed, F.col("day"))
    return stamped.select(
        "order_count",
        ntz("Start_Time").alias("Start_Time"),
        "o_orderstatus",
        "eventdate",
        F.size("_errors").cast("bigint").alias("n_errors"),
    )


@query(
    "rows_per_day",
    """
    SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n_rows, sum(o_orderkey) AS total
    FROM orders GROUP BY 1
    """,
)
def rows_per_day(t: Tables) -> DataFrame:
    """Rows and total per local day after typing."""
    typed = stamp_eventdate(coerce_by_suffix(raw_orders(t), exclude=("discount",)), F.col("day"))
    local = (F.col("eventdate") + F.expr("interval 8 hours")).cast("date")
    return typed.groupBy(local.alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("order_count") / 1000).cast("bigint").alias("total")
    )


@query(
    "coerce_rejects",
    """
    SELECT event_id,
           CASE event_type WHEN 'error' THEN 'hit_count' WHEN 'signup' THEN 'seen_time'
                ELSE 'hit_count,seen_time' END AS errors
    FROM events WHERE event_type IN ('error', 'signup', 'click')
    """,
)
def coerce_rejects(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    raw = t.events.select(
        "event_id",
        F.when(kind.isin("error", "click"), "n/a")
        .when(kind == "view", F.lit(None))
        .otherwise(F.format_number("user_id", 0))
        .alias("hit_count"),
        F.when(kind == "signup", "2024-1-1")
        .when(kind == "click", F.lit(""))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .alias("seen_time"),
    )
    bad = split_rejects(coerce_by_suffix(raw))[1]
    return bad.select("event_id", F.array_join("_errors", ",").alias("errors"))


@query(
    "json_envelope",
    """
    SELECT event_id::VARCHAR AS id, n * 1000 AS hit_count, 2::BIGINT AS row_count
    FROM events, (VALUES (1), (2)) AS v(n) WHERE event_type NOT IN ('error', 'signup')
    """,
)
def json_envelope(t: Tables) -> DataFrame:
    """Answers of two rows each; some broken, some without rows."""
    row = [
        F.struct(F.col("event_id").cast("string").alias("id"), F.lit(text).alias("hit_count"))
        for text in ("1,000", "2,000")
    ]
    whole = F.to_json(F.struct(F.lit("2").alias("rowCount"), F.array(*row).alias("result")))
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", F.substring(whole, F.lit(1), F.length(whole) - 1))
        .when(kind == "signup", F.to_json(F.struct(F.lit("0").alias("rowCount"))))
        .otherwise(whole)
    )
    answers = t.events.select(text.alias("answer")).withColumn("row_count", row_count(F.col("answer")))
    rows = envelope_rows(answers, "answer", "struct<id string, hit_count string>")
    return coerce_by_suffix(rows, exclude=("row_count",)).select("id", "hit_count", "row_count")


@query(
    "list_envelope",
    """
    SELECT o_orderkey AS attack_count, o_custkey AS sport, o_orderdate - INTERVAL 8 HOUR AS first_time
    FROM orders WHERE o_orderstatus <> 'P'
    """,
)
def list_envelope(t: Tables) -> DataFrame:
    """Event answers whose rows are in `list`; some ports are numbers, some text with commas."""
    port = F.when(F.col("o_orderstatus") == "O", F.col("o_custkey").cast("string")).otherwise(
        F.format_number("o_custkey", 0)
    )
    row = F.struct(
        F.col("o_orderkey").cast("string").alias("attack_count"),
        port.alias("sport"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("first_time"),
    )
    rows = F.when(F.col("o_orderstatus") != "P", F.array(row))
    answers = t.orders.select(F.to_json(F.struct(rows.alias("list"))).alias("answer"))
    out = envelope_rows(answers, "answer", "struct<attack_count string, sport string, first_time string>", "list")
    return coerce_by_suffix(out).select("attack_count", "sport", ntz("first_time").alias("first_time"))


@query(
    "month_route",
    """
    SELECT 'waf_' || lower(o_orderpriority) || '-' || strftime(o_orderdate, '%Y.%m') AS _index,
           lower(o_orderpriority) AS _type, o_orderkey, o_orderdate - INTERVAL 8 HOUR AS eventdate
    FROM orders
    """,
)
def month_route(t: Tables) -> DataFrame:
    rows = stamp_eventdate(t.orders, F.col("o_orderdate"))
    table = F.lower("o_orderpriority")
    docs = wrap_documents(rows, index_name(F.col("o_orderdate"), table), table)
    return docs.select("_index", "_type", "_source.o_orderkey", "_source.eventdate")


def customer_ranges(t: Tables) -> DataFrame:
    """One address range per customer, with gaps; the place is the customer's nation."""
    start = F.col("c_custkey") * 2000 + 16777216
    nation, number = F.concat(F.lit("N"), "c_nationkey"), F.col("c_nationkey")
    return t.customer.select(
        start.alias("start_ip"),
        (start + 1399).alias("end_ip"),
        (number * 1.5).alias("lon"),
        (number * -0.5).alias("lat"),
        nation.alias("country_name"),
        F.when(number % 2 == 0, F.concat(F.lit("国"), "c_nationkey")).alias("country_name_zh"),
        F.concat(F.lit("C"), "c_nationkey").alias("country_iso_code"),
        F.lower("c_mktsegment").alias("city_name_en"),
        F.lit(None).cast("string").alias("city_name_zh"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("R"), "c_custkey")).alias("region_code"),
        F.lit(None).cast("string").alias("region_zh"),
    )


def flow_rows(t: Tables) -> DataFrame:
    """Flow rows under their long headers. The target side has few addresses, so these are hot."""
    source = F.col("l_orderkey") * 200 + F.col("l_linenumber") * 31 + 16777216
    target = F.col("l_suppkey") * 13000 + 16777216
    flag = F.col("l_returnflag")
    return t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("设备编号"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("起始时间"),
        long_to_ip(source).alias("源地址"),
        F.when(flag == "R", "0.0.0.0").when(flag == "A", "999.1.1.1").otherwise(long_to_ip(target)).alias("目标地址"),
        F.format_number(F.col("l_partkey") * 1000, 0).alias("上行流量"),
        F.col("l_linenumber").cast("string").alias("NAT端口"),
    )


_FLOW_SQL = """
    WITH r AS (
      SELECT c_custkey * 2000 + 16777216 AS lo, c_custkey * 2000 + 16777216 + 1399 AS hi,
             CASE WHEN c_nationkey <> 0 THEN c_nationkey * 1.5 END::DOUBLE AS lon,
             'N' || c_nationkey AS country,
             CASE WHEN c_nationkey % 2 = 0 THEN '国' || c_nationkey END AS zh,
             lower(c_mktsegment) AS city,
             CASE WHEN c_acctbal > 0 THEN 'R' || c_custkey END AS region
      FROM customer),
    f AS (
      SELECT *, l_orderkey * 200 + l_linenumber * 31 + 16777216 AS src,
             CASE WHEN l_returnflag NOT IN ('R', 'A') THEN l_suppkey * 13000 + 16777216 END AS dst
      FROM lineitem)
    SELECT l_orderkey::VARCHAR AS dev, l_shipdate - INTERVAL 8 HOUR AS starttime,
           l_partkey * 1000 AS upcount, l_linenumber::BIGINT AS napport,
           s.lon AS sip_lon, s.country AS sip_country_name, s.zh AS sip_country_name_zh,
           s.city AS sip_city_name_en, s.region AS sip_region_code,
           d.lon AS dip_lon, d.country AS dip_country_name, d.region AS dip_region_code
    FROM f LEFT JOIN r s ON f.src BETWEEN s.lo AND s.hi LEFT JOIN r d ON f.dst BETWEEN d.lo AND d.hi
"""


def _flow_places(t: Tables, **how: int) -> DataFrame:
    typed = coerce_by_suffix(rename_headers(flow_rows(t)))
    placed = geo_enrich(typed, ["sip", "dip"], customer_ranges(t), **how)
    return placed.select(
        "dev",
        ntz("starttime").alias("starttime"),
        "upcount",
        "napport",
        F.col("sip_location.lon").alias("sip_lon"),
        "sip_country_name",
        "sip_country_name_zh",
        "sip_city_name_en",
        "sip_region_code",
        F.col("dip_location.lon").alias("dip_lon"),
        "dip_country_name",
        "dip_region_code",
    )


@query("flow_places", _FLOW_SQL)
def flow_places(t: Tables) -> DataFrame:
    return _flow_places(t)


@query("flow_places_walk", _FLOW_SQL)
def flow_places_walk(t: Tables) -> DataFrame:
    """The same by the ordered walk, as for a range table too large to broadcast."""
    return _flow_places(t, broadcast_bytes=0)


@query(
    "flow_places6",
    """
    WITH a AS (SELECT l_orderkey, l_linenumber AS n, printf('%04x', l_suppkey % 65536) AS s, printf('%04x', l_partkey % 65536) AS p, l_suppkey FROM lineitem),
         k AS (SELECT *, CASE WHEN n % 7 = 0 THEN NULL WHEN n % 3 = 0 THEN '20010db8' || s || repeat('0', 16) || p
                              WHEN n % 3 = 1 THEN '20010db8' || s || repeat('0', 15) || '1' || p END AS key FROM a),
         h AS (SELECT s_suppkey AS n, '20010db8' || printf('%04x', s_suppkey % 65536) AS h FROM supplier),
         r AS (SELECT rpad(h, 32, '0') AS lo, rpad(h, 32, 'f') AS hi, 'outer' || n AS place FROM h WHERE n % 3 <> 0 UNION ALL
               SELECT rpad(h, 27, '0') || '10000', rpad(h, 27, '0') || '107ff', 'inner' || n FROM h WHERE n % 2 = 0 UNION ALL
               SELECT rpad('20010db8', 32, '0'), rpad('20010db80028', 32, 'f'), r_name FROM region WHERE r_regionkey = 0),
         b AS (SELECT key, place FROM (SELECT DISTINCT key FROM k) JOIN r ON key BETWEEN lo AND hi
               QUALIFY row_number() OVER (PARTITION BY key ORDER BY lo DESC, hi) = 1)
    SELECT l_orderkey, n AS l_linenumber,
           CASE WHEN n % 7 <> 0 AND n % 3 = 2 AND l_suppkey % 5 = 0 THEN 'four' || l_suppkey ELSE place END AS sip_country_name
    FROM k LEFT JOIN b USING (key)
    """,
)
def flow_places6(t: Tables) -> DataFrame:
    """Addresses of both kinds in several spellings, some unreadable, against overlapping IPv6 ranges."""

    def hexed(c: str) -> Column:
        return F.hex(F.col(c) % 65536)

    net, part = F.concat(F.lit("2001:DB8:"), hexed("l_suppkey")), hexed("l_partkey")
    n = F.col("l_linenumber")
    address = (
        F.when(n % 7 == 0, "fe80::g")
        .when(n % 3 == 0, F.concat(net, F.lit("::"), part))
        .when(n % 3 == 1, F.lower(F.concat(net, F.lit(":0:0:0:1:"), F.lpad(part, 4, "0"))))
        .otherwise(F.concat(F.lit("::ffff:"), long_to_ip(F.col("l_suppkey") + 16777216)))
    )
    s = F.col("s_suppkey")
    net = F.concat(F.lit("2001:db8:"), hexed("s_suppkey"))
    outer = t.supplier.where(s % 3 != 0).select(F.concat(net, F.lit("::")).alias("start_ip"), F.concat(net, F.lit(":ffff" * 5)).alias("end_ip"), F.concat(F.lit("outer"), s).alias("country_name"))
    inner = t.supplier.where(s % 2 == 0).select(F.concat(net, F.lit("::1:0")).alias("start_ip"), F.concat(net, F.lit("::1:7ff")).alias("end_ip"), F.concat(F.lit("inner"), s).alias("country_name"))
    wide = t.region.where("r_regionkey = 0").select(F.lit("2001:db8::").alias("start_ip"), F.lit("2001:db8:28" + ":ffff" * 5).alias("end_ip"), F.col("r_name").alias("country_name"))
    none = {f.name: F.lit(None).cast(f.dataType) for f in T.StructType.fromDDL(SCHEMAS["geo_ranges6"]) if f.name not in outer.columns}
    four = t.supplier.where(s % 5 == 0).select((s + 16777216).alias("start_ip"), (s + 16777216).alias("end_ip"), F.concat(F.lit("four"), s).alias("country_name"))
    flows = t.lineitem.select("l_orderkey", "l_linenumber", address.alias("sip"))
    placed = geo_enrich(flows, ["sip"], four.withColumns(none), ranges6=outer.unionByName(inner).unionByName(wide).withColumns(none))
    return placed.select("l_orderkey", "l_linenumber", "sip_country_name")


@query(
    "merge_columns",
    """
    SELECT s_suppkey, upper(s_name) AS s_name, s_acctbal * 2 AS twice FROM supplier
    """,
)
def merged(t: Tables) -> DataFrame:
    derived = {"s_name": F.upper("s_name"), "twice": F.col("s_acctbal") * 2}
    return merge_columns(t.supplier, derived).select("s_suppkey", "s_name", "twice")
