"""Virtual machine filters, statistics and rankings.

Users stand for machines where events are their samples, suppliers where line items are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.numbers import humanize_bits, humanize_bytes, humanize_percent
from tidewatch.operators import vmstats as vm
from tidewatch.plans.registry import Tables, query

LIMIT = 300


def event_values(t: Tables) -> DataFrame:
    rows = t.events.select(F.col("user_id").alias("vm_id"), F.col("event_type").alias("item"), "value")
    return vm.flagged(rows, LIMIT)


def supplier_samples(t: Tables) -> DataFrame:
    """Wide samples; `netout` is missing on some rows and beyond the sanity limit on others."""
    return t.lineitem.select(
        F.col("l_suppkey").alias("vm_id"),
        F.col("l_discount").alias("cpu"),
        F.col("l_extendedprice").alias("diskread"),
        (F.col("l_quantity") * 4096).alias("diskwrite"),
        (F.col("l_tax") * 1024).alias("netin"),
        F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice") * 3000000).alias("netout"),
    )


_SAMPLES = """
    w AS (SELECT l_suppkey AS vm_id, l_discount AS cpu, l_extendedprice AS diskread, l_quantity * 4096 AS diskwrite,
                 l_tax * 1024 AS netin, CASE WHEN l_returnflag <> 'N' THEN l_extendedprice * 3000000 END AS netout
          FROM lineitem),
    v AS (SELECT vm_id, 'cpu' AS item, cpu AS value FROM w UNION ALL SELECT vm_id, 'diskread', diskread FROM w
          UNION ALL SELECT vm_id, 'diskwrite', diskwrite FROM w UNION ALL SELECT vm_id, 'netin', netin FROM w
          UNION ALL SELECT vm_id, 'netout', netout FROM w)
"""


def _stats_sql(source: str, limit: int) -> str:
    return f"""
    g AS (SELECT vm_id, item, count(*) AS n_samples, count(*) FILTER (WHERE value <= {limit}) AS n_valid,
                 count(*) FILTER (WHERE value > {limit}) AS n_ignored,
                 max(value) FILTER (WHERE value <= {limit}) AS mx, avg(value) FILTER (WHERE value <= {limit}) AS av,
                 list_sort(list(value) FILTER (WHERE value IS NOT NULL)) AS l, median(value) AS exact
          FROM {source} GROUP BY 1, 2),
    s AS (SELECT vm_id, item, n_samples, n_valid, n_ignored,
                 CASE WHEN n_samples = 1 THEN -1 ELSE coalesce(mx, 0) END AS max,
                 CASE WHEN n_samples = 1 THEN -1 ELSE coalesce(av, 0) END AS avg,
                 CASE WHEN n_samples = 1 THEN -1
                      ELSE (l[len(l) // 2 + 1] + l[len(l) // 2 + 2]) / 2 END AS med,
                 CASE WHEN n_samples = 1 THEN -1 ELSE exact END AS exact,
                 n_valid = 0 AND n_samples > 1 AS no_sane, n_samples = 1 AS single_row
          FROM g)
    """


_EVENTS = "v AS (SELECT user_id AS vm_id, event_type AS item, value FROM events)"
_LIMIT = vm.TOO_LARGE


@query(
    "vm_stats",
    f"""
    WITH {_EVENTS}, {_stats_sql('v', LIMIT)}
    SELECT vm_id, item, n_samples, n_valid, n_ignored, max, round(avg, 6) AS avg, med, no_sane, single_row FROM s
    """,
)
def vm_stats(t: Tables) -> DataFrame:
    return vm.item_stats(event_values(t), ["vm_id"], limit=LIMIT).withColumn("avg", F.round("avg", 6))


@query(
    "vm_wide_stats",
    f"""
    WITH {_SAMPLES}, {_stats_sql('v', _LIMIT)}
    SELECT vm_id, item, n_samples, n_valid, n_ignored, max, med, no_sane FROM s
    """,
)
def vm_wide_stats(t: Tables) -> DataFrame:
    values = vm.long_samples(supplier_samples(t), ["vm_id"])
    return vm.item_stats(values, ["vm_id"]).drop("avg", "single_row")


@query(
    "vm_exact_median",
    f"WITH {_SAMPLES}, {_stats_sql('v', _LIMIT)} SELECT vm_id, item, exact AS med FROM s",
)
def vm_exact_median(t: Tables) -> DataFrame:
    """With a low bound, so that some machines count as hot and go through histograms."""
    values = vm.long_samples(supplier_samples(t), ["vm_id"])
    return vm.item_stats(values, ["vm_id"], median="exact", hot_rows=620).select("vm_id", "item", "med")


def _size_text(x: str, mult: int, units: tuple[str, ...]) -> str:
    v = f"({x} * {mult})"
    steps = " ".join(
        f"WHEN {v} < {1024 ** (i + 1)}::DOUBLE THEN printf('%6.1f {u}', {v} / {1024**i}::DOUBLE)"
        for i, u in enumerate(units)
    )
    return f"CASE {steps} ELSE printf('%6.1f {units[-1]}', {v} / {1024 ** len(units)}::DOUBLE) END"


_BYTES = ("B/s  ", "KiB/s", "MiB/s", "GiB/s", "TiB/s")
_BITS = ("bps  ", "Kbps ", "Mbps ", "Gbps ", "Tbps ")


@query(
    "vm_topk",
    f"""
    WITH {_SAMPLES}, {_stats_sql('v', _LIMIT)},
    r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY med DESC NULLS LAST, s_name, vm_id) - 1 AS pos
          FROM s JOIN supplier ON s_suppkey = vm_id)
    SELECT item, pos, '#' || pos || ': ' || CASE
             WHEN item = 'cpu' THEN printf('%6d %%    ', trunc(med * 100)::BIGINT)
             WHEN item LIKE 'disk%' THEN {_size_text('med', 8, _BYTES)}
             ELSE {_size_text('med', 1, _BITS)} END || '  NODE' || s_nationkey || ' (' || s_name || ')' AS line
    FROM r WHERE pos < 8
    """,
)
def vm_topk(t: Tables) -> DataFrame:
    values = vm.long_samples(supplier_samples(t), ["vm_id"])
    vms = t.supplier.select(
        F.col("s_suppkey").alias("vm_id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("NODE"), "s_nationkey").alias("node"),
    )
    stats = vm.item_stats(values, ["vm_id"]).join(vms, "vm_id")
    top = vm.top_items(stats, vm.SUBTYPES["MEDIAN"], ["name", "vm_id"])
    line = vm.report_line(F.col("pos"), vm.item_text(F.col("med"), F.col("item")), F.col("node"), F.col("name"))
    return top.select("item", "pos", line.alias("line"))


@query(
    "vm_ignored",
    f"""
    WITH g AS (SELECT user_id, count(*) FILTER (WHERE value > {LIMIT}) AS n_ignored FROM events GROUP BY 1),
    r AS (SELECT user_id AS vm_id, n_ignored, row_number() OVER (ORDER BY n_ignored DESC, user_id) - 1 AS pos
          FROM g WHERE n_ignored > 0)
    SELECT vm_id, n_ignored, pos, item, value
    FROM r JOIN (SELECT user_id AS vm_id, event_type AS item, value FROM events WHERE value > {LIMIT}) USING (vm_id)
    WHERE pos < 8
    """,
)
def vm_ignored(t: Tables) -> DataFrame:
    """The machines with the most ignored values, with these values; the top list has at most k rows."""
    values = event_values(t)
    top = vm.top_ignored(vm.ignored_counts(values, "vm_id"), "vm_id")
    return vm.ignored_values(values, ["vm_id"]).join(F.broadcast(top), "vm_id")


@query(
    "vm_ignored_header",
    f"""
    SELECT count(*) FILTER (WHERE bad) AS n_ignored_vms, count(*) AS n_vms
    FROM (SELECT user_id, bool_or(value > {LIMIT}) AS bad FROM events GROUP BY 1)
    """,
)
def vm_ignored_header(t: Tables) -> DataFrame:
    return vm.ignored_header(event_values(t), "vm_id")


def parts_as_vms(t: Tables) -> DataFrame:
    kind = F.col("p_type")
    status = (
        F.when(kind == "ECONOMY", "running")
        .when(kind == "SMALL", "paused")
        .when(kind == "MEDIUM", "stopped")
        .when(kind == "PROMO", "prelaunch")
        .when(kind == "LARGE", "suspended")
    )
    return t.part.select(
        F.col("p_partkey").alias("vm_id"), F.col("p_name").alias("name"), F.col("p_brand").alias("node"), status.alias("status")
    )


def part_volumes(t: Tables) -> DataFrame:
    key = F.when(F.col("l_linenumber") == 7, "scsihw").otherwise(F.concat(F.lit("scsi"), "l_linenumber"))
    disk = F.concat("l_returnflag", F.lit("-pool:vm-"), "l_suppkey")
    return t.lineitem.select(
        F.col("l_partkey").alias("vm_id"),
        key.alias("key"),
        F.when(F.col("l_linestatus") == "F", disk).alias("value"),
    )


@query(
    "vm_filter",
    """
    SELECT p_partkey AS vm_id, p_name AS name,
           CASE p_type WHEN 'ECONOMY' THEN 'running' ELSE 'paused' END AS status
    FROM part
    WHERE p_type IN ('ECONOMY', 'SMALL') AND (p_name LIKE '%widget' OR regexp_matches(p_name, '^[a-h]') OR p_name LIKE '_o%')
      AND EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_linenumber <> 7 AND l_linestatus = 'F'
                  AND l_returnflag IN ('A', 'R') AND CAST(l_suppkey AS VARCHAR) LIKE '%1_')
    """,
)
def vm_filter(t: Tables) -> DataFrame:
    chosen = vm.named(parts_as_vms(t), ["*widget", "[a-h]*", "?o*"])
    stored = vm.with_storage(chosen, part_volumes(t), "[!N]-pool:vm-*1?")
    return vm.routed(stored).filter(F.col("route") == "keep").select("vm_id", "name", "status")


@query(
    "vm_routes",
    """
    SELECT p_partkey AS vm_id, CASE p_type WHEN 'ECONOMY' THEN 'keep' WHEN 'SMALL' THEN 'keep' WHEN 'MEDIUM' THEN 'drop'
           WHEN 'PROMO' THEN 'warn' WHEN 'LARGE' THEN 'unknown' ELSE 'node_down' END AS route
    FROM part
    """,
)
def vm_routes(t: Tables) -> DataFrame:
    return vm.routed(parts_as_vms(t)).select("vm_id", "route")


@query(
    "nodes_down",
    """
    SELECT p_brand AS node, min(p_partkey) AS vm_id, count(*) AS n_vms FROM part
    WHERE p_type NOT IN ('ECONOMY', 'SMALL', 'MEDIUM', 'PROMO', 'LARGE') GROUP BY 1
    """,
)
def nodes_down(t: Tables) -> DataFrame:
    return vm.nodes_down(vm.routed(parts_as_vms(t)))


@query("repeated_names", "SELECT p_name AS name, count(*) AS n_vms FROM part GROUP BY 1 HAVING count(*) > 1")
def repeated_names(t: Tables) -> DataFrame:
    return vm.repeated_names(parts_as_vms(t))


def customer_config(t: Tables) -> DataFrame:
    """Packed settings: some uuids shared, some in upper case, empty or missing."""
    h = F.md5(F.floor("c_acctbal").cast("string"))
    uuid = F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    segment = F.col("c_mktsegment")
    uuid = F.when(segment == "MACHINERY", F.upper(uuid)).when(segment == "FURNITURE", "").otherwise(uuid)
    packed = F.concat(F.lit("manufacturer=maker,uuid="), uuid, F.lit(",product=host"))
    return vm.with_uuid(
        t.customer.select(F.col("c_name").alias("name"), F.when(segment != "BUILDING", packed).alias("smbios1"))
    )


_UUID = """
    u AS (SELECT c_name AS name, c_mktsegment, h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] AS uuid
          FROM (SELECT *, md5(floor(c_acctbal)::BIGINT::VARCHAR) AS h FROM customer))
"""


@query(
    "shared_uuids",
    f"""
    WITH {_UUID}, ok AS (SELECT * FROM u WHERE c_mktsegment NOT IN ('MACHINERY', 'FURNITURE', 'BUILDING'))
    SELECT uuid, name, n_dup FROM ok JOIN (SELECT uuid, count(*) AS n_dup FROM ok GROUP BY 1) USING (uuid) WHERE n_dup > 1
    """,
)
def shared_uuids(t: Tables) -> DataFrame:
    return vm.shared_uuids(customer_config(t))


@query(
    "bad_uuids",
    f"""
    WITH {_UUID}
    SELECT name, CASE c_mktsegment WHEN 'MACHINERY' THEN upper(uuid) END AS uuid FROM u
    WHERE c_mktsegment IN ('MACHINERY', 'FURNITURE', 'BUILDING')
    """,
)
def bad_uuids(t: Tables) -> DataFrame:
    return vm.bad_uuids(customer_config(t))


@query(
    "consolidate_average",
    """
    SELECT user_id, time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '1970-01-01') AS ts, round(avg(value), 6) AS value
    FROM events GROUP BY 1, 2
    """,
)
def consolidate_average(t: Tables) -> DataFrame:
    out = vm.consolidate(t.events, ["user_id"], "ts", ["value"], vm.STEPS["month"])
    return out.withColumn("value", F.round("value", 6))


@query(
    "consolidate_max",
    """
    SELECT event_type, time_bucket(INTERVAL 1 MINUTE, ts, TIMESTAMP '1970-01-01') AS ts, max(value) AS value
    FROM events GROUP BY 1, 2
    """,
)
def consolidate_max(t: Tables) -> DataFrame:
    return vm.consolidate(t.events, ["event_type"], "ts", ["value"], vm.STEPS["hour"], "MAX")


@query(
    "recent_samples",
    """
    SELECT event_id, floor(epoch(ts))::BIGINT AS time FROM events
    WHERE floor(epoch(ts)) >= epoch(TIMESTAMP '2024-01-12 06:00:00') - 300
    """,
)
def recent_samples(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("time"))
    return vm.recent(rows, F.unix_seconds(F.lit("2024-01-12 06:00:00").cast("timestamp")))


@query(
    "humanize",
    f"""
    WITH x AS (SELECT *, l_extendedprice * pow(1024, l_linenumber - 3) AS v FROM lineitem)
    SELECT l_orderkey, {_size_text('v', 8, _BYTES)} AS bytes_text, {_size_text('v', 1, _BITS)} AS bits_text,
           printf('%6d %%    ', trunc(l_discount * 100)::BIGINT) AS percent_text
    FROM x
    """,
)
def humanize(t: Tables) -> DataFrame:
    v = F.col("l_extendedprice") * F.pow(F.lit(1024.0), F.col("l_linenumber") - 3)
    return t.lineitem.select(
        "l_orderkey",
        humanize_bytes(v).alias("bytes_text"),
        humanize_bits(v).alias("bits_text"),
        humanize_percent(F.col("l_discount")).alias("percent_text"),
    )
