"""Reconciling a host inventory. Customers stand for the desired rows, some naming the same host."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import inventory as inv
from tidewatch.plans.registry import Tables, query


def desired(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    sheet = t.customer.select(
        key.alias("row_idx"),
        F.when(F.col("c_mktsegment") == "BUILDING", "stopped").otherwise("running").alias("status"),
        (F.col("c_nationkey") + 1).cast("string").alias("cpu"),
        F.lit("2048").alias("mem"),
        F.concat(F.lit("h"), F.floor(F.col("c_acctbal") / 10)).alias("host"),
        F.lower("c_mktsegment").alias("name"),
        F.concat(F.lit("grp"), "c_nationkey").alias("grp"),
        F.concat(F.lit("nc"), key).alias("nc_id"),
        F.concat(F.lit("10.0.0."), "c_nationkey").alias("ip"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("10.1.0."), "c_nationkey")).alias("pip"),
    )
    return inv.running_rows(sheet)


def actual_hosts(t: Tables) -> DataFrame:
    """Hosts that exist already: those named by customers of two regions' nations."""
    known = t.customer.filter("c_nationkey % 5 < 2").groupBy(
        F.concat(F.lit("h"), F.floor(F.col("c_acctbal") / 10)).alias("host")
    )
    rows = known.agg(F.min("c_custkey").alias("k"), F.min(F.lower("c_mktsegment")).alias("name"), F.min("c_nationkey").alias("n"))
    linked = F.when(F.col("n") == 0, F.array(F.lit("10001"), F.lit("10186"))).otherwise(F.array(F.lit("10001")))
    ip = F.concat(F.lit("(10.0.0."), "n", F.lit(")(10.1.0."), "n", F.lit(")"))
    return rows.select(
        F.col("k").cast("string").alias("hostid"), "host", F.concat("name", ip).alias("name"), linked.alias("template_ids")
    )


def actual_groups(t: Tables) -> DataFrame:
    n = F.col("n_nationkey")
    return t.nation.filter("n_regionkey < 3").select(
        (n + 500).cast("string").alias("groupid"), F.concat(F.lit("grp"), n).alias("name")
    )


_SQL = """
    d AS (SELECT c_custkey AS row_idx, 'h' || floor(c_acctbal / 10)::BIGINT AS host, 'grp' || c_nationkey AS grp,
                 '10.0.0.' || c_nationkey AS ip,
                 lower(c_mktsegment) || '(10.0.0.' || c_nationkey || ')('
                 || CASE WHEN c_acctbal > 0 THEN '10.1.0.' || c_nationkey ELSE 'None' END || ')' AS hname,
                 'CPU:(' || (c_nationkey + 1) || ')核 内存：(2048)Mb NC_ID:(nc' || c_custkey || ')' AS descr
          FROM customer WHERE c_mktsegment <> 'BUILDING'),
    a AS (SELECT 'h' || floor(c_acctbal / 10)::BIGINT AS host, min(c_custkey)::VARCHAR AS hostid,
                 min(lower(c_mktsegment)) || '(10.0.0.' || min(c_nationkey) || ')(10.1.0.' || min(c_nationkey) || ')' AS name,
                 min(c_nationkey) = 0 AS linked
          FROM customer WHERE c_nationkey % 5 < 2 GROUP BY 1),
    g AS (SELECT 'grp' || n_nationkey AS grp, (n_nationkey + 500)::VARCHAR AS groupid FROM nation WHERE n_regionkey < 3)
"""


@query("missing_groups", f"WITH {_SQL} SELECT DISTINCT grp FROM d WHERE grp NOT IN (SELECT grp FROM g)")
def missing_groups(t: Tables) -> DataFrame:
    return inv.missing_groups(desired(t), actual_groups(t))


@query(
    "inventory_actions",
    f"""
    WITH {_SQL},
    s AS (SELECT d.*, lag(hname) OVER (PARTITION BY d.host ORDER BY row_idx) AS before, a.hostid, a.name, a.linked, g.groupid
          FROM d LEFT JOIN a USING (host) LEFT JOIN g USING (grp))
    SELECT NULL::BIGINT AS row_idx, 0 AS seq, 'create_group' AS action, NULL AS host, NULL AS hostid, grp, grp AS value
    FROM (SELECT DISTINCT grp FROM d WHERE grp NOT IN (SELECT grp FROM g))
    UNION ALL
    SELECT row_idx, 1, 'create_host', host, hostid, grp,
           '{{"host":"' || host || '","name":"' || hname || '","description":"' || descr
           || '","interfaces":[{{"type":1,"main":1,"useip":1,"ip":"' || ip || '","dns":"","port":"10050"}}],"groups":[{{"groupid":'
           || coalesce('"' || groupid || '"', 'null') || '}}],"templates":[{{"templateid":"10186"}}]}}'
    FROM s WHERE before IS NULL AND hostid IS NULL
    UNION ALL
    SELECT row_idx, 2, 'update_name', host, hostid, grp, hname FROM s
    WHERE (before IS NOT NULL OR hostid IS NOT NULL) AND hname <> coalesce(before, name)
    UNION ALL
    SELECT row_idx, 3, 'add_template', host, hostid, grp, '10001,10186' FROM s
    WHERE before IS NULL AND hostid IS NOT NULL AND NOT linked
    """,
)
def inventory_actions(t: Tables) -> DataFrame:
    return inv.inventory_actions(desired(t), actual_hosts(t), actual_groups(t))


@query("host_names", f"WITH {_SQL} SELECT row_idx, hname, descr AS description FROM d")
def host_names(t: Tables) -> DataFrame:
    return inv.with_names(desired(t)).select("row_idx", "hname", "description")
