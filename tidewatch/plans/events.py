"""Repair, purge and retention of monitoring events.

Orders stand for events, line items for alerts, customers for triggers and functions, nations for
hosts. Customers in debt have a second function on the same host, so their events match twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.repair import (
    apply_changes,
    change_text,
    host_alerts,
    host_events,
    purge_changes,
    repair_changes,
    retained,
    retention_end,
)
from tidewatch.operators.sheets import prefix_until_blank
from tidewatch.plans.registry import Tables, query
from tidewatch.session import checkpointed

# Clock range of the affected events: 1996-01-01 to 1999-12-31.
LO, HI = 820454400, 946598400


def monitoring(t: Tables) -> dict[str, DataFrame]:
    first = t.customer.select(F.col("c_custkey").alias("triggerid"), (F.col("c_custkey") * 2).alias("itemid"))
    second = t.customer.filter("c_acctbal < 0").select(
        F.col("c_custkey").alias("triggerid"), (F.col("c_custkey") * 2 + 1).alias("itemid")
    )
    key = F.when(F.col("c_mktsegment") != "BUILDING", "icmpping").otherwise("agent.ping")
    items = t.customer.select(
        F.explode(F.array(F.col("c_custkey") * 2, F.col("c_custkey") * 2 + 1)).alias("itemid"),
        F.col("c_nationkey").cast("bigint").alias("hostid"),
        key.alias("key_"),
    )
    clock = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    return {
        "alerts": t.lineitem.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("alertid"), F.col("l_orderkey").alias("eventid")
        ),
        "events": t.orders.select(
            F.col("o_orderkey").alias("eventid"), F.col("o_custkey").alias("objectid"), clock.alias("clock")
        ),
        "triggers": t.customer.select(F.col("c_custkey").alias("triggerid")),
        "functions": first.unionByName(second),
        "items": items,
        "hosts": t.nation.select(F.col("n_nationkey").cast("bigint").alias("hostid"), F.col("n_name").alias("name")),
    }


def repair_sheet(t: Tables) -> DataFrame:
    """One row per nation, and a second row for each nation of region 4."""
    n = F.col("n_nationkey").cast("bigint")
    region = F.col("n_regionkey")
    rows = t.nation.withColumn("row_idx", F.explode(F.when(region == 4, F.array(n, n + 100)).otherwise(F.array(n))))
    day = F.lit("2019-01-18 22:00:00").cast("timestamp_ntz") + F.make_dt_interval(days=F.col("row_idx").cast("int"))
    return rows.select(
        "row_idx",
        F.col("n_name").alias("name"),
        F.when(region == 0, "删").otherwise("改").alias("op"),
        day.alias("ud1"),
        F.when(region != 1, day + F.expr("interval 90 minutes")).alias("ud2"),
    )


_CHAIN = f"""
    fn AS (SELECT c_custkey AS trig, n_name AS name FROM customer JOIN nation ON n_nationkey = c_nationkey
           WHERE c_mktsegment <> 'BUILDING'
           UNION ALL
           SELECT c_custkey, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey
           WHERE c_mktsegment <> 'BUILDING' AND c_acctbal < 0),
    ev AS (SELECT o_orderkey AS id, epoch(o_orderdate)::BIGINT AS clock, name FROM orders JOIN fn ON trig = o_custkey
           WHERE epoch(o_orderdate) BETWEEN {LO} AND {HI}),
    al AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS eventid, name
           FROM lineitem JOIN ev ON ev.id = l_orderkey)
"""
_SHEET = """
    sheet AS (SELECT row_idx, n_name AS name, n_regionkey = 0 AS del,
                     epoch(TIMESTAMP '2019-01-18 22:00:00')::BIGINT + row_idx * 86400 AS ud1,
                     CASE WHEN n_regionkey <> 1
                          THEN epoch(TIMESTAMP '2019-01-18 23:30:00')::BIGINT + row_idx * 86400 END AS ud2
              FROM (SELECT *, n_nationkey::BIGINT AS row_idx FROM nation
                    UNION ALL SELECT *, n_nationkey::BIGINT + 100 FROM nation WHERE n_regionkey = 4)),
    ra AS (SELECT al.id, sheet.*, row_number() OVER (PARTITION BY row_idx ORDER BY id) AS rn
           FROM al JOIN sheet USING (name)),
    re AS (SELECT ev.id, sheet.*, row_number() OVER (PARTITION BY row_idx ORDER BY id) AS rn,
                  count(*) OVER (PARTITION BY row_idx) AS n
           FROM ev JOIN sheet USING (name))
"""
_COLS = "id, name, row_idx"
_UPDATE_ALL = f"""
    SELECT 'alerts' AS tbl, CASE WHEN del THEN 'delete' ELSE 'update' END AS action,
           CASE WHEN NOT del THEN ud1 END AS new_clock, CASE WHEN NOT del THEN 1 END::INT AS seq, {_COLS}
    FROM ra WHERE del OR ud2 IS NOT NULL
    UNION ALL SELECT 'events', 'delete', NULL, NULL, {_COLS} FROM re WHERE del
    UNION ALL SELECT 'events', 'update', CASE rn WHEN 1 THEN ud1 ELSE ud2 END, rn, {_COLS}
    FROM re WHERE NOT del AND ud2 IS NOT NULL AND n >= 2 AND rn <= 2
"""
_KEEP_FIRST = f"""
    SELECT 'alerts' AS tbl, CASE WHEN rn > 1 THEN 'delete' ELSE 'update' END AS action,
           CASE WHEN rn = 1 THEN ud1 END AS new_clock, CASE WHEN rn = 1 THEN 1 END::INT AS seq, {_COLS}
    FROM ra WHERE ud2 IS NOT NULL
    UNION ALL
    SELECT 'events', CASE WHEN rn > 2 THEN 'delete' ELSE 'update' END,
           CASE rn WHEN 1 THEN ud1 WHEN 2 THEN ud2 END, CASE WHEN rn <= 2 THEN rn END, {_COLS}
    FROM re WHERE ud2 IS NOT NULL AND n >= 2
"""


CHAIN_SQL = f"WITH {_CHAIN} SELECT id AS alertid, eventid, name FROM al"


@query("alert_chain", CHAIN_SQL)
def alert_chain(t: Tables) -> DataFrame:
    return host_alerts(monitoring(t), LO, HI)


@query("event_chain", f"WITH {_CHAIN} SELECT id AS eventid, clock, name FROM ev")
def event_chain(t: Tables) -> DataFrame:
    return host_events(monitoring(t), LO, HI)


def changes_of(t: Tables, policy: str) -> DataFrame:
    tables = monitoring(t)
    events = checkpointed(host_events(tables, LO, HI))
    return repair_changes(host_alerts(tables, LO, HI, events=events), events, repair_sheet(t), policy)


@query("repair_update_all", f"WITH {_CHAIN}, {_SHEET} {_UPDATE_ALL}")
def repair_update_all(t: Tables) -> DataFrame:
    return changes_of(t, "update_all")


@query("repair_keep_first", f"WITH {_CHAIN}, {_SHEET} {_KEEP_FIRST}")
def repair_keep_first(t: Tables) -> DataFrame:
    return changes_of(t, "keep_first")


@query(
    "change_statements",
    f"""
    WITH {_CHAIN}, {_SHEET}, c AS ({_UPDATE_ALL}),
    k AS (SELECT *, CASE tbl WHEN 'alerts' THEN 'alertid' ELSE 'eventid' END AS key FROM c)
    SELECT row_idx, CASE action WHEN 'delete' THEN 'delete from ' || tbl || ' where ' || key || '=' || id || ';'
           ELSE 'update ' || tbl || ' set clock=' || new_clock || ' where ' || key || '=' || id || ';' END AS statement
    FROM k
    """,
)
def change_statements(t: Tables) -> DataFrame:
    text = change_text({"alerts": "alertid", "events": "eventid"})
    return changes_of(t, "update_all").select("row_idx", text.alias("statement"))


APPLIED_SQL = f"""
    WITH {_CHAIN}, {_SHEET}, c AS (SELECT * FROM ({_KEEP_FIRST}) WHERE tbl = 'events'),
    f AS (SELECT id, bool_or(action = 'delete') AS gone,
                 arg_max(new_clock, row_idx * 10 + seq) FILTER (WHERE action = 'update') AS clock
          FROM c GROUP BY id)
    SELECT o_orderkey AS eventid, o_custkey AS objectid, coalesce(f.clock, epoch(o_orderdate)::BIGINT) AS clock
    FROM orders LEFT JOIN f ON f.id = o_orderkey WHERE NOT coalesce(gone, false)
    """


@query("apply_changes", APPLIED_SQL)
def applied(t: Tables) -> DataFrame:
    return apply_changes(monitoring(t)["events"], changes_of(t, "keep_first"), "events", "eventid")


@query(
    "purge_not_listed",
    f"""
    WITH {_CHAIN}
    SELECT 'alerts' AS tbl, 'delete' AS action, id, NULL::BIGINT AS new_clock, name FROM al
    WHERE name NOT IN (SELECT n_name FROM nation WHERE n_nationkey < 12)
    UNION ALL SELECT 'events', 'delete', id, NULL, name FROM ev
    WHERE name NOT IN (SELECT n_name FROM nation WHERE n_nationkey < 12)
    """,
)
def purge_not_listed(t: Tables) -> DataFrame:
    """The list of names ends at its blank row 12."""
    name = F.when(F.col("n_nationkey") != 12, F.col("n_name"))
    keep = prefix_until_blank(t.nation.select(F.col("n_nationkey").alias("row_idx"), name.alias("name")), "name")
    tables = monitoring(t)
    alerts = purge_changes(host_alerts(tables, LO, HI), keep, "alerts", "alertid")
    return alerts.unionByName(purge_changes(host_events(tables, LO, HI), keep, "events", "eventid"))


RETENTION_SQL = """
    WITH RECURSIVE e AS (SELECT event_id AS id, floor(epoch(ts))::BIGINT AS clock FROM events),
    step(i, cutoff) AS (
      SELECT min(clock) + 1000, NULL::BIGINT FROM e
      UNION ALL SELECT i + 1000, i FROM step WHERE i < epoch(DATE '2024-01-15')),
    c AS (SELECT max(cutoff) AS cutoff FROM step)
    SELECT id, clock FROM e, c WHERE cutoff IS NULL OR clock >= cutoff
    """


@query("retention", RETENTION_SQL)
def retention(t: Tables) -> DataFrame:
    clock = F.unix_seconds(F.col("ts").cast("timestamp"))
    rows = t.events.select(F.col("event_id").alias("id"), clock.alias("clock"))
    return retained(rows, retention_end(F.lit("2024-02-15")))


@query(
    "sheet_prefix",
    """
    WITH s AS (SELECT c_custkey, CASE WHEN c_acctbal BETWEEN 9000 AND 9100 THEN '' ELSE c_name END AS name
               FROM customer)
    SELECT c_custkey AS row_idx, name FROM s
    WHERE c_custkey < (SELECT min(c_custkey) FROM s WHERE name = '')
    """,
)
def sheet_prefix(t: Tables) -> DataFrame:
    name = F.when(F.col("c_acctbal").between(9000, 9100), "").otherwise(F.col("c_name"))
    return prefix_until_blank(t.customer.select(F.col("c_custkey").alias("row_idx"), name.alias("name")), "name")
