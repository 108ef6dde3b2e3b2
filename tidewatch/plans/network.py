"""Firewall policies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.firewall import policy_table
from tidewatch.plans.registry import Tables, query


def policy_lines(t: Tables) -> DataFrame:
    """Config lines: five files, one rule per order; very dear orders lack the closing line."""
    order, status = F.col("o_orderkey"), F.col("o_orderstatus")

    def file(key: str) -> Column:
        return F.concat(F.lit("fw"), F.pmod(key, F.lit(5))).alias("file")

    def at(key: str) -> Column:
        return (F.col(key) * 10 + F.col("_l.kind")).alias("line_no")

    def line(kind: int, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("line"))

    def text(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    cust = F.col("o_custkey").cast("string")
    zone = text("interzone source z", F.pmod("o_custkey", F.lit(7)), " destination ", status)
    act = F.when(status == "F", "permit").otherwise("deny")
    own = F.array(
        F.when(status == "P", line(0, zone)),
        F.when(status == "F", line(1, text("  comment C", order, " user U", cust, " "))),
        F.when(status == "O", line(1, text("comment C", order))),
        line(3, text("destination-ip d", cust)),
        F.when(F.col("o_totalprice") > 250000, line(3, text("destination-ip e", cust))),
        F.when(F.col("o_totalprice") > 100000, line(5, text("rule ", order, " ", act))),
        F.when(F.col("o_totalprice") <= 450000, line(6, F.when(status == "O", "rule disable").otherwise("rule enable"))),
    )
    listed = F.array(
        line(2, text("source-ip s", F.col("l_suppkey"))),
        F.when(F.col("l_discount") >= 0.05, line(4, text("service p", F.col("l_partkey")))),
    )
    heads = t.orders.withColumn("_l", F.explode(own)).where("_l IS NOT NULL").select(file("o_orderkey"), at("o_orderkey"), "_l.line")
    lists = t.lineitem.withColumn("_l", F.explode(listed)).where("_l IS NOT NULL").select(file("l_orderkey"), at("l_orderkey"), "_l.line")
    return heads.unionByName(lists)


FLAT_SQL = """
    WITH orders5 AS (SELECT *, 'fw' || (o_orderkey % 5) AS file FROM orders), o AS (
      SELECT *, MIN(CASE WHEN o_totalprice <= 450000 THEN o_orderkey END)
                OVER (PARTITION BY file ORDER BY o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS seg,
             LAST_VALUE(CASE WHEN o_orderstatus = 'P' THEN 'z' || (o_custkey % 7) END IGNORE NULLS)
                OVER (PARTITION BY file ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS z1,
             LAST_VALUE(CASE WHEN o_orderstatus = 'P' THEN o_orderstatus END IGNORE NULLS)
                OVER (PARTITION BY file ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS z2,
             LAST_VALUE(CASE WHEN o_totalprice > 100000 THEN CASE o_orderstatus WHEN 'F' THEN 'permit' ELSE 'deny' END END IGNORE NULLS)
                OVER (PARTITION BY file ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS pol
      FROM orders5),
    head AS (
      SELECT file, seg,
             arg_max(coalesce(z1, ''), o_orderkey) AS interzone_source, arg_max(coalesce(z2, ''), o_orderkey) AS interzone_dest,
             arg_max(coalesce(pol, ''), o_orderkey) AS policy,
             coalesce(max(CASE WHEN o_totalprice > 100000 THEN o_orderkey END)::VARCHAR, '') AS ruleid,
             coalesce('C' || max(CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderkey END), '') AS comment,
             coalesce('U' || arg_max(CASE WHEN o_orderstatus = 'F' THEN o_custkey END, o_orderkey), '') AS commentuser,
             arg_max(CASE o_orderstatus WHEN 'O' THEN 'disable' ELSE 'enable' END, o_orderkey) AS rule_state
      FROM o WHERE seg IS NOT NULL GROUP BY 1, 2),
    dst AS (SELECT file, seg, 'd' || o_custkey AS dest_ip FROM o
            UNION ALL SELECT file, seg, 'e' || o_custkey FROM o WHERE o_totalprice > 250000),
    l AS (SELECT file, seg, lineitem.* FROM lineitem JOIN o ON o_orderkey = l_orderkey)
    SELECT head.file, interzone_source, interzone_dest, ruleid, comment, commentuser,
           's' || src.l_suppkey AS source_ip, dest_ip, 'p' || svc.l_partkey AS service, rule_state, policy
    FROM head JOIN dst USING (file, seg) JOIN l src USING (file, seg)
    JOIN (SELECT * FROM l WHERE l_discount >= 0.05) svc USING (file, seg)
    """


@query("firewall_flat", FLAT_SQL)
def firewall_flat(t: Tables) -> DataFrame:
    return policy_table(policy_lines(t))
