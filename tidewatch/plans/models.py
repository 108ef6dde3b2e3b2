"""Model views, defaults, option lists and catalog copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import option_list
from tidewatch.operators import metadata as md
from tidewatch.plans.registry import Tables, query


@query(
    "view_xml",
    """
    WITH f AS (SELECT p_brand AS model, p_partkey,
                      CASE WHEN p_size > 10 AND p_brand <> 'Brand#7' THEN '  <field name="x_f' || p_partkey || '"/>' || chr(10) END AS tag
               FROM part),
    b AS (SELECT model, coalesce(string_agg(tag, '' ORDER BY p_partkey), '') AS xml FROM f GROUP BY 1)
    SELECT model, 'uv_' || model || '_list' AS list_name, 'uv_' || model || '_form' AS form_name,
           '<tree string="uv_' || model || '_list">' || chr(10) || xml || '</tree>' AS list_xml,
           '<?xml version="1.0"?>' || chr(10) || '<form string="uv_' || model || '_form">' || chr(10) || '<sheet>' || chr(10)
           || xml || '</sheet></form>' AS form_xml
    FROM b
    """,
)
def view_xml(t: Tables) -> DataFrame:
    """Parts as fields of their brand; one brand has none with the prefix."""
    own = (F.col("p_size") > 10) & (F.col("p_brand") != "Brand#7")
    name = F.concat(F.when(own, "x_f").otherwise("f"), F.col("p_partkey"))
    fields = t.part.select(F.col("p_brand").alias("model"), name.alias("field_name"), F.col("p_partkey").alias("seq"))
    return md.model_views(fields)


@query(
    "prefix_defaults",
    """
    SELECT o_orderkey AS id, 'x_wykg_cust' AS field, o_custkey::VARCHAR AS value, 'x_pg_item' AS model FROM orders
    UNION ALL SELECT o_orderkey, 'x_wykg_status', CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, 'x_pg_item' FROM orders
    """,
)
def prefix_defaults(t: Tables) -> DataFrame:
    records = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("x_wykg_cust"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("x_wykg_status"),
        F.col("o_totalprice").alias("x_price"),
    )
    return md.defaults_of(records, ["id"], "x_wykg_", "x_pg_item")


@query(
    "option_list",
    """
    SELECT p_partkey AS id, '[(''' || split_part(p_name, ' ', 1) || ''',''' || split_part(p_name, ' ', 1) || '''),('''
           || split_part(p_name, ' ', 2) || ''',''' || split_part(p_name, ' ', 2) || '''),(''' || p_type || '（' || p_size
           || ''',''' || p_type || '（' || p_size || ''')]' AS options
    FROM part
    """,
)
def options(t: Tables) -> DataFrame:
    text = F.concat(F.lit("（ "), "p_name", F.lit("  ） "), "p_type", F.lit("（"), "p_size", F.lit("） "))
    return t.part.select(F.col("p_partkey").alias("id"), option_list(text).alias("options"))


@query(
    "prefix_copy",
    """
    SELECT s_name AS name, 'target' AS type FROM supplier
    UNION ALL SELECT 'waf_' || c_name, 'source' FROM customer WHERE c_mktsegment = 'BUILDING'
    """,
)
def prefix_copy(t: Tables) -> DataFrame:
    name = F.concat(F.when(F.col("c_mktsegment") == "BUILDING", "waf_").otherwise("wafx_"), "c_name")
    catalog = t.customer.select(name.alias("name"), F.lit("source").alias("type"))
    return md.copy_catalog(catalog, t.supplier.select(F.col("s_name").alias("name"), F.lit("target").alias("type")))
