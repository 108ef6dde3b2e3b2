"""Documents. Conversations give paragraphs, orders give letters, line items give cells and images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import documents as doc
from tidewatch.plans.registry import Tables, query


@query(
    "doc_join",
    r"""
    SELECT conv_id AS doc_id, string_agg(text, chr(10) ORDER BY turn) || chr(10) AS text
    FROM (SELECT conv_id, turn, CASE WHEN role = 'user' AND turn > 1 THEN chr(9) || '　' ELSE text END AS text FROM conversations)
    WHERE text <> chr(9) || '　' AND NOT regexp_full_match(text, '\s*') GROUP BY 1
    """,
)
def doc_join(t: Tables) -> DataFrame:
    """Later user turns are blanked, with a tab and a full-width blank."""
    blank = (F.col("role") == "user") & (F.col("turn") > 1)
    paras = t.conversations.select(
        F.col("conv_id").alias("doc_id"),
        F.col("turn").alias("pos"),
        F.when(blank, "\t　").otherwise(F.col("text")).alias("text"),
    )
    return doc.document_text(paras)


def letter_paras(t: Tables) -> DataFrame:
    """Paragraphs of one letter per order; letters of status P lack the price line."""

    def text(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    lines = F.array(
        F.lit("估价结果报告"),
        text("客户", F.col("o_custkey").cast("string"), "（先生/女士）:"),
        F.lit("  "),
        text("受您委托，对位于南江路", F.col("o_orderkey").cast("string"), "号的住宅价值作初步估价。"),
        text("建筑面积", F.format_string("%.2f", F.col("o_custkey") * 0.25 + 10), "平方米。"),
        text("在价值时点", F.date_format("o_orderdate", "yyyy年M月d日"), "的抵押评估价值为：总价若干。"),
        F.when(F.col("o_orderstatus") != "P", text("单价：", F.format_number(F.col("o_orderkey") * 7, 0), "元/平方米")).otherwise("单价：无"),
    )
    rows = t.orders.select(F.col("o_orderkey").alias("doc_id"), F.posexplode(lines).alias("pos", "text"))
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


_LETTERS = """
    f AS (SELECT o_orderkey AS doc_id, '南江路' || o_orderkey || '号' AS x_name, '客户' || o_custkey AS x_zzjl_qsr,
                 '住宅' AS x_md, o_custkey * 0.25::DOUBLE + 10 AS x_jzmj, strftime(o_orderdate, '%Y-%m-%d') AS x_cp_date,
                 (o_orderkey * 7)::VARCHAR AS x_cp_dj
          FROM orders WHERE o_orderstatus <> 'P')
"""


@query("doc_extract", f"WITH {_LETTERS} SELECT * FROM f")
def doc_extract(t: Tables) -> DataFrame:
    return doc.appraisal_fields(doc.document_text(letter_paras(t)))


@query("doc_rejects", "SELECT o_orderkey AS doc_id FROM orders WHERE o_orderstatus = 'P'")
def doc_rejects(t: Tables) -> DataFrame:
    return doc.appraisal_rejects(doc.document_text(letter_paras(t))).select("doc_id")


def cells(t: Tables) -> DataFrame:
    """Line number and status choose one of the 14 cells; returned items lie in a second table."""
    places = sorted([doc.SPLIT_CELL, *doc.CELLS])
    number = F.col("l_linenumber") - 1 + F.when(F.col("l_linestatus") == "F", 7).otherwise(0)
    at = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in places])[number]
    mark = F.when(F.col("l_returnflag") == "N", "构").otherwise("")
    return t.lineitem.select(
        F.col("l_orderkey").alias("doc_id"),
        F.when(F.col("l_tax") > 0.06, 1).otherwise(0).alias("table_no"),
        at["r"].alias("r"),
        at["c"].alias("c"),
        F.concat(F.lit("P"), "l_partkey", mark, F.lit("S"), "l_suppkey").alias("text"),
    )


def _cell_sql() -> str:
    names = [
        "split", "x_wykg_slss", "x_wykg_syzk", "x_wykg_hx", "x_wykg_cx", "x_wykg_hjjg", "x_wykg_bxll", "x_wykg_ll",
        "x_wykg_tfcg", "x_wykg_zxqk", "x_zzjl_bh", "x_zzjl_qsly", "x_zzjl_tdcrjqk", "x_ptss_desc",
    ]
    return ", ".join(f"max(CASE WHEN k = {i} THEN text END) AS {n}" for i, n in enumerate(names))


_CELLS = f"""
    c AS (SELECT l_orderkey AS doc_id, l_linenumber - 1 + CASE l_linestatus WHEN 'F' THEN 7 ELSE 0 END AS k,
                 'P' || l_partkey || CASE l_returnflag WHEN 'N' THEN '构' ELSE '' END || 'S' || l_suppkey AS text
          FROM lineitem WHERE l_tax <= 0.06),
    w AS (SELECT doc_id, {_cell_sql()} FROM c GROUP BY 1),
    tf AS (SELECT * EXCLUDE (split), left(split, instr(split, '构')) AS x_wykg_jg,
                  substr(split, instr(split, '构') + 1) AS x_wykg_zcs FROM w)
"""


@query("cells_pivot", f"WITH {_CELLS} SELECT * FROM tf")
def cells_pivot(t: Tables) -> DataFrame:
    return doc.table_fields(cells(t))


def images(t: Tables) -> DataFrame:
    """Positions 0 to 12; contents are longer than one base64 line."""
    body = F.concat(F.lit("image "), F.repeat(F.concat("l_partkey", F.lit("-")), 20))
    return t.lineitem.select(
        F.col("l_orderkey").alias("doc_id"),
        (F.col("l_linenumber") - 1 + F.when(F.col("l_linestatus") == "F", 6).otherwise(0)).alias("pos"),
        F.encode(body, "UTF-8").alias("content"),
    )


_SLOTS = {i: n for i, n in enumerate(doc.IMAGE_FIELDS) if n}
_IMAGES = f"""
    i AS (SELECT l_orderkey AS doc_id, l_linenumber - 1 + CASE l_linestatus WHEN 'F' THEN 6 ELSE 0 END AS pos,
                 encode('image ' || repeat(l_partkey || '-', 20)) AS content FROM lineitem),
    im AS (SELECT doc_id, {", ".join(f"to_base64(max(CASE WHEN pos = {i} THEN content END)) AS {n}" for i, n in _SLOTS.items())}
           FROM i WHERE pos <= 10 GROUP BY 1)
"""


@query("image_slots", f"WITH {_IMAGES} SELECT * FROM im")
def image_slots(t: Tables) -> DataFrame:
    return doc.image_fields(images(t))


@query("image_rejects", f"WITH {_IMAGES} SELECT doc_id, pos FROM i WHERE pos > 10")
def image_rejects(t: Tables) -> DataFrame:
    return doc.image_rejects(images(t)).select("doc_id", "pos")


RECORDS_SQL = f"WITH {_LETTERS}, {_CELLS}, {_IMAGES} SELECT * FROM f LEFT JOIN tf USING (doc_id) LEFT JOIN im USING (doc_id)"


@query("doc_records", RECORDS_SQL)
def doc_records(t: Tables) -> DataFrame:
    return doc.document_records(letter_paras(t), cells(t), images(t))
