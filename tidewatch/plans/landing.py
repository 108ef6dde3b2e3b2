"""Files and tables that are written and read back, and whole load jobs."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import flows
from tidewatch.functions.net import long_to_ip
from tidewatch.operators import vmstats as vm
from tidewatch.operators.coerce import coerce_by_suffix, rename_headers
from tidewatch.operators.firewall import POLICY_COLUMNS, POLICY_HEADERS, policy_table
from tidewatch.plans.ingest import ntz
from tidewatch.plans.network import FLAT_SQL, policy_lines
from tidewatch.plans.papers import RECORDS_SQL, cells, images, letter_paras
from tidewatch.plans.registry import Tables, query
from tidewatch.session import work_path
from tidewatch.sources import landed, sinks


@query(
    "flow_files",
    """
    SELECT l_orderkey::VARCHAR AS dev, l_partkey * 1000 AS upcount,
           CASE WHEN l_linenumber % 2 = 0 THEN l_shipdate - INTERVAL 8 HOUR END AS starttime,
           CASE WHEN l_linenumber % 2 = 1 THEN 'n' || l_linenumber END AS extra
    FROM lineitem
    """,
)
def flow_files(t: Tables) -> DataFrame:
    """Two layouts in one folder: other order, missing columns, and one that nobody declared."""
    path = work_path(t.spark, "flows")
    t.spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    rows = t.lineitem.select(
        F.col("l_linenumber").alias("n"),
        F.col("l_orderkey").alias("设备编号"),
        long_to_ip(F.col("l_suppkey") + 16777216).alias("源地址"),
        F.format_number(F.col("l_partkey") * 1000, 0).alias("上行流量"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("起始时间"),
        F.concat(F.lit("n"), "l_linenumber").alias("新列"),
    )
    for odd, columns in ((1, ("上行流量", "新列", "设备编号", "源地址")), (0, ("设备编号", "起始时间", "上行流量"))):
        part = rows.where(F.col("n") % 2 == odd).select(*columns)
        part.write.mode("append").options(header=True, sep="\t", encoding="GBK").csv(path)
    typed = coerce_by_suffix(rename_headers(landed.read_flow_files(t.spark, path)), exclude=("_file",))
    return typed.select("dev", "upcount", ntz("starttime").alias("starttime"), F.col("新列").alias("extra"))


def _policy_folder(t: Tables) -> str:
    path = work_path(t.spark, "policies")
    lines = policy_lines(t).repartitionByRange("file", "line_no").sortWithinPartitions("file", "line_no")
    lines.select("file", F.col("line").alias("value")).write.partitionBy("file").text(path)
    return path


@query("policy_files", FLAT_SQL)
def policy_files(t: Tables) -> DataFrame:
    """The policy lines as text files, each in as many parts as tasks write it, read back by line number."""
    return policy_table(landed.read_lines(t.spark, _policy_folder(t), "file=(fw[0-9]+)/"))


@query(
    "policy_sheet",
    f"""SELECT {", ".join(f'{c} AS "{POLICY_HEADERS.get(c, c)}"' for c in POLICY_COLUMNS)}
        FROM (SELECT * REPLACE ({", ".join(f"nullif({c}, '') AS {c}" for c in POLICY_COLUMNS)}) FROM ({FLAT_SQL}))""",
)
def policy_sheet(t: Tables) -> DataFrame:
    """The flat policies as the ten-column sheet. CSV knows no difference between an empty and a missing field: both are read as null.

    Packed files are read whole anyway, and as a stream (`multiLine`) they need no text of each line.
    """
    path = work_path(t.spark, "sheet")
    sinks.write_policy_sheet(policy_table(policy_lines(t)), path, "gzip")
    return t.spark.read.options(header=True, nullValue="", multiLine=True).csv(path)


@query("json_lines", "SELECT event_id, event_type, value, user_id FROM events")
def json_lines(t: Tables) -> DataFrame:
    path = work_path(t.spark, "lines")
    t.events.select("event_id", "event_type", "value", "user_id", "props").write.json(path)
    return landed.read_json_lines(t.spark, path, "event_id bigint, event_type string, value double, user_id bigint")


@query(
    "job_table",
    """
    SELECT 'http://h' || c_nationkey || '/purl?day=dstr' AS httpurl, lower(c_name) AS tblname, 'list/' || c_custkey AS purl FROM customer
    """,
)
def job_table(t: Tables) -> DataFrame:
    path = work_path(t.spark, "jobs")
    jobs = t.customer.select(
        F.concat(F.lit("http://h"), "c_nationkey", F.lit("/purl?day=dstr")).alias("httpurl"),
        F.lower("c_name").alias("tblname"),
        F.concat(F.lit("list/"), "c_custkey").alias("purl"),
        "c_mktsegment",
    )
    jobs.write.parquet(f"{path}/etl_jobs")
    return landed.read_table(t.spark, "etl_jobs", path)


@query(
    "index_table",
    """
    SELECT 'orders' AS tbl, strftime(o_orderdate, '%Y.%m') AS month, strftime(o_orderdate, '%Y-%m-01') AS day,
           o_orderkey, date_trunc('month', o_orderdate)::TIMESTAMP - INTERVAL 8 HOUR AS eventdate
    FROM orders
    """,
)
def index_table(t: Tables) -> DataFrame:
    """Orders by the first day of their month: half-loaded Januaries, the rest as one batch written twice, and a repair of the Januaries."""
    path = work_path(t.spark, "index")
    orders = t.orders.select("o_orderkey", F.trunc("o_orderdate", "month").alias("first"))
    rows = sinks.with_partitions(orders, F.lit("orders"), F.col("first")).drop("first")
    early = F.col("month").endswith(".01")
    sinks.write_index(rows.where(early & (F.col("o_orderkey") % 2 == 0)), path)
    for _ in range(2):
        sinks.write_index(rows.where(~early), path, batch="rest")
    sinks.write_index(rows.where(early), path, replace_days=True)
    out = sinks.read_index(t.spark, path)
    return out.select("tbl", "month", "day", "o_orderkey", ntz("eventdate").alias("eventdate"))


@query("external_sink", "SELECT c_custkey, c_name, true AS bounded FROM customer")
def external_sink(t: Tables) -> DataFrame:
    """Customers handed to a sink in slices of 500, one file a slice, and read back."""
    path = work_path(t.spark, "sent")
    store, base = pafs.FileSystem.from_uri("file://" + path.removeprefix("file:").replace("//", "/"))
    store.create_dir(base)

    def send(rows: list) -> None:
        import json

        with store.open_output_stream(f"{base}/{uuid.uuid4().hex}.json") as out:
            out.write("".join(json.dumps(r.asDict()) + "\n" for r in rows).encode())

    sinks.send_documents(t.customer.select("c_custkey", "c_name"), send, size=500)
    sent = t.spark.read.schema("c_custkey bigint, c_name string").json(path).withColumn("_file", F.col("_metadata.file_path"))
    sizes = sent.groupBy("_file").agg((F.count(F.lit(1)) <= 500).alias("bounded"))
    return sent.join(sizes, "_file").select("c_custkey", "c_name", "bounded")


@query("record_table", f"SELECT * FROM ({RECORDS_SQL}) UNION ALL SELECT * FROM ({RECORDS_SQL})")
def record_table(t: Tables) -> DataFrame:
    """The document job run twice: records are appended."""
    path = work_path(t.spark, "records")
    for _ in range(2):
        flows.load_documents(letter_paras(t), cells(t), images(t), path)
    return t.spark.read.parquet(path)


@query(
    "load_answers",
    """
    SELECT event_id::VARCHAR AS id, event_id * 1000 AS hit_count, CASE WHEN event_type = 'click' THEN user_id END AS click_port,
           CASE WHEN event_type = 'view' THEN 'seen' END AS "viewNote", date_trunc('second', ts) - INTERVAL 8 HOUR AS seen_time,
           CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END AS day,
           CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y.%m') END AS month, (props->>'$.k')::BIGINT AS k
    FROM events
    """,
)
def load_answers(t: Tables) -> DataFrame:
    """Answers whose rows have keys of their own, some nested, some without a day. Even days are loaded first; two later loads, of all
    days, skip them and each other's rows."""
    path = work_path(t.spark, "answers")
    kind = F.col("event_type")
    day = F.date_format("ts", "yyyy-MM-dd")
    row = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.format_number(F.col("event_id") * 1000, 0).alias("hit_count"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("seen_time"),
        F.when(kind != "error", day).when(F.col("event_id") % 2 == 0, "someday").alias("day"),
        F.when(kind == "click", F.col("user_id")).alias("click_port"),
        F.when(kind == "view", "seen").alias("viewNote"),
        F.parse_json("props").alias("props"),
    )
    answers = t.events.select("ts", F.to_json(F.struct(F.lit("1").alias("rowCount"), F.array(row).alias("result"))).alias("value"))
    flows.load_answers(answers.where(F.day("ts") % 2 == 0).select("value"), path, "access", "day")
    for _ in range(2):
        flows.load_answers(answers.select("value"), path, "access", "day")
    out = sinks.read_index(t.spark, path, "access")
    nested = F.variant_get("props_nested", "$.k", "bigint").alias("k")
    return out.select("id", "hit_count", "click_port", "viewNote", ntz("seen_time").alias("seen_time"), "day", "month", nested)


_END = "1998-12-01"


@query(
    "vm_report_top",
    f"""
    WITH w AS (SELECT l_suppkey AS vm_id, epoch(l_shipdate)::BIGINT // 604800 AS step, max(l_discount) AS cpu, max(l_extendedprice) AS diskread,
                      max(l_quantity * 4096) AS diskwrite, max(l_tax * 1024) AS netin,
                      max(CASE WHEN l_returnflag <> 'N' THEN l_extendedprice * 3000000 END) AS netout
               FROM lineitem WHERE epoch(l_shipdate) >= epoch(TIMESTAMP '{_END}') - {vm.SPANS["year"]} GROUP BY 1, 2),
    v AS ({" UNION ALL ".join(f"SELECT vm_id, '{i}' AS item, {i} AS value FROM w" for i in vm.ITEMS)}),
    g AS (SELECT vm_id, item, count(*) AS n, max(value) FILTER (WHERE value <= {vm.TOO_LARGE}) AS m FROM v GROUP BY 1, 2),
    r AS (SELECT vm_id, item, CASE WHEN n = 1 THEN -1 ELSE coalesce(m, 0) END AS max, s_name AS name, 'NODE' || s_nationkey AS node,
                 row_number() OVER (PARTITION BY item ORDER BY CASE WHEN n = 1 THEN -1 ELSE coalesce(m, 0) END DESC, s_name, vm_id) - 1 AS pos
          FROM g JOIN supplier ON s_suppkey = vm_id)
    SELECT item, pos, vm_id, name, node, max FROM r WHERE pos < 8
    """,
)
def vm_report_top(t: Tables) -> DataFrame:
    """The whole report over a year's maxima per week."""
    vms = t.supplier.select(
        F.col("s_suppkey").alias("vm_id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("NODE"), "s_nationkey").alias("node"),
        F.lit("qemu").alias("type"),
        F.lit("running").alias("status"),
    )
    none = F.lit(None).cast("string")
    volumes = vms.select("vm_id", F.lit("scsi0").alias("key"), none.alias("value"))
    config = vms.select("vm_id", none.alias("smbios1"))
    samples = t.lineitem.select(
        F.col("l_suppkey").alias("vm_id"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("time"),
        F.col("l_discount").alias("cpu"),
        F.col("l_extendedprice").alias("diskread"),
        (F.col("l_quantity") * 4096).alias("diskwrite"),
        (F.col("l_tax") * 1024).alias("netin"),
        F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice") * 3000000).alias("netout"),
    )
    report = flows.vm_report(vms, volumes, config, samples, F.lit(_END), timeframe="year", aggregation="MAX")
    return report.top.select("item", "pos", "vm_id", "name", "node", "max")
