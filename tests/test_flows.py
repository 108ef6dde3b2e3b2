from __future__ import annotations

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from tests.test_documents import paras
from tests.test_firewall import SMALL
from tests.test_repair import T1, T2, tables
from tidewatch import flows
from tidewatch.operators import coerce as co
from tidewatch.operators import vmstats
from tidewatch.sources import sinks
from tidewatch.sources.landed import SCHEMAS


def test_backfill_plan(spark):
    jobs = spark.createDataFrame([("h/purl?d=dstr&s=dstart&l=dlimit", "log", "acc/list")], SCHEMAS["etl_jobs"])
    target = spark.createDataFrame([("log", "2019-01-31"), ("other", "2019-02-01")], "tbl string, day string")
    days = flows.days_to_fetch(jobs, target, F.lit("2019-01-30"), F.lit("2019-02-02"))
    assert rows(days, "index", "probe_url") == [
        ("waf_log-2019.01", "h/acc/list?d=2019-01-30&s=0&l=1"), ("waf_log-2019.02", "h/acc/list?d=2019-02-01&s=0&l=1"),
    ]
    counted = days.withColumn("row_count", F.when(F.day("day") == 1, F.lit(2001)).otherwise(0))
    assert rows(flows.page_requests(counted), "url") == [
        (f"h/acc/list?d=2019-02-01&s={s}&l=1000",) for s in (0, 1000, 2000)
    ]


def test_flow_files_to_places(spark, tmp_path):
    line = ["d", "p", "2019-01-10 01:02:03", "20190110", "1.2.3.4", "1", "0.0.0.0", "80", "x", "1,000", "2", "o", "g", "1.2.3.9", "7", "u"]
    (tmp_path / "a.txt").write_bytes(("\t".join(co.FLOW_NAMES) + "\n" + "\t".join(line) + "\n").encode("gbk"))
    geo = spark.createDataFrame([(16909056, 16909063, 1.0, 2.0, "land", *[None] * 6)], SCHEMAS["geo_ranges"])
    got = flows.load_flows(spark, str(tmp_path), geo)
    assert rows(got, "sip_country_name", "dip_country_name", "natip_country_name", "sip_location.lat") == [("land", None, None, 2.0)]


def test_policies(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "fw.txt").write_text("\n".join(SMALL))
    flows.flatten_policies(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 5


def test_repair_and_purge(spark):
    sheet = spark.createDataFrame([(2, "c", None, T1, T2), (3, "", None, T1, T2), (4, "b", "删", T1, T2)], SCHEMAS["repair_sheet"])
    got = flows.repair_events(tables(spark), sheet, 100, 200, "update_all")
    assert {r["row_idx"] for r in got.collect()} == {2} and got.count() == 5
    names = spark.createDataFrame([(2, "c"), (3, None), (4, "d")], SCHEMAS["keep_names"])
    gone = flows.purge_events(tables(spark), names, 100, 200)
    assert rows(gone.groupBy("tbl", "name").count()) == [("alerts", "b", 1), ("alerts", "d", 2), ("events", "b", 1), ("events", "d", 4)]


def test_vm_report(spark):
    vms = [(1, "web-1", "n1", "qemu", "running"), (2, "web-2", "n1", "qemu", "paused"), (3, "web-3", "n2", "qemu", None),
           (4, "web-4", "n2", "qemu", "prelaunch"), (5, "db", "n1", "qemu", "running")]
    volumes = [(i, "scsi0", "ceph:x") for i in range(1, 6)]
    config = [(1, "uuid=0123abcd-0123-4567-89ab-0123456789ab"), (2, None)]
    now = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp())
    rrd = [(v, now - 60 * i, v * 0.1 + i * 0.01, 1024.0, 1.0, 1.0, 1.0) for v in (1, 2, 5) for i in range(10)]
    make = lambda name, data: spark.createDataFrame(data, SCHEMAS[name])

    def report(**how):
        return flows.vm_report(make("vms", vms), make("vm_volumes", volumes), make("vm_config", config), make("rrd", rrd),
                               F.lit("2024-01-01 00:00:00"), names=["web*"], storage="ceph*", **how)

    out = report()
    assert [r["line"] for r in out.top.filter("item = 'cpu'").orderBy("pos").collect()] == [
        "#0:     25 %      n1 (web-2)", "#1:     15 %      n1 (web-1)",
    ]
    assert rows(out.nodes_down, "node") == [("n2",)] and rows(out.warnings, "vm_id") == [(4,)]
    assert rows(out.bad_uuids, "name") == [("web-2",)] and out.shared_uuids.count() == 0 and out.repeated_names.count() == 0
    assert rows(out.ignored_header) == [(0, 2)] and out.ignored.count() == 0
    five = report(timeframe="5min", aggregation="MAX")
    assert rows(five.top.filter("item = 'cpu' and pos = 0"), "max", "n_samples") == [(0.25, 6)]
    day, year = report(timeframe="day", aggregation="AVERAGE"), report(timeframe="year", aggregation="MAX")
    assert rows(day.top.filter("item = 'cpu' and pos = 0"), "n_samples") != rows(out.top.filter("item = 'cpu' and pos = 0"), "n_samples")
    assert rows(year.top.filter("item = 'cpu' and pos = 0"), "single_row") == [(True,)]
    with pytest.raises(ValueError, match="timeframe"):
        report(timeframe="decade")
    with pytest.raises(ValueError, match="function"):
        vmstats.consolidate(make("rrd", rrd), ["vm_id"], "time", ["cpu"], cf="MIN")
    rrd = [r for r in rrd if r[0] == 1] + [(1, now - 1200, 0.5, 0x3FFFFFFFFF + 1.0, 1.0, 1.0, 1.0)]
    less = report()
    assert rows(less.warnings, "vm_id", "status") == [(2, "no samples"), (4, "prelaunch")]
    assert rows(less.ignored_header) == [(1, 2)] and rows(less.ignored_values, "name", "item") == [("web-1", "diskread")]


def test_load_skips_loaded_days(spark, tmp_path):
    path = str(tmp_path / "t")
    answers = spark.createDataFrame([('{"result": [{"site": "a", "hitcount": "1,0", "day": "2019-01-01"}, {"port": "7", "day": "2019-01-02"}]}',)], "value string")
    assert flows.load_answers(answers, path, "log", "day").count() == 2
    more = answers.unionByName(spark.createDataFrame([('{"result": [{"new": "x", "day": "2019-01-03"}]}',)], "value string"))
    assert flows.load_answers(more, path, "log", "day").count() == 1
    assert flows.load_answers(answers, path, "other", "day").count() == 2
    table = sinks.read_index(spark, path, "log")
    assert rows(table, "site", "hitcount", "port", "new", "day") == [
        (None, None, None, "x", "2019-01-03"), (None, None, 7, None, "2019-01-02"), ("a", 10, None, None, "2019-01-01"),
    ]


def test_rows_without_a_day_are_loaded_once(spark, tmp_path):
    path = str(tmp_path / "t")
    row = '{"site": "a", "day": "soon"}'
    texts = [f'{{"result": [{row}, {row}, {{"site": "b", "day": "2019-01-01"}}]}}', '{"result": [{"site": "c"}]}']
    answers = spark.createDataFrame([(x,) for x in texts], "value string")
    assert flows.load_answers(answers, path, "log", "day").count() == 4
    assert flows.load_answers(answers, path, "log", "day").count() == 0
    more = answers.unionByName(spark.createDataFrame([(f'{{"result": [{row}], "page": 2}}',)], "value string"))
    assert rows(flows.load_answers(more, path, "log", "day"), "site") == [("a",)]  # equal, but of another answer
    assert rows(sinks.read_index(spark, path, "log"), "site", "day") == [("a", None)] * 3 + [("b", "2019-01-01"), ("c", None)]
    assert flows.load_answers(answers, path, "other", "day").count() == 4


def test_loaded_days_are_found_without_reading_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    answers = spark.createDataFrame([('{"result": [{"site": "a", "day": "2019-01-01"}, {"site": "b", "day": "2019-01-02"}]}',)], "value string")
    flows.load_answers(answers, path, "log", "day")
    shutil.rmtree(tmp_path / "t" / "tbl=log" / "month=2019.01" / "day=2019-01-02")
    assert rows(flows.load_answers(answers, path, "log", "day"), "site") == [("b",)]


def test_host_sheet_and_documents(spark, tmp_path):
    (tmp_path / "s.csv").write_text("row_idx,status,cpu,mem,host,name,grp,nc_id,ip,pip\n2,running,1,2,h1,n,g,x,1.1.1.1,\n3,stopped,1,2,h2,n,g,x,,\n")
    hosts = spark.createDataFrame([("9", "h1", "n(1.1.1.1)(None)", None)], SCHEMAS["actual_hosts"])
    got = flows.reconcile_hosts(spark, str(tmp_path / "s.csv"), hosts, spark.createDataFrame([], SCHEMAS["actual_groups"]))
    assert rows(got, "action", "host", "value") == [("add_template", "h1", "10186"), ("create_group", None, "g")]
    path = str(tmp_path / "records")
    empty = spark.createDataFrame([], SCHEMAS["doc_cells"]), spark.createDataFrame([], SCHEMAS["doc_images"])
    for _ in range(2):
        assert rows(flows.load_documents(paras(spark), *empty, path)) == [(2,), (3,)]
    assert rows(spark.read.parquet(path), "doc_id") == [(1,), (1,)]
