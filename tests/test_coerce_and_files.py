from __future__ import annotations

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from tidewatch.operators import coerce as co
from tidewatch.operators.firewall import POLICY_COLUMNS
from tidewatch.sources import landed, sinks


def test_column_kinds():
    kinds = {c: co.column_kind(c) for c in ("hitCount", "napport", "runtime", "sip", "SIP", "account", "user")}
    assert kinds == {
        "hitCount": "count", "napport": "count", "runtime": "time", "sip": "ip", "SIP": None, "account": "count", "user": None,
    }


def test_coerce_keeps_bad_rows(spark):
    df = spark.createDataFrame(
        [("1,024", "20190110", "a", 5), ("x", "2019-1-1", "b", 6), (None, None, "c", None)],
        "upcount string, StartTime string, user string, dport int",
    )
    out = co.coerce_by_suffix(df)
    assert dict(out.dtypes)["dport"] == "bigint" and dict(out.dtypes)["StartTime"] == "timestamp_ntz"
    good, bad = co.split_rejects(out)
    assert rows(good, "upcount", "user") == [(None, "c"), (1024, "a")]
    assert [(r["user"], r["_errors"]) for r in bad.collect()] == [("b", ["upcount", "StartTime"])]
    assert dict(co.coerce_by_suffix(df, exclude=["upcount"]).dtypes)["upcount"] == "string"


def test_strict_raises(spark):
    df = spark.createDataFrame([("x",)], "a_count string")
    with pytest.raises(Exception, match="unreadable a_count"):
        co.coerce_by_suffix(df, strict=True).collect()
    fine = co.coerce_by_suffix(spark.createDataFrame([("2019-01-10",)], "a_time string"), strict=True)
    assert fine.first()[0] == dt.datetime(2019, 1, 9, 16)


def test_typed_time_columns_are_shifted(spark):
    df = spark.createDataFrame([(dt.datetime(2019, 1, 1, 3),)], "a_time timestamp_ntz")
    assert co.coerce_by_suffix(df).first()["a_time"] == dt.datetime(2018, 12, 31, 19)


def test_index_name_uses_the_local_month(spark):
    df = spark.createDataFrame([(dt.date(2019, 2, 1), "log")], "day date, t string")
    day, t = F.col("day"), F.col("t")
    out = co.stamp_eventdate(df, day).select(co.index_name(day, t), co.index_name(day, prefix="wjapt"), "eventdate").first()
    assert tuple(out) == ("waf_log-2019.02", "wjapt-2019.02", dt.datetime(2019, 1, 31, 16))


def test_flow_files_in_gbk(spark, tmp_path):
    head = "\t".join(co.FLOW_NAMES)
    line = "\t".join(["d1", "网页", "2019-01-10 01:02:03", "20190110", "1.2.3.4", "1,024", "0.0.0.0", "80", "中文.cn",
                      "1,000", "2", "电信", "中山", "::1", "7", "用户"])
    (tmp_path / "a.txt").write_bytes(f"{head}\n{line}\n".encode("gbk"))
    (tmp_path / "b.dat").write_bytes(f"{head}\n{line}\n{line}\n".encode("gbk"))
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.txt").write_bytes(f"{head}\n{line}\n".encode("gbk"))
    raw = landed.read_flow_files(spark, str(tmp_path))
    out = co.coerce_by_suffix(co.rename_headers(raw)).collect()
    assert len(out) == 3 and {r["_file"].rsplit("/", 1)[1] for r in out} == {"a.txt", "b.dat"}
    r = out[0]
    assert (r["xyname"], r["sport"], r["upcount"], r["napport"], r["user"], r["_errors"]) == ("网页", 1024, 1000, 7, "用户", [])


def test_answer_pages(spark, tmp_path):
    pages = {
        "p1.json": '{"rowCount": "1001", "result": [{"site": "a", "sitecount": "1,000"}, {"site": "b"}]}',
        "p2.json": '{"rowCount": "0", "result": []}',
        "p3.json": '{"rowCount": "5"}',
        "p4.json": '{"rowCount": "5", "result": [{"site": "c"}',
        "p5.json": '{\n "rowCount": "1",\n "result": [\n {"site": "d", "sitecount": 3}]}',
    }
    for name, body in pages.items():
        (tmp_path / name).write_text(body)
    out = landed.read_answer_files(spark, str(tmp_path), "struct<site string, sitecount string>")
    assert rows(out) == [("a", "1,000"), ("b", None), ("d", "3")]
    counts = spark.createDataFrame([(b,) for b in pages.values()], "t string").select(landed.row_count(F.col("t")))
    assert [r[0] for r in counts.collect()][:3] == [1001, 0, 5]


def test_day_answers_prune_to_one_day(spark, tmp_path):
    for day, site in (("2019-01-01", "a"), ("2019-01-02", "b")):
        folder = tmp_path / f"eventdate={day}"
        folder.mkdir()
        (folder / "x.json").write_text('{"list": [{"port": "1,000", "site": "%s"}]}\n{"detail": {"qstate": 2}}\n' % site)
    schema = "struct<port string, site string>"
    assert rows(landed.read_day_answers(spark, str(tmp_path), schema), "site") == [("a",), ("b",)]
    one = landed.read_day_answers(spark, str(tmp_path), schema, "2019-01-02")
    assert rows(one, "site") == [("b",)]
    assert "PartitionFilters: [isnotnull(eventdate" in one._jdf.queryExecution().executedPlan().toString()


def test_files_are_bound_by_header_names(spark, tmp_path):
    layouts = {
        "a.txt": "源地址\t设备编号\t上行流量\t新列\n1.1.1.1\tdev1\t5\tmore\n1.1.1.2\tdev2\t\t\n",
        "b.txt": "设备编号\t起始时间\ndev3\t2019-01-10\n",
        "c.txt": "源地址\t设备编号\t上行流量\t新列\r\n1.1.1.3\tdev4\t1,000\tx\r\n",
        "d.txt": "",
        "e f.txt": "设备编号\t设备编号\nfirst\tsecond\n",
    }
    for name, text in layouts.items():
        (tmp_path / name).write_bytes(text.encode("gbk"))
    got = co.rename_headers(landed.read_flow_files(spark, str(tmp_path)))
    assert got.columns == [*co.FLOW_NAMES.values(), "新列", "_file"]
    assert rows(got, "dev", "sip", "upcount", "starttime", "新列") == sorted(
        [("dev1", "1.1.1.1", "5", None, "more"), ("dev2", "1.1.1.2", None, None, None), ("dev3", None, None, "2019-01-10", None),
         ("dev4", "1.1.1.3", "1,000", None, "x"), ("first", None, None, None, None)], key=lambda t: tuple((x is not None, str(x)) for x in t))
    (tmp_path / "sheet").mkdir()
    (tmp_path / "sheet" / "s.csv").write_text("name,extra,row_idx\na,z,2\n,y,x\n")
    assert rows(landed.read_sheet(spark, str(tmp_path / "sheet"), "keep_names")) == [(None, None), (2, "a")]


def test_numbers_that_are_no_counts_are_kept_as_errors(spark):
    data = [(1.0, 1), (float("nan"), 2), (1e30, 3), (None, 4), (float("inf"), 5)]
    got = co.coerce_by_suffix(spark.createDataFrame(data, "hit_count double, id int"))
    assert rows(got, "id", "hit_count", "_errors") == [
        (1, 1, []), (2, None, ["hit_count"]), (3, None, ["hit_count"]), (4, None, []), (5, None, ["hit_count"]),
    ]


def test_all_keys_of_answers(spark):
    answers = spark.createDataFrame(
        [('{"result": [{"a": "1", "X": 2}, {"b": {"c": [1]}, "x": "3"}]}',), ('{"result": [{}]}',), ("broken",), ('{"result": [{"a": null}]}',)], "value string"
    )
    found = landed.envelope_variants(answers, "value")
    keys = landed.row_keys(found)
    assert keys == [landed.RowKey(("X", "x")), landed.RowKey(("a",)), landed.RowKey(("b",), False, True)]
    wide = landed.spread_keys(found, keys)
    assert rows(wide.select("X", "a", F.to_json("b_nested"))) == [(None, None, None), (None, None, None), ("2", "1", None), ("3", None, '{"c":[1]}')]
    assert wide.select(F.variant_get("b_nested", "$.c[0]", "int").alias("c")).where("c = 1").count() == 1
    again = landed.envelope_variants(answers.orderBy("value"), "value")
    assert rows(found, "_row_id") == rows(again, "_row_id") and found.select("_row_id").distinct().count() == 4


def test_keys_that_are_plain_here_and_nested_there(spark):
    texts = ["{result: [{'k': 1.5, 'K_nested': 'x'}, {k: [1, {'y': null}]}, {'K': 'up', 'k.d': true, 'q`': 1}, 5, {'k': null}]}", '{"result": [{"a": 1, "a": 2}]}']
    found = landed.envelope_variants(spark.createDataFrame([(t,) for t in texts], "value string"), "value")
    wide = landed.spread_keys(found, landed.row_keys(found))
    assert wide.columns == ["_row_id", "K", "K_nested_", "K_nested", "k.d", "q`"]
    picked = wide.select("K", F.to_json("K_nested_").alias("n"), "K_nested", F.col("`k.d`").alias("d"), F.col("`q```").alias("q"))
    assert rows(picked) == sorted([("1.5", None, "x", None, None), (None, '[1,{"y":null}]', None, None, None), ("up", None, None, "true", "1"),
                                   (None,) * 5, (None,) * 5], key=lambda t: tuple((x is not None, str(x)) for x in t))


def test_work_grows_with_keys_not_with_their_square(spark):
    def seconds(n):
        texts = spark.range(3000).select(F.to_json(F.struct(F.array(F.struct(*[F.concat(F.lit("v"), "id").alias(f"k{i}") for i in range(n)])).alias("result"))).alias("value"))
        texts = texts.repartition(4).checkpoint()
        began = time.perf_counter()
        found = landed.envelope_variants(texts, "value")
        wide = landed.spread_keys(found, landed.row_keys(found))
        assert len(wide.columns) == n + 1
        wide.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds(30)
    assert seconds(300) < 40 * max(seconds(30), 0.2)


def test_line_numbers_do_not_depend_on_splits(spark, tmp_path):
    for name, n in (("a.txt", 4000), ("b.txt", 10)):
        (tmp_path / name).write_text("".join(f"line {i}\n" for i in range(n)))
    key, old = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set(key, "4096")
        built = landed.read_lines(spark, str(tmp_path))
        spark.conf.set(key, "900")
        other = landed.read_lines(spark, str(tmp_path))
        results = [rows(df.withColumn("file", F.substring_index("file", "/", -1)), "file", "line_no", "line") for df in (built, other)]
    finally:
        spark.conf.set(key, old)
    assert results[0] == results[1]
    assert sorted(results[0]) == sorted([(f, i, f"line {i}") for f, n in (("a.txt", 4000), ("b.txt", 10)) for i in range(n)])


def test_line_numbers_grow_across_splits(spark, tmp_path):
    for name, n in (("a.txt", 4000), ("b.txt", 10)):
        (tmp_path / name).write_text("".join(f"line {i}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = landed.read_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for name, n in (("a.txt", 4000), ("b.txt", 10)):
        mine = sorted((r["line_no"], r["line"]) for r in got if r["file"].endswith(name))
        assert [line for _, line in mine] == [f"line {i}" for i in range(n)]
        assert len({no for no, _ in mine}) == n


def test_tables_and_sheets(spark, tmp_path):
    spark.createDataFrame([(1, 5)], landed.SCHEMAS["proxy_history"]).write.parquet(f"{tmp_path}/proxy_history")
    assert rows(landed.read_table(spark, "proxy_history", str(tmp_path))) == [(1, 5)]
    (tmp_path / "sheet.csv").write_text("row_idx,name\n2,a\n3,\n4,c\n")
    assert rows(landed.read_sheet(spark, str(tmp_path / "sheet.csv"), "keep_names")) == [(2, "a"), (3, None), (4, "c")]


def test_jdbc_options(spark):
    """The options alone: no database may run here."""

    class Reader:
        seen: dict = {}

        def format(self, name):
            self.seen["format"] = name
            return self

        def options(self, **given):
            self.seen.update(given)
            return self

        def load(self):
            return spark.createDataFrame([(1, 2, "more")], "id bigint, clock bigint, other string")

    fake = type("Session", (), {"read": Reader()})()
    got = landed.read_table(fake, "proxy_history", jdbc={"url": "jdbc:x", "user": "u"})
    assert rows(got) == [(1, 2)] and got.columns == ["id", "clock"]
    assert Reader.seen == {"format": "jdbc", "dbtable": "proxy_history", "url": "jdbc:x", "user": "u"}


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1}\n{"a": 2}\n')
    assert rows(landed.read_json_lines(spark, str(tmp_path), "a int")) == [(1,), (2,)]


def test_index_append_and_day_repair(spark, tmp_path):
    path = str(tmp_path / "idx")

    def day(d, *vs):
        df = spark.createDataFrame([(v, d) for v in vs], "v int, d date")
        return sinks.with_partitions(df, F.lit("log"), F.col("d")).drop("d")

    sinks.write_index(day(dt.date(2019, 1, 31), 1, 2), path)
    sinks.write_index(day(dt.date(2019, 2, 1), 3), path)
    sinks.write_index(day(dt.date(2019, 10, 31), 7), path, batch="b")
    sinks.write_index(day(dt.date(2019, 10, 31), 8), path, batch="b")
    assert rows(sinks.read_index(spark, path), "v") == [(1,), (2,), (3,), (8,)]
    sinks.write_index(day(dt.date(2019, 1, 31), 1, 2, 9), path, replace_days=True)
    out = sinks.read_index(spark, path, "log")
    assert rows(out, "v") == [(1,), (2,), (3,), (8,), (9,)] and sinks.read_index(spark, path, "other").count() == 0
    assert rows(out.select("tbl", "month", "day").distinct()) == [
        ("log", "2019.01", "2019-01-31"), ("log", "2019.02", "2019-02-01"), ("log", "2019.10", "2019-10-31"),
    ]


def test_external_sink_gets_slices(spark, tmp_path):
    target = str(tmp_path)

    def send(docs):
        import os
        import uuid

        with open(os.path.join(target, uuid.uuid4().hex), "w") as f:
            f.write(",".join(str(d["id"]) for d in docs))

    sinks.send_documents(spark.range(0, 25, 1, 2), send, size=10)
    parts = [p.read_text().split(",") for p in tmp_path.iterdir()]
    assert sorted(int(i) for p in parts for i in p) == list(range(25)) and max(map(len, parts)) == 10


def test_policy_sheet_and_change_text_files(spark, tmp_path):
    df = spark.createDataFrame([("f", *[f"c{i}" for i in range(10)])], "file string, " + ", ".join(f"{c} string" for c in POLICY_COLUMNS))
    sinks.write_policy_sheet(df, str(tmp_path / "p"))
    text = [line for p in (tmp_path / "p").glob("*.csv") for line in p.read_text().splitlines()]
    assert set(text) == {",".join([*POLICY_COLUMNS[:8], "rule启用状态", "策略"]), ",".join(f"c{i}" for i in range(10))}
    changes = spark.createDataFrame([(2, "b"), (1, "a")], "row_idx int, t string")
    sinks.write_changes(changes, F.col("t"), str(tmp_path / "c"))
    assert rows(spark.read.text(str(tmp_path / "c"))) == [("a",), ("b",)]
    sinks.append_records(changes, str(tmp_path / "r"))
    sinks.append_records(changes, str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r")).count() == 4
