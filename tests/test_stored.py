from __future__ import annotations

import os
import shutil

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from tidewatch.operators.repair import apply_changes, host_alerts, host_events, retained
from tidewatch.operators.rollups import CASCADE, extend_rollups, roll_up, series
from tidewatch.operators.rpclog import recent_requests
from tidewatch.operators.vmstats import consolidate
from tidewatch.sources import daytable
from tidewatch.sources.keyed import store_monitoring
from tidewatch.streaming.history import follow, history

DAY = 86_400
CHANGES = "tbl string, action string, id long, new_clock long, name string, row_idx long, seq int"


def files(folder):
    return {(os.path.basename(d), f): os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_changes_write_only_the_days_they_touch(spark, tmp_path):
    path = str(tmp_path / "t")
    events = spark.createDataFrame([(i, i % 10 * DAY + i, f"r{i}") for i in range(60)] + [(100, None, "none"), (101, 20 * DAY, "alone")], "eventid long, clock long, note string")
    changes = spark.createDataFrame(
        [("events", "update", 3, 7 * DAY, "h", 1, 1), ("events", "delete", 13, None, "h", 1, None), ("events", "delete", 101, None, "h", 1, None), ("events", "update", 100, 30 * DAY, "h", 2, 1),
         ("alerts", "delete", 4, None, "h", 1, None), ("events", "update", 999, 50 * DAY, "h", 1, 1)], CHANGES)
    daytable.write_days(events, path)
    before = files(path)
    days = daytable.change_days(spark, path, events.schema, changes, "events", "eventid")
    assert days == ["1970-01-04", "1970-01-08", "1970-01-21", "1970-01-31", "__HIVE_DEFAULT_PARTITION__"]
    kept = {k: v for k, v in before.items() if k[0].removeprefix("day=") not in days}
    assert len(kept) == 8 and kept.items() <= files(path).items()
    assert "1970-01-21" not in daytable.stored_days(spark, path) and "1970-01-31" in daytable.stored_days(spark, path)
    got = daytable.read_days(spark, path, events.schema)
    assert rows(got.drop("day")) == rows(apply_changes(events, changes, "events", "eventid"))
    assert got.where(F.col("day") != F.date_format(F.timestamp_seconds("clock"), "yyyy-MM-dd")).count() == 0
    assert daytable.change_days(spark, path, events.schema, changes.where("id = 999"), "events", "eventid") == []


@pytest.mark.parametrize("end", [0, 1500, DAY, 3 * DAY + 7777, 3 * DAY, 30 * DAY])
def test_retention_drops_whole_days(spark, tmp_path, end):
    path = str(tmp_path / "t")
    table = spark.createDataFrame([(i, 500 + i * 7001) for i in range(60)] + [(900, None)], "id long, clock long")
    daytable.write_days(table, path)
    before = files(path)
    touched = daytable.drop_old_days(spark, path, table.schema, F.lit(end))
    assert rows(daytable.read_days(spark, path, table.schema).drop("day")) == rows(retained(table, F.lit(end)))
    kept = {k: v for k, v in before.items() if k[0].removeprefix("day=") not in touched}
    assert kept.items() <= files(path).items()
    assert daytable.drop_old_days(spark, str(tmp_path / "t"), table.schema, F.lit(0)) == []


def test_chain_over_stored_tables_shuffles_neither_large_side(spark, tmp_path):
    make = spark.createDataFrame
    tables = {
        "alerts": make([(i, i % 50) for i in range(400)], "alertid long, eventid long"),
        "events": make([(i, i % 5, 100 + i) for i in range(60)], "eventid long, objectid long, clock long"),
        "triggers": make([(i,) for i in range(4)], "triggerid long"),
        "functions": make([(i, i) for i in range(5)], "triggerid long, itemid long"),
        "items": make([(i, 0, "icmpping") for i in range(5)], "itemid long, hostid long, key_ string"),
        "hosts": make([(0, "h")], "hostid long, name string"),
    }
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    stored = store_monitoring(tables, str(tmp_path / "s"), 4)
    assert rows(host_alerts(stored, 100, 140)) == rows(host_alerts(tables, 100, 140))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        chain = host_alerts(stored, 100, 140, events=host_events(stored, 100, 140, measured=True))
        plan = chain._jdf.queryExecution().executedPlan().toString()
        assert rows(chain) == rows(host_alerts(tables, 100, 140))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert plan.count("Bucketed: true") == 2 and "SortMergeJoin [eventid" in plan
    assert "Exchange hashpartitioning(eventid" not in plan and "Exchange hashpartitioning(objectid" not in plan


@pytest.mark.parametrize("cf", ["AVERAGE", "MAX", "MEDIAN"])
def test_rollups_equal_one_pass_over_all_samples(spark, tmp_path, cf):
    path = str(tmp_path / "r")
    data = [(i % 3, 1_000_000 + i * 977, float(i * 37 % 101) if i % 7 else None, 1.0) for i in range(3000)]
    samples = spark.createDataFrame(data, "vm long, time long, cpu double, net double")
    for batch, low, high in (("a", 0, 2_000_000), ("b", 2_000_000, 9_000_000), ("b", 2_000_000, 9_000_000)):
        before = files(path)
        extend_rollups(samples.where((F.col("time") >= low) & (F.col("time") < high)), path, batch, ["vm"], "time", ["cpu", "net"])
        if batch == "b":
            assert {k: v for k, v in before.items() if k[0] == "batch=a"}.items() <= files(path).items()
    schema = roll_up(samples, ["vm"], "time", ["cpu", "net"], CASCADE[:1]).drop("step").schema
    for step in CASCADE:
        want = consolidate(samples.withColumn("ts", F.timestamp_seconds("time")), ["vm"], "ts", ["cpu", "net"], f"{step} seconds", cf)
        want = want.select("vm", F.unix_seconds("ts").alias("time"), F.round("cpu", 6).alias("cpu"), "net")
        got = series(spark, path, schema, ["vm"], ["cpu", "net"], step, cf).select("vm", "time", F.round("cpu", 6).alias("cpu"), "net")
        assert rows(got) == rows(want)
    with pytest.raises(ValueError):
        roll_up(samples, ["vm"], "time", ["cpu"], (60, 100))
    with pytest.raises(ValueError):
        series(spark, path, schema, ["vm"], ["cpu", "net"], 60, "MIN")


def test_all_steps_come_from_one_scan(spark, tmp_path):
    samples = spark.range(100).select((F.col("id") % 3).alias("vm"), F.col("id").alias("time"), F.rand(1).alias("cpu"))
    samples.write.parquet(str(tmp_path / "s"))
    read = []
    landed = spark.read.parquet(str(tmp_path / "s"))
    extend_rollups(landed.withColumn("cpu", F.col("cpu") + 0), str(tmp_path / "r"), "a", ["vm"], "time", ["cpu"])
    shutil.rmtree(tmp_path / "s")  # the kept rollups need the samples no more
    schema = roll_up(samples, ["vm"], "time", ["cpu"], CASCADE[:1]).drop("step").schema
    for step in CASCADE:
        read.append(series(spark, str(tmp_path / "r"), schema, ["vm"], ["cpu"], step).count())
    assert read == [6, 3, 3, 3, 3]


def test_latest_requests_of_a_stream(spark, tmp_path):
    landed, path, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    data = [(None if i % 5 == 4 else f"s{i % 3}", i * 7919 % 1009, i, f"q{i}") for i in range(400)] + [("hot", i // 3, i, "h") for i in range(500)]
    log = spark.createDataFrame(data, "server string, at long, tie long, request string")
    for load in range(3):
        log.where(F.pmod(F.xxhash64("tie"), F.lit(3)) == load).repartition(4).write.mode("append").parquet(landed)
        for _ in range(2):
            follow(spark.readStream.schema(log.schema).parquet(landed), path, state, n=7).awaitTermination()
    want = recent_requests(log, "server", "at", "tie", 7)
    assert rows(history(spark, path), "server", "at", "tie", "request", "age") == rows(want, "server", "at", "tie", "request", "age")
    assert history(spark, str(tmp_path / "none")).count() == 0
