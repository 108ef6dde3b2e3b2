from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from tidewatch.operators import vmstats as vm
from tidewatch.sources.landed import SCHEMAS


@pytest.fixture(scope="module")
def vms(spark):
    data = [(1, "web-1", "n1", "qemu", "running"), (2, "web-2", "n1", "qemu", None), (3, None, "n1", "qemu", None),
            (4, "db-1", "n2", "qemu", "stopped"), (5, "db-2", "n2", "lxc", "prelaunch"), (6, "db-2", "n2", "qemu", "paused"),
            (7, "x", "n3", "qemu", "internal-error")]
    return spark.createDataFrame(data, SCHEMAS["vms"])


def test_names_and_routes(vms):
    assert rows(vm.named(vms, []), "vm_id") == [(i,) for i in range(1, 8)]
    assert rows(vm.named(vms, ["web*", "?"]), "vm_id") == [(1,), (2,), (7,)]
    assert rows(vm.named(vms, ["*"]), "vm_id") == [(i,) for i in range(1, 8)]
    routed = vm.routed(vms)
    assert [r["route"] for r in routed.orderBy("vm_id").collect()] == ["keep", "node_down", "node_down", "drop", "warn", "keep", "warn"]
    assert rows(vm.nodes_down(routed)) == [("n1", 2, 2)]
    assert rows(vm.repeated_names(vms)) == [("db-2", 2)]


def test_strict_route(spark):
    odd = spark.createDataFrame([(1, "a", "n", "t", "suspended")], SCHEMAS["vms"])
    assert vm.routed(odd).first()["route"] == "unknown"
    with pytest.raises(Exception, match="unexpected status suspended"):
        vm.routed(odd, strict=True).collect()


def test_storage(spark, vms):
    data = [(1, "scsihw", "ceph:1"), (2, "scsi0", None), (4, "virtio1", "ceph:vm-4"), (4, "sata2", "ceph:vm-4b"), (5, "ide0", "local:1"), (6, "net0", "ceph:2")]
    volumes = spark.createDataFrame(data, SCHEMAS["vm_volumes"])
    assert rows(vm.with_storage(vms, volumes, "ceph:*"), "vm_id") == [(4,)]


def test_uuids(spark):
    u = "0123abcd-0123-4567-89ab-0123456789ab"
    data = [("a", f"uuid={u}"), ("b", f"x=1,uuid={u}"), ("c", f"uuid={u},y"), ("d", None), ("e", f"uuid={u.upper()}"), ("f", f"uuid={u[:-1]}c")]
    df = vm.with_uuid(spark.createDataFrame(data, "name string, smbios1 string"))
    assert rows(vm.shared_uuids(df)) == [(u, "a", 3), (u, "b", 3), (u, "c", 3)]
    assert [r["name"] for r in vm.bad_uuids(df).collect()] == ["d", "e"]


def sample_rows(spark):
    big = float(vm.TOO_LARGE)
    data = [(1, 100, 0.1, 1.0, big, big + 1, None), (1, 160, 0.2, 2.0, 4.0, big + 2, None), (1, 220, 0.3, 3.0, 2.0, big + 3, 5.0),
            (1, 280, 0.4, 4.0, 3.0, big + 4, 6.0), (2, 100, 9.0, 9.0, 9.0, big + 9, 9.0), (3, 100, 1.0, None, 1.0, 1.0, 1.0), (3, 160, 2.0, None, 1.0, 1.0, 1.0)]
    return spark.createDataFrame(data, SCHEMAS["rrd"])


def test_statistics(spark):
    values = vm.long_samples(sample_rows(spark), ["vm_id"])
    big = float(vm.TOO_LARGE)
    got = {(r["vm_id"], r["item"]): r for r in vm.item_stats(values, ["vm_id"]).collect()}
    assert len(got) == 15

    def stat(vm_id, item):
        r = got[vm_id, item]
        return r["max"], r["avg"], r["med"], r["n_ignored"], r["no_sane"], r["single_row"]

    assert stat(1, "diskread") == (4.0, 2.5, 3.5, 0, False, False)
    assert stat(1, "diskwrite") == (big, (big + 9) / 4, (4.0 + big) / 2, 0, False, False)
    assert stat(1, "netin") == (0.0, 0.0, (big + 3 + big + 4) / 2, 4, True, False)
    assert stat(1, "netout") == (6.0, 5.5, None, 0, False, False)
    assert stat(2, "cpu") == (-1.0, -1.0, -1.0, 0, False, True)
    assert stat(3, "diskread") == (0.0, 0.0, None, 0, True, False)
    exact = {(r["vm_id"], r["item"]): r["med"] for r in vm.item_stats(values, ["vm_id"], "exact").collect()}
    assert exact[1, "diskread"] == 2.5 and exact[1, "netout"] == 5.5 and exact[3, "cpu"] == 1.5


def test_ignored(spark):
    values = vm.flagged(vm.long_samples(sample_rows(spark), ["vm_id"]))
    counts = vm.ignored_counts(values, "vm_id")
    assert rows(counts, "vm_id", "n_ignored") == [(1, 4), (2, 2)]
    assert rows(vm.top_ignored(counts, "vm_id", 1), "pos", "vm_id") == [(0, 1)]
    assert rows(vm.top_ignored(counts, "vm_id"), "pos", "vm_id") == [(0, 1), (1, 2)]
    assert rows(vm.ignored_header(values, "vm_id")) == [(2, 3)]
    assert vm.ignored_values(values, ["vm_id"]).filter("vm_id = 1").count() == 4


def test_top_and_text(spark):
    data = [(i, "cpu", v, f"n{i}") for i, v in enumerate([0.5, 0.9, 0.9, None, 0.1])] + [(9, "netin", 2048.0, "z")]
    df = spark.createDataFrame(data, "vm_id int, item string, med double, name string")
    top = vm.top_items(df, "med", ["name", "vm_id"], 3)
    assert rows(top.filter("item = 'cpu'"), "pos", "vm_id") == [(0, 1), (1, 2), (2, 0)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    line = vm.report_line(F.col("pos"), vm.item_text(F.col("med"), F.col("item")), F.lit("node1"), F.col("name"))
    assert rows(top.filter("item = 'netin'").select(line)) == [("#0:    2.0 Kbps   node1 (z)",)]


def test_recent_and_consolidated(spark):
    df = spark.createDataFrame([(1, 100), (1, 400), (1, 700)], "vm_id int, time bigint")
    assert rows(vm.recent(df, F.lit(700)), "time") == [(400,), (700,)]
    ts = dt.datetime(2024, 1, 1)
    raw = spark.createDataFrame([(1, ts + dt.timedelta(seconds=s), v) for s, v in ((0, 1.0), (59, 2.0), (60, 9.0))], "vm_id int, ts timestamp_ntz, value double")
    avg = vm.consolidate(raw, ["vm_id"], "ts", ["value"], vm.STEPS["hour"])
    assert rows(avg, "ts", "value") == [(ts, 1.5), (ts + dt.timedelta(minutes=1), 9.0)]
    assert rows(vm.consolidate(raw, ["vm_id"], "ts", ["value"], vm.STEPS["month"], "MAX"), "ts", "value") == [(ts, 9.0)]
