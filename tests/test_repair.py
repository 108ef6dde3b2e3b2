from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import one, rows
from tidewatch.operators import repair as rp
from tidewatch.operators.sheets import prefix_until_blank
from tidewatch.operators.spines import loaded_days, missing_days, with_days, with_pages
from tidewatch.sources.landed import SCHEMAS

T1, T2 = dt.datetime(2019, 1, 18, 22), dt.datetime(2019, 1, 18, 23)
C1, C2 = 1547848800, 1547852400


def tables(spark):
    """Hosts a to d with 0, 1, 2 and 4 events; the trigger of d matches through two functions."""
    data = {
        "hosts": [(1, "a"), (2, "b"), (3, "c"), (4, "d")],
        "items": [(10, 1, "icmpping"), (20, 2, "icmpping"), (30, 3, "icmpping"), (31, 3, "cpu"), (40, 4, "icmpping"), (41, 4, "icmpping")],
        "functions": [(1, 10), (2, 20), (3, 30), (3, 31), (4, 40), (4, 41)],
        "triggers": [(1,), (2,), (3,), (4,)],
        "events": [(100, 1, 99), (200, 2, 100), (300, 3, 150), (301, 3, 200), (400, 4, 150), (401, 4, 160), (402, 4, 201)],
        "alerts": [(1, 100, 0), (2, 200, 0), (3, 300, 0), (4, 301, 0), (5, 301, 0), (6, 400, 0), (7, 402, 0)],
    }
    return {n: spark.createDataFrame(d, SCHEMAS[n]) for n, d in data.items()}


def test_chains_with_closed_range_and_repeats(spark):
    t = tables(spark)
    assert rows(rp.host_events(t, 100, 200), "eventid", "name") == [
        (200, "b"), (300, "c"), (301, "c"), (400, "d"), (400, "d"), (401, "d"), (401, "d"),
    ]
    assert rows(rp.host_alerts(t, 100, 200), "alertid", "name") == [(2, "b"), (3, "c"), (4, "c"), (5, "c"), (6, "d"), (6, "d")]


def changes(spark, sheet, policy):
    t = tables(spark)
    df = spark.createDataFrame(sheet, SCHEMAS["repair_sheet"])
    out = rp.repair_changes(rp.host_alerts(t, 100, 200), rp.host_events(t, 100, 200), df, policy)
    return rows(out, "row_idx", "tbl", "action", "id", "new_clock", "seq")


def test_update_all(spark):
    sheet = [(2, "a", "改", T1, T2), (3, "b", "改", T1, T2), (4, "c", None, T1, T2), (5, "c", "删", None, None), (6, "d", "改", T1, None)]
    got = changes(spark, sheet, "update_all")
    assert [g for g in got if g[0] == 3] == [(3, "alerts", "update", 2, C1, 1)]
    assert sorted(g[1:5] for g in got if g[0] == 4) == [
        ("alerts", "update", 3, C1), ("alerts", "update", 4, C1), ("alerts", "update", 5, C1),
        ("events", "update", 300, C1), ("events", "update", 301, C2),
    ]
    assert sorted(g[1:4] for g in got if g[0] == 5) == [
        ("alerts", "delete", 3), ("alerts", "delete", 4), ("alerts", "delete", 5), ("events", "delete", 300), ("events", "delete", 301),
    ]
    assert {g[0] for g in got} == {3, 4, 5}


def test_keep_first_with_repeated_rows(spark):
    got = changes(spark, [(2, "d", "删", T1, T2), (3, "c", None, T1, T2), (4, "b", None, T1, T2)], "keep_first")
    key = lambda g: (g[1], g[2], g[3], g[4] or 0)
    assert sorted((g for g in got if g[0] == 2), key=key) == [
        (2, "alerts", "delete", 6, None, None), (2, "alerts", "update", 6, C1, 1),
        (2, "events", "delete", 401, None, None), (2, "events", "delete", 401, None, None),
        (2, "events", "update", 400, C1, 1), (2, "events", "update", 400, C2, 2),
    ]
    assert sorted(g[1:5] for g in got if g[0] == 3 and g[1] == "alerts" and g[2] == "update") == [("alerts", "update", 3, C1)]
    assert sorted(g[3] for g in got if g[0] == 3 and g[2] == "delete") == [4, 5]
    assert [g[1:] for g in got if g[0] == 4] == [("alerts", "update", 2, C1, 1)]


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        changes(spark, [(2, "a", None, T1, T2)], "other")


def test_purge_and_text(spark):
    t = tables(spark)
    keep = spark.createDataFrame([(2, "c"), (3, "d")], SCHEMAS["keep_names"])
    out = rp.purge_changes(rp.host_events(t, 100, 200), keep, "events", "eventid")
    assert rows(out, "tbl", "action", "id", "name") == [("events", "delete", 200, "b")]
    text = rp.change_text({"alerts": "alertid", "events": "eventid"})
    assert rows(out.select(text)) == [("delete from events where eventid=200;",)]
    update = spark.createDataFrame([("alerts", "update", 7, 55)], "tbl string, action string, id bigint, new_clock bigint")
    assert rows(update.select(text)) == [("update alerts set clock=55 where alertid=7;",)]


def test_apply_order_and_repeat(spark):
    events = spark.createDataFrame([(1, 0, 5), (2, 0, 5), (3, 0, 5), (4, 0, 5)], SCHEMAS["events"])
    ch = spark.createDataFrame(
        [("events", "update", 1, 10, 2, 1), ("events", "update", 1, 11, 2, 2), ("events", "update", 2, 12, 3, 1),
         ("events", "update", 2, 13, 2, 2), ("events", "delete", 3, None, 2, None), ("events", "update", 3, 9, 9, 1), ("alerts", "delete", 4, None, 2, None)],
        "tbl string, action string, id bigint, new_clock bigint, row_idx bigint, seq int",
    )
    once = rp.apply_changes(events, ch, "events", "eventid")
    assert rows(once, "eventid", "clock") == [(1, 11), (2, 12), (4, 5)]
    assert rows(rp.apply_changes(once, ch, "events", "eventid"), "eventid", "clock") == rows(once, "eventid", "clock")


def test_retention_equals_the_steps(spark):
    rnd = random.Random(1)
    pairs = [(m, m + d) for m in (0, 1547800000) for d in (-5, 0, 999, 1000, 1001, 1999, 2000, 2001, *[rnd.randrange(10**5) for _ in range(300)])]
    df = spark.createDataFrame(pairs, "m bigint, e bigint")
    for m, e, got in df.select("m", "e", rp.retention_cutoff(F.col("m"), F.col("e"))).collect():
        at, last = m + 1000, None
        while at < e:
            at, last = at + 1000, at
        assert got == last
    empty = spark.createDataFrame([], SCHEMAS["proxy_history"])
    assert rp.retained(empty, F.lit(5)).count() == 0
    history = spark.createDataFrame([(i, 100 * i) for i in range(50)], SCHEMAS["proxy_history"])
    assert rows(rp.retained(history, F.lit(2500)).agg(F.min("clock"))) == [(2000,)]
    assert rp.retained(history, F.lit(900)).count() == 50
    assert one(spark, rp.retention_end(F.lit("2019-02-18"), 8)) == 1547740800


def test_sheet_prefix(spark):
    sheet = spark.createDataFrame([(2, "a"), (3, "b"), (4, ""), (5, "c")], SCHEMAS["keep_names"])
    assert rows(prefix_until_blank(sheet, "name"), "name") == [("a",), ("b",)]
    assert prefix_until_blank(sheet.filter("row_idx <> 4"), "name").count() == 3
    assert prefix_until_blank(sheet.withColumn("name", F.lit(None).cast("string")), "name").count() == 0


def test_days(spark):
    jobs = spark.createDataFrame([("a",), ("b",)], "tbl string")
    spine = with_days(jobs, F.lit("2019-01-10"), F.lit("2019-01-13"))
    assert spine.filter("tbl = 'a'").select(F.col("day").cast("string")).collect()[0][0] == "2019-01-12"
    assert spine.count() == 6
    assert with_days(jobs, F.lit("2019-01-13"), F.lit("2019-01-13")).count() == 0
    target = spark.createDataFrame([("a", dt.date(2019, 1, 11))] * 2 + [("b", dt.date(2019, 1, 1))], "tbl string, day date")
    loaded = loaded_days(target, ["tbl"], "day")
    assert rows(loaded.filter("n_rows = 2"), "tbl") == [("a",)]
    gone = missing_days(spine, loaded, ["tbl", "day"])
    assert rows(gone.filter("tbl = 'a'").select(F.day("day"))) == [(10,), (12,)] and gone.count() == 5


@pytest.mark.parametrize("block", [1, 2, 10_000])
def test_pages_cover_once(spark, block):
    jobs = spark.createDataFrame([("a", 0), ("b", 1), ("c", 1000), ("d", 1001), ("e", 5500), ("f", -1)], "tbl string, n bigint")
    got = rows(with_pages(jobs, "n", block=block), "tbl", "dstart")
    want = [(t, s) for t, n in (("b", 1), ("c", 1000), ("d", 1001), ("e", 5500)) for s in range(0, n, 1000)]
    assert sorted(got) == want


def by_hand(matches, sheet, tbl, policy):
    """Changes of one table by numbering the sorted ids of each sheet row."""
    out = []
    for row_idx, name, op, ud1, ud2 in sheet:
        ids = sorted(i for i, n in matches if n == name)
        c1, c2 = (int(u.replace(tzinfo=dt.timezone.utc).timestamp()) if u else None for u in (ud1, ud2))
        if policy == "update_all" and op == "删":
            out += [(row_idx, tbl, "delete", i, None, None) for i in ids]
        elif ud1 and ud2 and tbl == "alerts":
            first = ids if policy == "update_all" else ids[:1]
            out += [(row_idx, tbl, "update", i, c1, 1) for i in first]
            out += [(row_idx, tbl, "delete", i, None, None) for i in ids[len(first):]]
        elif ud1 and ud2 and len(ids) >= 2:
            out += [(row_idx, tbl, "update", i, c, k) for i, c, k in zip(ids, (c1, c2), (1, 2))]
            if policy == "keep_first":
                out += [(row_idx, tbl, "delete", i, None, None) for i in ids[2:]]
    return out


@pytest.mark.parametrize("policy", ["update_all", "keep_first"])
def test_a_hot_host_with_repeats_equals_numbering_by_hand(spark, policy):
    rnd = random.Random(4)
    names = ["hot"] * 8 + [f"h{i}" for i in range(12)]
    events = [(rnd.randrange(900), rnd.choice(names)) for _ in range(1500)]
    alerts = [(rnd.randrange(900), rnd.choice(names)) for _ in range(1500)] + [(7, "h1")] * 3
    sheet = [(2, "hot", "改", T1, T2), (3, "h0", "删", T1, T2), (4, "h1", None, T1, T2), (5, "hot", None, T2, T1), (6, "h2", "改", T1, None)]
    make = lambda data, c: spark.createDataFrame(data, f"{c} bigint, name string").repartition(6)
    out = rp.repair_changes(make(alerts, "alertid"), make(events, "eventid"), spark.createDataFrame(sheet, SCHEMAS["repair_sheet"]), policy)
    order = lambda t: tuple((x is not None, str(x)) for x in t)
    want = by_hand(alerts, sheet, "alerts", policy) + by_hand(events, sheet, "events", policy)
    assert rows(out, "row_idx", "tbl", "action", "id", "new_clock", "seq") == sorted(want, key=order)
