"""Repair, purge and retention of monitoring events through change sets.

A change set has one row per changed row: `tbl`, `action` (`update` or `delete`), `id`, `new_clock`,
`name` of the host, `row_idx` of the sheet row that asked for it, and `seq`, the order of updates
within that sheet row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.times import epoch_seconds
from tidewatch.operators.joins import broadcast_if_short, is_short

# The item key looked at, the delete mark of the sheet, retention step in seconds.
PING_KEY = "icmpping"
DELETE_MARK = "删"
STEP_SECONDS = 1000
KEEP_DAYS = 31


def host_events(tables: Mapping[str, DataFrame], lo: int, hi: int, key: str = PING_KEY, measured: bool = False) -> DataFrame:
    """Events in a closed clock range with the host of their trigger: `eventid, clock, name`.

    An event repeats if its trigger has several matching functions, as in the inner joins it stands for.
    The small chain of functions, items and hosts is joined first, the events last. If it is `measured` and found short, it is sent to all
    tasks, and events keep the layout they are stored in.
    """
    chain = (
        tables["functions"]
        .join(tables["items"].filter(F.col("key_") == key).select("itemid", "hostid"), "itemid")
        .join(tables["hosts"].select("hostid", "name"), "hostid")
        .join(tables["triggers"].select("triggerid"), "triggerid")
        .select("triggerid", "name")
    )
    chain = broadcast_if_short(chain) if measured else chain
    events = tables["events"].filter(F.col("clock").between(lo, hi))
    return events.join(chain, events["objectid"] == chain["triggerid"]).select("eventid", "clock", "name")


def host_alerts(
    tables: Mapping[str, DataFrame], lo: int, hi: int, key: str = PING_KEY, events: DataFrame | None = None
) -> DataFrame:
    """Alerts of those events: `alertid, eventid, name`. `events` may hand in the result of `host_events`."""
    events = (host_events(tables, lo, hi, key) if events is None else events).select("eventid", "name")
    return tables["alerts"].select("alertid", "eventid").join(events, "eventid").select("alertid", "eventid", "name")


def for_sheet(matches: DataFrame, sheet: DataFrame, short: bool | None = None) -> DataFrame:
    """Matches of each sheet row by host name. A host listed twice gives two groups (`row_idx`). `short` may hand in whether
    the sheet is known to be short."""
    return matches.join(F.broadcast(sheet) if (is_short(sheet) if short is None else short) else sheet, "name")


def _change(action: str, clock: Column, seq: Column) -> Column:
    return F.struct(
        F.lit(action).alias("action"),
        clock.cast("bigint").alias("new_clock"),
        seq.cast("int").alias("seq"),
    )


def _emit(rows: DataFrame, changes: Column, tbl: str) -> DataFrame:
    """`tbl` is a literal of its branch, so that a filter on it cuts the other branch off."""
    return rows.withColumn("_c", F.explode(changes)).select(
        F.lit(tbl).alias("tbl"), "_c.action", "id", "_c.new_clock", "name", "row_idx", "_c.seq"
    )


def _counted(matches: DataFrame, sheet: DataFrame, id_col: str, short: bool) -> DataFrame:
    """Ids matched per sheet row, with equal ids folded into a multiplicity `m`."""
    rows = for_sheet(matches.select(F.col(id_col).alias("id"), "name"), sheet.select("row_idx", "name"), short)
    return rows.groupBy("row_idx", "id").agg(F.count(F.lit(1)).alias("m"))


def _with_sheet(rows: DataFrame, sheet: DataFrame, short: bool) -> DataFrame:
    """Adds the sheet row, and `id1`, `m1` and `id2`: its two lowest ids.

    Finding two rows per group prunes before its shuffle, and the join back spreads a host with very
    many events, which numbering all its rows in one window would not.
    """
    lowest = (
        rows.withColumn("_n", F.row_number().over(Window.partitionBy("row_idx").orderBy("id")))
        .filter(F.col("_n") <= 2)
        .groupBy("row_idx")
        .agg(
            F.max(F.when(F.col("_n") == 1, F.col("id"))).alias("id1"),
            F.max(F.when(F.col("_n") == 1, F.col("m"))).alias("m1"),
            F.max(F.when(F.col("_n") == 2, F.col("id"))).alias("id2"),
        )
    )
    pairs = lowest.join(sheet, "row_idx")
    return rows.join(F.broadcast(pairs) if short else pairs, "row_idx")


def _rows_of(tbl: str, policy: str) -> Column:
    """The changes of one counted match as an array.

    Row numbers follow from id1, m1 and id2: the first row of a group is one of id1; the second is
    another of id1 if it repeats, else one of id2.
    """
    m, first = F.col("m"), F.col("id") == F.col("id1")
    second = F.when(F.col("m1") >= 2, first).otherwise(F.col("id") == F.coalesce(F.col("id2"), F.lit(-1)))
    delete = _change("delete", F.lit(None), F.lit(None))
    none = F.array().cast("array<struct<action:string,new_clock:bigint,seq:int>>")
    ud1, ud2 = epoch_seconds(F.col("ud1")), epoch_seconds(F.col("ud2"))

    def one(test: Column, clock: Column, seq: int) -> Column:
        return F.when(test, F.array(_change("update", clock, F.lit(seq)))).otherwise(none)

    def repeat(change: Column, times: Column) -> Column:
        return F.array_repeat(change, F.greatest(times, F.lit(0)).cast("int"))

    if tbl == "alerts":
        if policy == "update_all":
            fix = repeat(_change("update", ud1, F.lit(1)), m)
        else:
            fix = F.concat(one(first, ud1, 1), repeat(delete, m - first.cast("int")))
    else:
        enough = (F.col("m1") >= 2) | F.col("id2").isNotNull()
        fix = F.concat(one(first, ud1, 1), one(second, ud2, 2))
        if policy == "keep_first":
            fix = F.concat(fix, repeat(delete, m - first.cast("int") - second.cast("int")))
        fix = F.when(enough, fix).otherwise(none)

    dated = F.col("ud1").isNotNull() & F.col("ud2").isNotNull()
    marked = F.coalesce(F.col("op") == DELETE_MARK, F.lit(False))
    fix = F.when(dated, fix).otherwise(none)
    return fix if policy == "keep_first" else F.when(marked, repeat(delete, m)).otherwise(fix)


def repair_changes(
    alerts: DataFrame, events: DataFrame, sheet: DataFrame, policy: str = "update_all"
) -> DataFrame:
    """Changes that a repair sheet (`row_idx, name, op, ud1, ud2`) asks for.

    `update_all`: a marked row deletes all its alerts and events. Any other row with both dates sets
    all alerts to `ud1` and, given two events, the first to `ud1` and the second to `ud2`.
    `keep_first`: the mark is not read; the first alert is set to `ud1` and the others deleted; given
    two events the first two are set and the others deleted.
    """
    if policy not in ("update_all", "keep_first"):
        raise ValueError(f"unknown policy {policy!r}")
    sheet = sheet.select("row_idx", "name", "op", "ud1", "ud2")
    short = is_short(sheet)
    parts = []
    for tbl, matches, id_col in (("alerts", alerts, "alertid"), ("events", events, "eventid")):
        rows = _counted(matches, sheet, id_col, short)
        parts.append(_emit(_with_sheet(rows, sheet, short), _rows_of(tbl, policy), tbl))
    return parts[0].unionByName(parts[1])


def purge_changes(matches: DataFrame, keep: DataFrame, tbl: str, id_col: str) -> DataFrame:
    """Deletes for matches whose host is not on the list."""
    gone = matches.join(broadcast_if_short(keep.select("name").distinct()), "name", "left_anti")
    return gone.select(
        F.lit(tbl).alias("tbl"),
        F.lit("delete").alias("action"),
        F.col(id_col).alias("id"),
        F.lit(None).cast("bigint").alias("new_clock"),
        "name",
    )


def change_text(id_names: Mapping[str, str]) -> Column:
    """The change as a statement text. `id_names` gives the id column of each table."""
    key = F.create_map(*[F.lit(x) for pair in id_names.items() for x in pair])[F.col("tbl")]
    return F.when(
        F.col("action") == "delete",
        F.format_string("delete from %s where %s=%d;", "tbl", key, "id"),
    ).otherwise(F.format_string("update %s set clock=%d where %s=%d;", "tbl", "new_clock", key, "id"))


def apply_changes(table: DataFrame, changes: DataFrame, tbl: str, id_col: str) -> DataFrame:
    """`table` after the changes. A delete wins; among updates the latest by sheet row and order."""
    final = (
        changes.filter(F.col("tbl") == tbl)
        .groupBy(F.col("id").alias(id_col))
        .agg(
            F.bool_or(F.col("action") == "delete").alias("_gone"),
            F.max(F.when(F.col("action") == "update", F.struct("row_idx", "seq", "new_clock"))).alias("_last"),
        )
    )
    joined = table.join(final, id_col, "left").filter(~F.coalesce(F.col("_gone"), F.lit(False)))
    return joined.withColumn("clock", F.coalesce(F.col("_last.new_clock"), F.col("clock"))).select(*table.columns)


def retention_cutoff(min_clock: Column, end: Column, step: int = STEP_SECONDS) -> Column:
    """Last `min + k * step` (k of at least 1) below `end`, or null; the rest of a step is kept."""
    k = F.floor((end - 1 - min_clock) / step).cast("bigint")
    return F.when(k >= 1, min_clock + k * step)


def retention_end(as_of: Column, offset_hours: int = 0, keep_days: int = KEEP_DAYS) -> Column:
    """Epoch second of local midnight `keep_days` before `as_of`."""
    return epoch_seconds(F.date_sub(as_of.cast("date"), keep_days), offset_hours)


def retained(table: DataFrame, end: Column, clock: str = "clock", step: int = STEP_SECONDS) -> DataFrame:
    """Rows that stay after stepwise deletion up to `end`."""
    cutoff = table.agg(retention_cutoff(F.min(clock), end, step)).scalar()
    return table.filter(cutoff.isNull() | F.col(clock).isNull() | (F.col(clock) >= cutoff))
