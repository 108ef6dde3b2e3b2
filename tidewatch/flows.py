"""Whole jobs, put together from the operators. Sources and targets are handed in as DataFrames or paths."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.text import fill_template
from tidewatch.functions.times import day_label
from tidewatch.operators import vmstats as vm
from tidewatch.operators.coerce import coerce_by_suffix, index_name, ip_columns, rename_headers
from tidewatch.operators.documents import appraisal_rejects, document_records, document_text
from tidewatch.operators.firewall import policy_table
from tidewatch.operators.geo import geo_enrich
from tidewatch.operators.inventory import inventory_actions, running_rows
from tidewatch.operators.joins import broadcast_if_short
from tidewatch.operators.repair import host_alerts, host_events, purge_changes, repair_changes
from tidewatch.operators.sheets import prefix_until_blank
from tidewatch.operators.spines import PAGE, loaded_days, missing_days, with_days, with_pages
from tidewatch.session import checkpointed
from tidewatch.sources.landed import read_flow_files, read_lines, read_sheet
from tidewatch.sources.sinks import append_records, has_index, loaded_partitions, loaded_undated, write_index, write_policy_sheet
from tidewatch.streaming.ingest import prepare_answers


def days_to_fetch(jobs: DataFrame, target: DataFrame, first: Column, as_of: Column) -> DataFrame:
    """Jobs (`httpurl, tblname, purl`) and days that the target (`tbl, day`) lacks, with index name and
    the one-row request that asks for the number of rows."""
    spine = with_days(jobs.withColumn("tbl", F.col("tblname")), first, as_of)
    have = loaded_days(target.select("tbl", F.col("day").cast("date").alias("day")), ["tbl"], "day")
    probe = fill_template(F.col("httpurl"), day_label(F.col("day")), F.lit(0), F.lit(1), F.col("purl"))
    return missing_days(spine, have, ["tbl", "day"]).withColumns(
        {"index": index_name(F.col("day"), F.col("tbl")), "probe_url": probe}
    )


def page_requests(days: DataFrame, count: str = "row_count", limit: int = PAGE) -> DataFrame:
    """One request per page of each day, given the number of rows the probe found."""
    url = fill_template(F.col("httpurl"), day_label(F.col("day")), F.col("dstart"), F.lit(limit), F.col("purl"))
    return with_pages(days, count, limit).withColumn("url", url)


def load_flows(spark: SparkSession, folder: str, ranges: DataFrame, ranges6: DataFrame | None = None) -> DataFrame:
    """Flow files with short names, typed columns, and the places of their addresses, of IPv6 ones too if `ranges6` is given."""
    typed = coerce_by_suffix(rename_headers(read_flow_files(spark, folder)))
    return geo_enrich(typed, ip_columns(typed), ranges, ranges6=ranges6)


def load_answers(
    answers: DataFrame,
    path: str,
    table: str,
    day: str,
    field: str = "result",
    exclude: Sequence[str] = (),
    ranges: DataFrame | None = None,
    offset_hours: int = 8,
) -> DataFrame:
    """The whole load of landed answers (`value`, one answer a row) into the index table at `path`; gives the rows written.

    Every key that any row has becomes a column and is typed by its name; `day` is the key of the local day. With
    `ranges`, addresses get their places. Days that the table already holds of `table`, by its folders, are skipped. Rows without a
    readable day are told apart by the answer and the place in it that they come from, and skipped if the table holds them.
    """
    spark = answers.sparkSession
    rows = checkpointed(prepare_answers(answers, table, day, field, exclude, ranges, offset_hours))
    if has_index(spark, path):
        days = checkpointed(loaded_partitions(spark, path, table).where("day IS NOT NULL").select("day").distinct())
        dated = rows.where("day IS NOT NULL").join(broadcast_if_short(days), "day", "left_anti").select(*rows.columns)
        undated = rows.where("day IS NULL").join(loaded_undated(spark, path, table), "_row_id", "left_anti").select(*rows.columns)
        rows = dated.unionByName(undated)
    write_index(rows, path)
    return rows


def reconcile_hosts(spark: SparkSession, sheet: str, hosts: DataFrame, groups: DataFrame) -> DataFrame:
    """Actions that a landed host sheet asks for: its running rows against the hosts and groups that exist."""
    desired = running_rows(read_sheet(spark, sheet, "desired_hosts"))
    return inventory_actions(desired, hosts, groups)


def load_documents(paras: DataFrame, cells: DataFrame, images: DataFrame, path: str) -> DataFrame:
    """Records of all documents that match the letter pattern, appended to the table at `path`; gives the ids of the others."""
    append_records(document_records(paras, cells, images), path)
    return appraisal_rejects(document_text(paras)).select("doc_id")


def flatten_policies(spark: SparkSession, folder: str, path: str) -> None:
    """Policy files of a folder to one sheet."""
    write_policy_sheet(policy_table(read_lines(spark, folder)), path)


def repair_events(tables: Mapping[str, DataFrame], sheet: DataFrame, lo: int, hi: int, policy: str) -> DataFrame:
    """Changes of a repair sheet that ends at its first blank name."""
    rows = prefix_until_blank(sheet, "name")
    events = checkpointed(host_events(tables, lo, hi))
    return repair_changes(host_alerts(tables, lo, hi, events=events), events, rows, policy)


def purge_events(tables: Mapping[str, DataFrame], names: DataFrame, lo: int, hi: int) -> DataFrame:
    """Deletes for all alerts and events of hosts that are not on the list."""
    keep = prefix_until_blank(names, "name")
    events = checkpointed(host_events(tables, lo, hi))
    alerts = purge_changes(host_alerts(tables, lo, hi, events=events), keep, "alerts", "alertid")
    return alerts.unionByName(purge_changes(events, keep, "events", "eventid"))


@dataclass(frozen=True)
class VmReport:
    """Results of `vm_report`; each is a DataFrame."""

    top: DataFrame
    ignored: DataFrame
    ignored_values: DataFrame
    ignored_header: DataFrame
    warnings: DataFrame
    nodes_down: DataFrame
    repeated_names: DataFrame
    bad_uuids: DataFrame
    shared_uuids: DataFrame


def vm_report(
    vms: DataFrame,
    volumes: DataFrame,
    config: DataFrame,
    rrd: DataFrame,
    as_of: Column,
    names: Sequence[str] = (),
    storage: str | None = None,
    timeframe: str = "hour",
    aggregation: str = "MEDIAN",
    top: int = vm.TOP,
) -> VmReport:
    """Machines with the highest use per metric, and what is wrong with the others.

    Cheap filters come before anything is joined. The timeframe chooses how far back samples count and the step they are
    brought to; `MAX` takes the largest value of a step, `AVERAGE` and `MEDIAN` the mean. `rrd` may hold samples of that step or of
    any finer one. It is read once: the series is written to the shared folder. A kept machine without samples is
    named in the warnings and counts in the header. Tables are those of `sources.landed.SCHEMAS`.
    """
    if timeframe not in vm.STEPS:
        raise ValueError(f"unknown timeframe {timeframe!r}; known are {', '.join(vm.STEPS)}")
    chosen = vm.named(vms, names)
    if storage is not None:
        chosen = vm.with_storage(chosen, volumes, storage)
    routed = vm.routed(chosen)
    kept = routed.filter(F.col("route") == "keep").select("vm_id", "name", "node")
    samples = vm.recent(rrd, F.unix_seconds(as_of.cast("timestamp")), vm.SPANS[timeframe]).withColumn("_at", F.timestamp_seconds("time"))
    series = vm.consolidate(samples.join(kept, "vm_id"), ["vm_id", "name", "node"], "_at", list(vm.ITEMS), vm.STEPS[timeframe], aggregation)
    values = checkpointed(vm.long_samples(series, ["vm_id", "name", "node"]))
    silent = kept.join(values.select("vm_id").distinct(), "vm_id", "left_anti")
    warned = routed.filter(F.col("route").isin("warn", "unknown")).select("vm_id", "name", "node", "status")
    header = vm.ignored_header(flagged := vm.flagged(values), "name")
    n_silent = silent.agg(F.count(F.lit(1))).scalar()
    stats = vm.item_stats(values, ["vm_id", "name", "node"])
    by = vm.SUBTYPES[aggregation]
    ranked = vm.top_items(stats, by, ["name", "vm_id"], top)
    line = vm.report_line(F.col("pos"), vm.item_text(F.col(by), F.col("item")), F.col("node"), F.col("name"))
    uuids = vm.with_uuid(kept.join(config, "vm_id", "left"))
    return VmReport(
        top=ranked.withColumn("line", line),
        ignored=vm.top_ignored(vm.ignored_counts(flagged, "name"), "name", top),
        ignored_values=vm.ignored_values(flagged, ["vm_id", "name"]),
        ignored_header=header.withColumn("n_vms", F.col("n_vms") + n_silent),
        warnings=warned.unionByName(silent.select("vm_id", "name", "node", F.lit(vm.NO_SAMPLES).alias("status"))),
        nodes_down=vm.nodes_down(routed),
        repeated_names=vm.repeated_names(kept),
        bad_uuids=vm.bad_uuids(uuids),
        shared_uuids=vm.shared_uuids(uuids),
    )
