"""Virtual machine filters, robust statistics over their samples, and rankings."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.numbers import humanize_bits, humanize_bytes, humanize_percent
from tidewatch.functions.text import glob_match, is_uuid, packed_uuid
from tidewatch.operators.joins import null_safe_join
from tidewatch.operators.ranks import HOT_ROWS, values_at
from tidewatch.session import checkpointed

# Metrics with their text form, the sanity limit, volume kinds, states, steps.
ITEMS: dict[str, Callable[[Column], Column]] = {
    "cpu": humanize_percent,
    "diskread": humanize_bytes,
    "diskwrite": humanize_bytes,
    "netin": humanize_bits,
    "netout": humanize_bits,
}
TOO_LARGE = 0x3FFFFFFFFF
VOLUME_KEY = r"^(ide|sata|scsi|virtio)\d+\z"
STEPS = {
    "5min": "1 minute",
    "hour": "1 minute",
    "day": "30 minutes",
    "week": "3 hours",
    "month": "12 hours",
    "year": "7 days",
}
# Seconds that a timeframe reaches back: seventy of its steps, but for the shortest.
SPANS = {
    "5min": 300,
    "hour": 70 * 60,
    "day": 70 * 30 * 60,
    "week": 70 * 3 * 3600,
    "month": 70 * 12 * 3600,
    "year": 70 * 7 * 86400,
}
NO_SAMPLES = "no samples"
SUBTYPES = {"AVERAGE": "avg", "MEDIAN": "med", "MAX": "max"}
TOP = 8
# The series that a function reads.
SERIES = {"AVERAGE": "AVERAGE", "MEDIAN": "AVERAGE", "MAX": "MAX"}


def named(vms: DataFrame, patterns: Sequence[str], name: str = "name") -> DataFrame:
    """Machines whose name matches any glob; no pattern keeps all."""
    return vms.filter(glob_match(F.col(name), patterns)) if patterns else vms


def with_storage(vms: DataFrame, volumes: DataFrame, pattern: str) -> DataFrame:
    """Machines with at least one disk volume whose value matches the glob."""
    fits = F.col("key").rlike(VOLUME_KEY) & F.col("value").isNotNull() & glob_match(F.col("value"), [pattern])
    return vms.join(volumes.filter(fits).select("vm_id"), "vm_id", "left_semi")


def routed(vms: DataFrame, strict: bool = False) -> DataFrame:
    """Adds `route`: `keep`, `drop`, `warn`, `node_down` (no status) or `unknown`; `strict` raises on the last."""
    status = F.col("status")
    other = F.lit("unknown")
    if strict:
        other = F.raise_error(F.concat(F.lit("unexpected status "), status)).cast("string")
    route = (
        F.when(status.isNull(), "node_down")
        .when(status == "stopped", "drop")
        .when(status.isin("internal-error", "prelaunch"), "warn")
        .when(status.isin("running", "paused"), "keep")
        .otherwise(other)
    )
    return vms.withColumn("route", route)


def nodes_down(routed_vms: DataFrame) -> DataFrame:
    """Each node with machines of unknown status, once, with the first of them and their number."""
    return (
        routed_vms.filter(F.col("route") == "node_down")
        .groupBy("node")
        .agg(F.min("vm_id").alias("vm_id"), F.count(F.lit(1)).alias("n_vms"))
    )


def repeated_names(vms: DataFrame) -> DataFrame:
    """Names that more than one machine has."""
    return vms.groupBy("name").agg(F.count(F.lit(1)).alias("n_vms")).filter(F.col("n_vms") > 1)


def with_uuid(config: DataFrame, packed: str = "smbios1") -> DataFrame:
    """Adds `uuid` from the packed setting and whether it is valid."""
    return config.withColumn("uuid", packed_uuid(F.col(packed))).withColumn("uuid_ok", is_uuid(F.col("uuid")))


def bad_uuids(vms: DataFrame) -> DataFrame:
    """Machines without a valid uuid, sorted by name; one row each rather than one long text."""
    return vms.filter(~F.col("uuid_ok")).select("name", "uuid").orderBy("name")


def shared_uuids(vms: DataFrame) -> DataFrame:
    """Machines that share a valid uuid: one row per machine with the number of sharers.

    Rows, not a list per uuid, so that a uuid copied to very many machines stays distributed.
    """
    valid = vms.filter("uuid_ok").select("uuid", "name")
    dup = valid.groupBy("uuid").agg(F.count(F.lit(1)).alias("n_dup")).filter(F.col("n_dup") > 1)
    return valid.join(dup, "uuid").select("uuid", "name", "n_dup")


def recent(samples: DataFrame, as_of: Column, seconds: int = 300, time: str = "time") -> DataFrame:
    """Samples of the last five minutes."""
    return samples.filter(F.col(time) >= as_of - seconds)


def consolidate(
    samples: DataFrame,
    keys: Sequence[str],
    ts: str,
    values: Sequence[str],
    step: str = "1 minute",
    cf: str = "AVERAGE",
) -> DataFrame:
    """Coarser series: average or maximum of each value per key and step. `MEDIAN` reads averages; other names raise."""
    if cf not in SERIES:
        raise ValueError(f"unknown function {cf!r}; known are {', '.join(SERIES)}")
    how = F.max if SERIES[cf] == "MAX" else F.avg
    grouped = samples.groupBy(*keys, F.window(ts, step).alias("_w")).agg(*[how(v).alias(v) for v in values])
    return grouped.select(*keys, F.col("_w.start").alias(ts), *values)


def long_samples(samples: DataFrame, ids: Sequence[str], items: Iterable[str] = tuple(ITEMS)) -> DataFrame:
    """One row per sample and metric; missing values stay as nulls."""
    items = list(items)
    wide = samples.select(*ids, *[F.col(i).cast("double").alias(i) for i in items])
    return wide.unpivot(list(ids), items, "item", "value")


def flagged(values: DataFrame, limit: float = TOO_LARGE) -> DataFrame:
    """Adds `is_valid`: null for a missing value, else whether it is at most the limit."""
    return values.withColumn("is_valid", F.col("value") <= limit)


def item_stats(
    values: DataFrame,
    keys: Sequence[str],
    median: str = "as_written",
    limit: float = TOO_LARGE,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per key and metric of long samples: samples, valid and ignored values, `max`, `avg`, `med`, `no_sane`, `single_row`.

    `max` and `avg` use valid values, and are 0 if there is none. `med` uses all values: by default
    the mean of those at positions n/2 and n/2+1 counted from 0, which is null up to two values;
    `exact` gives the usual median. A key with one sample has -1 for all three. The sums per key are
    checkpointed; keys with more than `hot_rows` values are not sorted in one task.
    """
    group = [*keys, "item"]
    v = F.col("value")
    ok = v <= limit
    valid = F.when(ok, v)
    sums = checkpointed(
        values.groupBy(*group).agg(
            F.count(F.lit(1)).alias("n_samples"),
            F.count(v).alias("_n"),
            F.count(valid).alias("n_valid"),
            F.count(F.when(~ok, 1)).alias("n_ignored"),
            F.max(valid).alias("_max"),
            F.avg(valid).alias("_avg"),
        )
    )
    if median == "exact":
        at = {"_a": lambda n: F.floor((n - 1) / 2), "_b": lambda n: F.floor(n / 2)}
    else:
        at = {"_a": lambda n: F.floor(n / 2), "_b": lambda n: F.floor(n / 2) + 1}
    middle = values_at(values, group, "value", at, sums, "_n", hot_rows)
    one = F.col("n_samples") == 1

    def shown(stat: Column) -> Column:
        return F.when(one, -1.0).otherwise(stat)

    return null_safe_join(sums, middle, group, "left").select(
        *group,
        "n_samples",
        "n_valid",
        "n_ignored",
        shown(F.coalesce("_max", F.lit(0.0))).alias("max"),
        shown(F.coalesce("_avg", F.lit(0.0))).alias("avg"),
        shown((F.col("_a") + F.col("_b")) / 2).alias("med"),
        ((F.col("n_valid") == 0) & ~one).alias("no_sane"),
        one.alias("single_row"),
    )


def ignored_values(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The values over the limit, one row each."""
    return values.filter(~F.col("is_valid")).select(*keys, "item", "value")


def ignored_counts(values: DataFrame, key: str) -> DataFrame:
    """Ignored values per machine, for machines with any. A single-sample machine counts as 2."""
    per_vm = values.groupBy(key, "item").agg(
        F.count(F.lit(1)).alias("_n"), F.count(F.when(~F.col("is_valid"), 1)).alias("_bad")
    )
    totals = per_vm.groupBy(key).agg(F.max("_n").alias("_n"), F.sum("_bad").alias("_bad"))
    n = F.when(F.col("_n") == 1, F.lit(2).cast("bigint")).otherwise(F.col("_bad"))
    return totals.select(key, n.alias("n_ignored")).filter(F.col("n_ignored") > 0)


def top_ignored(counts: DataFrame, key: str, k: int = TOP) -> DataFrame:
    """Machines with the most ignored values, from position 0; ties by name."""
    top = counts.orderBy(F.desc("n_ignored"), key).limit(k)
    pos = F.row_number().over(Window.orderBy(F.desc("n_ignored"), key)) - 1
    return top.withColumn("pos", pos.cast("bigint"))


def ignored_header(values: DataFrame, key: str) -> DataFrame:
    """One row: machines with ignored data and machines in all."""
    per_vm = values.groupBy(key, "item").agg(
        F.count(F.lit(1)).alias("_n"), F.bool_or(~F.col("is_valid")).alias("_bad")
    )
    vms = per_vm.groupBy(key).agg(F.max("_n").alias("_n"), F.bool_or("_bad").alias("_bad"))
    hit = F.col("_bad") | (F.col("_n") == 1)
    return vms.agg(F.count(F.when(hit, 1)).alias("n_ignored_vms"), F.count(F.lit(1)).alias("n_vms"))


def top_items(stats: DataFrame, by: str, ties: Sequence[str], k: int = TOP) -> DataFrame:
    """The k largest machines per metric, from position 0. `by` is `avg`, `med` or `max`.

    The rank is filtered as it is made, so Spark prunes each task to k rows per metric before the shuffle.
    """
    order = Window.partitionBy("item").orderBy(F.col(by).desc_nulls_last(), *ties)
    ranked = stats.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= k)
    return ranked.withColumn("pos", (F.col("_rn") - 1).cast("bigint")).drop("_rn")


def item_text(value: Column, item: Column) -> Column:
    """The value in the text form of its metric."""
    text = F.lit(None).cast("string")
    for name, form in ITEMS.items():
        text = F.when(item == name, form(value)).otherwise(text)
    return text


def report_line(pos: Column, text: Column, node: Column, name: Column) -> Column:
    return F.format_string("#%d: %s  %s (%s)", pos, text, node, name)
