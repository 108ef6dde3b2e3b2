"""Tables that are kept: by day, by key, as rollups, and as the state of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.repair import host_alerts, host_events, retention_end
from tidewatch.operators.rollups import CASCADE, extend_rollups, roll_up, series
from tidewatch.plans.events import APPLIED_SQL, CHAIN_SQL, HI, LO, RETENTION_SQL, changes_of, monitoring
from tidewatch.plans.registry import Tables, query
from tidewatch.session import work_path
from tidewatch.sources import daytable, sinks
from tidewatch.sources.keyed import store_monitoring
from tidewatch.streaming.history import follow, history


@query("stored_changes", APPLIED_SQL)
def stored_changes(t: Tables) -> DataFrame:
    """The change set applied to events kept by month: only the months it falls on, or moves events to, are written anew."""
    path = work_path(t.spark, "events-by-month")
    events = monitoring(t)["events"]
    daytable.write_days(events, path, label="yyyy-MM")
    daytable.change_days(t.spark, path, events.schema, changes_of(t, "keep_first"), "events", "eventid", label="yyyy-MM")
    return daytable.read_days(t.spark, path, events.schema).drop("day")


@query("stored_retention", RETENTION_SQL)
def stored_retention(t: Tables) -> DataFrame:
    """Retention of a history kept by day, run twice: the second time nothing is left to do."""
    path = work_path(t.spark, "history-by-day")
    rows = t.events.select(F.col("event_id").alias("id"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("clock"))
    daytable.write_days(rows, path)
    daytable.drop_old_days(t.spark, path, rows.schema, retention_end(F.lit("2024-02-15")))
    daytable.drop_old_days(t.spark, path, rows.schema, retention_end(F.lit("2024-02-15")))
    return daytable.read_days(t.spark, path, rows.schema).drop("day")


@query("keyed_chain", CHAIN_SQL)
def keyed_chain(t: Tables) -> DataFrame:
    """The chain of alerts over alerts and events that are stored by event."""
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    stored = store_monitoring(monitoring(t), work_path(t.spark, "by-event"), buckets)
    return host_alerts(stored, LO, HI, events=host_events(stored, LO, HI, measured=True))


_SERIES_SQL = " UNION ALL ".join(
    f"""SELECT {step} AS step, event_type, (epoch(ts)::BIGINT // {step}) * {step} AS time, round(avg(value) + 1.23e-8, 6) AS mean, max(value) AS most
        FROM (SELECT *, date_trunc('second', ts) AS s FROM events) GROUP BY 1, 2, 3""".replace("epoch(ts)", "epoch(s)")
    for step in CASCADE
)


@query("rollup_series", _SERIES_SQL)
def rollup_series(t: Tables) -> DataFrame:
    """Averages and maxima of every step from kept rollups, to which samples came in two loads, the second of them twice."""
    path, keys, values = work_path(t.spark, "rollups"), ["event_type"], ["value"]
    samples = t.events.select("event_type", F.unix_seconds(F.col("ts").cast("timestamp")).alias("time"), "value", "event_id")
    for batch, odd in (("first", 0), ("second", 1), ("second", 1)):
        extend_rollups(samples.where(F.col("event_id") % 2 == odd), path, batch, keys, "time", values)
    schema = roll_up(samples, keys, "time", values, CASCADE[:1]).drop("step").schema

    def both(step: int) -> DataFrame:
        mean = series(t.spark, path, schema, keys, values, step).withColumnRenamed("value", "mean")
        most = series(t.spark, path, schema, keys, values, step, "MAX").withColumnRenamed("value", "most")
        return mean.join(most, [*keys, "time"]).select(F.lit(step).alias("step"), "event_type", "time", F.round(F.col("mean") + 1.23e-8, 6).alias("mean"), "most")

    out = both(CASCADE[0])
    for step in CASCADE[1:]:
        out = out.unionByName(both(step))
    return out


@query(
    "request_history",
    """
    SELECT event_type AS server, event_id, age FROM (
      SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS age FROM events) WHERE age <= 10
    """,
)
def request_history(t: Tables) -> DataFrame:
    """The latest ten requests of each server from a stream whose requests come in three loads, out of order."""
    spark = t.spark
    landed, path, checkpoint = (work_path(spark, f"requests-{part}") for part in ("in", "out", "offsets"))
    rows = t.events.select(F.col("event_type").alias("server"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), F.col("event_id").alias("tie"), F.col("props").alias("request"))
    for load in range(3):
        rows.where(F.pmod(F.xxhash64("tie"), F.lit(3)) == load).write.mode("append").parquet(landed)
        follow(spark.readStream.schema(rows.schema).parquet(landed), path, checkpoint).awaitTermination()
    return history(spark, path).select("server", F.col("tie").alias("event_id"), "age")


@query(
    "listed_days",
    """
    SELECT event_type AS tbl, strftime(ts, '%Y.%m') AS month, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_rows
    FROM events GROUP BY 1, 2, 3
    """,
)
def listed_days(t: Tables) -> DataFrame:
    """Rows of every day of an index table, from its folders and the footers of its files; no column is read."""
    path = work_path(t.spark, "index")
    events = t.events.select("event_id", "event_type", F.to_date("ts").alias("local"))
    sinks.write_index(sinks.with_partitions(events, F.col("event_type"), F.col("local")).drop("event_type", "local"), path)
    return sinks.loaded_counts(t.spark, path)
