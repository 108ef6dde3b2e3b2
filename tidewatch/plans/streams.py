"""Incremental ingest of the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.plans.ingest import ntz
from tidewatch.plans.registry import Tables, query
from tidewatch.session import work_path
from tidewatch.sources.sinks import INPUT_KEYS, with_input
from tidewatch.streaming.ingest import ingest, prepare


def landed_events(t: Tables) -> DataFrame:
    """The event file as a stream of text rows, with the file they come from."""
    source = t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)
    return with_input(source).select(
        *INPUT_KEYS,
        F.format_number(F.col("event_id") * 1000, 0).alias("hit_count"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("seen_time"),
        "event_type",
        F.to_date("ts").alias("local_day"),
    )


@query(
    "ingest_stream",
    """
    SELECT event_id * 1000 AS hit_count, date_trunc('second', ts) - INTERVAL 8 HOUR AS seen_time, event_type,
           date_trunc('day', ts) - INTERVAL 8 HOUR AS eventdate, 'access' AS tbl, strftime(ts, '%Y.%m') AS month
    FROM events
    """,
)
def ingest_stream(t: Tables) -> DataFrame:
    """Runs the stream three times, last with a new checkpoint: later runs find nothing new and change nothing."""
    path, checkpoint = work_path(t.spark, "ingest"), work_path(t.spark, "offsets")
    for checkpoint in (checkpoint, checkpoint, work_path(t.spark, "offsets")):
        run = ingest(landed_events(t), lambda rows: prepare(rows, "access", "local_day"), path, checkpoint)
        run.awaitTermination()
    out = t.spark.read.option("inferSchema", False).parquet(path)
    return out.select(
        "hit_count",
        ntz("seen_time").alias("seen_time"),
        "event_type",
        ntz("eventdate").alias("eventdate"),
        "tbl",
        F.col("month").cast("string").alias("month"),
    )
