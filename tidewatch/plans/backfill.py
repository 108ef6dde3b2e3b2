"""Days and pages still to fetch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import fill_template
from tidewatch.functions.times import day_label
from tidewatch.operators.spines import loaded_days, missing_days, with_days, with_pages
from tidewatch.plans.registry import Tables, query

TEMPLATE = "https://host.example/purl?startTime=dstr&endTime=dstr&start=dstart&limit=dlimit"


@query(
    "day_counts",
    "SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n_rows FROM events GROUP BY 1, 2",
)
def day_counts(t: Tables) -> DataFrame:
    return loaded_days(t.events.select("event_type", F.to_date("ts").alias("day")), ["event_type"], "day")


@query(
    "missing_days",
    """
    SELECT j.user_id, CAST(d.day AS DATE) AS day
    FROM (SELECT DISTINCT user_id FROM events) j,
         generate_series(DATE '2023-12-25', DATE '2024-02-03', INTERVAL 1 DAY) AS d(day)
    WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = j.user_id AND CAST(e.ts AS DATE) = d.day)
    """,
)
def missing(t: Tables) -> DataFrame:
    """One job per user; days before and after the data are missing for all."""
    seen = t.events.select("user_id", F.to_date("ts").alias("day"))
    jobs = t.events.select("user_id").distinct()
    spine = with_days(jobs, F.lit("2023-12-25"), F.lit("2024-02-04"))
    return missing_days(spine, loaded_days(seen, ["user_id"], "day"), ["user_id", "day"])


@query(
    "page_plan",
    """
    WITH j AS (SELECT l_returnflag AS tbl, CAST(date_trunc('year', l_shipdate) AS DATE) AS day, count(*) AS n
               FROM lineitem GROUP BY 1, 2)
    SELECT tbl, p.start AS dstart,
           'https://host.example/list/' || tbl || '?startTime=' || strftime(day, '%Y-%m-%d') || '&endTime='
           || strftime(day, '%Y-%m-%d') || '&start=' || p.start || '&limit=1000' AS url
    FROM j, LATERAL (SELECT unnest(range(0, n, 1000)) AS start) p
    """,
)
def page_plan(t: Tables) -> DataFrame:
    jobs = t.lineitem.groupBy(
        F.col("l_returnflag").alias("tbl"), F.trunc("l_shipdate", "year").alias("day")
    ).agg(F.count(F.lit(1)).alias("n"))
    paged = with_pages(jobs, "n", block=4)
    path = F.concat(F.lit("list/"), "tbl")
    url = fill_template(F.lit(TEMPLATE), day_label(F.col("day")), F.col("dstart"), F.lit(1000), path)
    return paged.select("tbl", "dstart", url.alias("url"))
