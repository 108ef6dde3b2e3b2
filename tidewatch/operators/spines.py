"""Days and pages to fetch, less what is loaded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE = 1000


def with_days(jobs: DataFrame, first: Column, as_of: Column, out: str = "day") -> DataFrame:
    """Every job once per day, from the day before `as_of` back to `first`; none if that is later."""
    newest = F.date_sub(as_of.cast("date"), 1)
    first = first.cast("date")
    days = F.sequence(newest, F.least(first, newest), F.expr("interval -1 day"))
    return jobs.withColumn(out, F.explode(F.when(first <= newest, days)))


def loaded_days(target: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Rows per key and day. A day with any row counts as loaded."""
    return target.groupBy(*keys, day).agg(F.count(F.lit(1)).alias("n_rows"))


def missing_days(spine: DataFrame, loaded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Spine rows without a loaded counterpart. `keys` includes the day."""
    return spine.join(loaded.select(*keys).distinct(), list(keys), "left_anti")


def with_pages(jobs: DataFrame, count: str, limit: int = PAGE, out: str = "dstart", block: int = 10_000) -> DataFrame:
    """Every job once per page offset `0, limit, 2*limit, ...` below its row count.

    Offsets are made in two steps, blocks of pages and pages, and spread in between. A job with very
    many pages thus never sits in one array or one task.
    """
    pages = F.ceil(F.col(count) / limit).cast("bigint")
    blocks = F.when(F.col(count) > 0, F.sequence(F.lit(0), F.floor((pages - 1) / block).cast("bigint")))
    wide = jobs.withColumn("_block", F.explode(blocks)).hint("rebalance")
    start = F.col("_block") * block
    inside = F.sequence(start, F.least(start + block, pages) - 1)
    return (
        wide.withColumn("_page", F.explode(inside)).withColumn(out, F.col("_page") * limit).drop("_block", "_page")
    )
