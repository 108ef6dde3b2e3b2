"""Tables kept by day, or by another label of their clock: changes and retention that only touch the days they fall on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.joins import broadcast_if_short
from tidewatch.operators.repair import STEP_SECONDS, apply_changes, retention_cutoff
from tidewatch.session import checkpointed

DAY = "day"
# How a day is written. A coarser label, such as `yyyy-MM`, keeps long histories in fewer folders; labels must sort like clocks.
LABEL = "yyyy-MM-dd"
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _day_of(clock: str, label: str) -> Column:
    """UTC day of an epoch second, as text."""
    return F.date_format(F.timestamp_seconds(F.col(clock)), label)


def write_days(table: DataFrame, path: str, clock: str = "clock", label: str = LABEL) -> None:
    """`table` below `path`, a folder for each UTC day of its clock; a folder that exists is replaced, others stay."""
    rows = table.withColumn(DAY, _day_of(clock, label)).hint("rebalance", DAY)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def read_days(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table of `write_days` with its `day`, the schema being that of the rows."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(DAY, T.StringType())])).parquet(path)


def _folders(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = {s.getPath().getName().removeprefix(f"{DAY}="): s.getPath() for s in store.listStatus(place) if s.getPath().getName().startswith(f"{DAY}=")}
    return store, found


def stored_days(spark: SparkSession, path: str) -> list[str]:
    """Days that the table has folders of, in order; rows without a clock lie in none of them."""
    return sorted(set(_folders(spark, path)[1]) - {_NO_DAY})


def _rewrite(spark: SparkSession, path: str, rows: DataFrame, days: list[str], clock: str, label: str) -> None:
    """Replace the folders of `days` by `rows`, which lie on these days only. A day without rows loses its folder last."""
    rows = checkpointed(rows)
    kept = {r[DAY] for r in rows.select(F.coalesce(_day_of(clock, label), F.lit(_NO_DAY)).alias(DAY)).distinct().collect()}
    write_days(rows, path, clock, label)
    store, found = _folders(spark, path)
    for day in set(days) - kept:
        if day in found:
            store.delete(found[day], True)


def change_days(
    spark: SparkSession, path: str, schema: T.StructType, changes: DataFrame, tbl: str, id_col: str, clock: str = "clock", label: str = LABEL
) -> list[str]:
    """`apply_changes` to the table of `write_days` at `path`: gives the days whose folders were written anew.

    These are the days on which changed rows lie, found by their ids alone, and the days to which new clocks move them. The
    files of all other days stay as they are.
    """
    own = checkpointed(changes.where(F.col("tbl") == tbl))
    ids = own.select(F.col("id").alias(id_col)).distinct()
    table = read_days(spark, path, schema)
    held = table.select(id_col, DAY).join(broadcast_if_short(ids), id_col, "left_semi").select(F.coalesce(DAY, F.lit(_NO_DAY)).alias(DAY))
    there = {r[DAY] for r in held.distinct().collect()}
    if not there:
        return []
    moved = own.where("action = 'update' AND new_clock IS NOT NULL").join(table.select(F.col(id_col).alias("id")), "id", "left_semi")
    days = sorted(there | {r[DAY] for r in moved.select(_day_of("new_clock", label).alias(DAY)).distinct().collect()})
    touched = table.where(F.coalesce(DAY, F.lit(_NO_DAY)).isin(days)).drop(DAY)
    _rewrite(spark, path, apply_changes(touched, own, tbl, id_col), days, clock, label)
    return days


def drop_old_days(
    spark: SparkSession, path: str, schema: T.StructType, end: Column, clock: str = "clock", step: int = STEP_SECONDS, label: str = LABEL
) -> list[str]:
    """`repair.retained` on the table of `write_days`: gives the days that went or were written anew.

    Days wholly below the cutoff lose their folders unread, the cutoff's own day is written anew, and later days are not touched.
    The first clock is read from the first day alone. Rows without a clock stay.
    """
    days = stored_days(spark, path)
    if not days:
        return []
    table = read_days(spark, path, schema)
    first = table.where(F.col(DAY) == days[0]).agg(F.min(clock).alias("first"))
    cutoff, border = first.select(retention_cutoff(F.col("first"), end, step).alias("c")).select("c", _day_of("c", label)).first()
    if cutoff is None:
        return []
    gone = [d for d in days if d < border]
    if border in days:
        _rewrite(spark, path, table.where((F.col(DAY) == border) & (F.col(clock) >= cutoff)).drop(DAY), [border], clock, label)
    store, found = _folders(spark, path)
    for day in gone:
        store.delete(found[day], True)
    return [*gone, *([border] if border in days else [])]
