"""Cascaded rollups of samples, kept per step and extended by new samples only."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.vmstats import SERIES

# Steps in seconds, each a multiple of the one before: a minute, half an hour, three hours, twelve hours, a week.
CASCADE = (60, 1800, 10_800, 43_200, 604_800)


def _at(time: Column, step: int) -> Column:
    return time - F.pmod(time, F.lit(step))


def _parts(values: Sequence[str]) -> list[Column]:
    """Sums that can be merged: of a value, how many there are, and the greatest."""
    return [c for v in values for c in (F.sum(f"{v}_sum").alias(f"{v}_sum"), F.sum(f"{v}_n").alias(f"{v}_n"), F.max(f"{v}_max").alias(f"{v}_max"))]


def roll_up(samples: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], steps: Sequence[int] = CASCADE) -> DataFrame:
    """Mergeable sums of samples for every step: `step`, the keys, `time` (epoch seconds, start of the step), and per value `_sum`, `_n`, `_max`.

    Samples are read and shuffled once, for the finest step; each coarser step is made of the sums of the one before it. Hot keys
    are summed per task before any shuffle. A missing value counts for nothing; a step must be a multiple of the one before.
    """
    if any(b % a for a, b in zip(steps, steps[1:])):
        raise ValueError("each step must be a multiple of the one before")
    made = [c for v in values for c in (F.col(v).cast("double").alias(f"{v}_sum"), F.col(v).isNotNull().cast("long").alias(f"{v}_n"), F.col(v).cast("double").alias(f"{v}_max"))]
    rows, levels = samples.select(*keys, F.col(time).alias("time"), *made), []
    for step in steps:
        rows = rows.withColumn("time", _at(F.col("time"), step)).groupBy(*keys, "time").agg(*_parts(values))
        levels.append(rows.withColumn("step", F.lit(step)))
    return reduce(DataFrame.unionByName, levels)


def extend_rollups(samples: DataFrame, path: str, batch: str, keys: Sequence[str], time: str, values: Sequence[str], steps: Sequence[int] = CASCADE) -> None:
    """Add new samples to the rollups at `path`, a folder per step and batch. A batch that is repeated replaces itself; no other sums are
    read or written. The finest sums are written first and the coarser ones made of them, so samples are read once."""
    spark = samples.sparkSession
    rows = roll_up(samples, keys, time, values, steps[:1])
    for n, step in enumerate(steps):
        out = rows.withColumns({"step": F.lit(step), "batch": F.lit(batch)})
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("step", "batch").parquet(path)
        if n + 1 < len(steps):
            if steps[n + 1] % step:
                raise ValueError("each step must be a multiple of the one before")
            own = _read(spark, path, out.schema).where((F.col("step") == step) & (F.col("batch") == batch))
            rows = own.drop("step", "batch").withColumn("time", _at(F.col("time"), steps[n + 1])).groupBy(*keys, "time").agg(*_parts(values))


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    fields = {f.name: f for f in schema.fields} | {"step": T.StructField("step", T.IntegerType()), "batch": T.StructField("batch", T.StringType())}
    return spark.read.schema(T.StructType(list(fields.values()))).parquet(path)


def series(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], values: Sequence[str], step: int, cf: str = "AVERAGE") -> DataFrame:
    """The series of a step from the rollups at `path`: keys, `time`, and the average or greatest of each value. Only that step's
    folders are read. `schema` has the keys, `time` and the sums, as `roll_up` gives them."""
    if cf not in SERIES:
        raise ValueError(f"unknown function {cf!r}; known are {', '.join(SERIES)}")
    sums = _read(spark, path, schema).where(F.col("step") == step).groupBy(*keys, "time").agg(*_parts(values))
    how = {v: F.col(f"{v}_max") if SERIES[cf] == "MAX" else F.try_divide(F.col(f"{v}_sum"), F.col(f"{v}_n")) for v in values}
    return sums.select(*keys, "time", *[c.alias(v) for v, c in how.items()])
