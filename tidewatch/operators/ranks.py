"""Exact values at given positions of sorted groups, whatever the size of a group.

Groups up to `hot_rows` rows are sorted as arrays. For larger ones, equal values are counted first; a
histogram over logarithmic buckets finds the bucket that holds a position, a second one over equal
steps narrows it, and only the values left are sorted. A group of any size thus sends a bounded number
of rows to one task: the buckets of a histogram, or about 2^24 distinct values (a log bucket spans about
2^40 doubles, a step of it 2^24).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.joins import BROADCAST_KEYS, null_safe_join

PER_OCTAVE = 4096
STEPS = 65536
_SHIFT = 1 << 25
HOT_ROWS = 1 << 17

Positions = Mapping[str, Callable[[Column], Column]]


def _log_bucket(v: Column) -> Column:
    """A bucket number that never falls as the value grows. NaN sorts last.

    Never null, so that joins on it add no filter and plans can share the counted values.
    """
    up = (F.floor(F.log2(v) * PER_OCTAVE) + _SHIFT).cast("bigint")
    down = -(F.floor(F.log2(-v) * PER_OCTAVE) + _SHIFT).cast("bigint")
    bucket = (
        F.when(F.isnan(v), F.lit(1 << 40))
        .when(v > 1.7e308, F.lit(1 << 39))
        .when(v < -1.7e308, F.lit(-(1 << 39)))
        .when(v > 0, up)
        .when(v < 0, down)
    )
    return F.coalesce(bucket.cast("bigint"), F.lit(0).cast("bigint"))


def _step(v: Column, lo: Column, hi: Column) -> Column:
    width = hi - lo
    narrow = (width > 0) & (width < 1.7e308)
    step = F.when(narrow, F.floor((v - lo) / width * (STEPS - 1))).cast("bigint")
    return F.coalesce(step, F.lit(0).cast("bigint"))


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows per key and value: `_k` (the keys as one struct), `_v`, `_c`. Missing values are counted too.

    Equal values fold before the shuffle, which is by key and value and so spreads a hot key. Keys are
    held in a struct because structs with null fields still join.
    """
    pairs = df.select(F.struct(*keys).alias("_k"), F.col(value).cast("double").alias("_v"))
    return pairs.groupBy("_k", "_v").agg(F.count(F.lit(1)).alias("_c"))


def _running(part: Sequence[str], by: str) -> Column:
    """Rows counted before the current one."""
    w = Window.partitionBy(*part).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_c").over(w), F.lit(0))


def _histogram(rows: DataFrame, part: Sequence[str]) -> DataFrame:
    """Rows, value range and rows before, per bucket `_b`."""
    sizes = rows.groupBy(*part, "_b").agg(
        F.sum("_c").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    return sizes.withColumn("_before", _running(part, "_b"))


def values_in_counts(counts: DataFrame, positions: Positions) -> DataFrame:
    """One row per `_k` of `value_counts`: the non-null values at 0-based positions of their sorted order.

    A position is a function of the number of non-null values. Past the end the result is null; a key
    with no position in range has no row.
    """
    v = F.col("_v")
    counts = counts.filter(v.isNotNull()).withColumn("_b", _log_bucket(v))
    holds = (F.col("_pos") >= F.col("_before")) & (F.col("_pos") < F.col("_before") + F.col("_c"))

    n = F.col("_n")
    wanted = F.array(
        *[F.struct(F.lit(name).alias("name"), at(n).cast("bigint").alias("pos")) for name, at in positions.items()]
    )
    rough = (
        _histogram(counts, ["_k"])
        .withColumn("_n", F.sum("_c").over(Window.partitionBy("_k")))
        .withColumn("_w", F.explode(wanted))
        .withColumns({"_name": F.col("_w.name"), "_pos": F.col("_w.pos")})
        .filter(holds)
        .select("_k", "_b", "_name", "_pos", F.col("_lo").alias("_lo0"), F.col("_hi").alias("_hi0"), F.col("_before").alias("_base"))
    )

    part = ["_k", "_name"]
    near = counts.join(rough, ["_k", "_b"]).select(
        *part, "_pos", "_base", _step(v, F.col("_lo0"), F.col("_hi0")).alias("_b"), "_v", "_c"
    )
    fine = (
        _histogram(near, [*part, "_pos", "_base"])
        .withColumn("_before", F.col("_before") + F.col("_base"))
        .filter(holds)
        .select(*part, "_b", F.col("_before").alias("_start"))
    )
    last = near.join(fine, [*part, "_b"]).withColumn("_before", _running(part, "_v") + F.col("_start"))
    picked = {name: F.max(F.when(F.col("_name") == name, v)).alias(name) for name in positions}
    return last.filter(holds).groupBy("_k").agg(*picked.values())


def _values_in_rows(rows: DataFrame, keys: Sequence[str], value: str, positions: Positions) -> DataFrame:
    values = F.sort_array(F.collect_list(F.col(value).cast("double"))).alias("_vs")
    picked = [F.get("_vs", at(F.size("_vs")).cast("int")).alias(name) for name, at in positions.items()]
    return rows.groupBy(*keys).agg(values).select(*keys, *picked)


def values_at(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    positions: Positions,
    sizes: DataFrame,
    n: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per key: the non-null values at 0-based positions of their sorted order, null past the end.

    A position is a function of the number of non-null values, which `sizes` gives per key in column
    `n`. `sizes` should be cheap to read again (checkpointed), as hot keys are looked up in it first;
    usually there are none, and the plan has one shuffle.
    """
    keys = list(keys)
    rows = rows.filter(F.col(value).isNotNull())
    hot = sizes.filter(F.col(n) > hot_rows).select(*keys)
    n_hot = hot.count()
    if n_hot == 0:
        return _values_in_rows(rows, keys, value, positions)
    if n_hot <= BROADCAST_KEYS:
        hot = F.broadcast(hot)
    cool = _values_in_rows(null_safe_join(rows, hot, keys, "left_anti"), keys, value, positions)
    counts = value_counts(null_safe_join(rows, hot, keys, "left_semi"), keys, value)
    found = values_in_counts(counts, positions)
    return cool.unionByName(found.select(*[F.col(f"_k.{k}") for k in keys], *positions))
