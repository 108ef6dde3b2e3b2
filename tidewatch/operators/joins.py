"""Joins on keys that may be null."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Key lists counted to be at most this long may be broadcast.
BROADCAST_KEYS = 100_000


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which null keys equal each other; the right side's keys are dropped."""
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(right, same, how).drop(*[f"_r_{k}" for k in keys])


def is_short(df: DataFrame) -> bool:
    """Whether `df`, which should be cheap to count, has at most `BROADCAST_KEYS` rows."""
    return df.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS


def broadcast_if_short(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if is_short(df) else df


def small_or_hashed(df: DataFrame) -> DataFrame:
    """`df`, cheap to count, hinted as build side of a join: broadcast if it is short, else hashed per partition."""
    return F.broadcast(df) if is_short(df) else df.hint("shuffle_hash")
