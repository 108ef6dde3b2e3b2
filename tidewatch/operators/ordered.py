"""Order-dependent operators that survive one key holding most of the rows.

A window partitioned by the key alone puts a whole key into one task. Here the order column (a
non-negative integer, such as a line number) is cut into chunks. Windows run inside (key, chunk),
and only one summary row per chunk takes part in the window over the whole key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.joins import BROADCAST_KEYS, null_safe_join

CHUNK = 8192


def chunk_of(order: str, size: int = CHUNK) -> Column:
    return F.expr(f"`{order}` div {size}")


def _in_chunks(df: DataFrame, order: str, size: int) -> DataFrame:
    return df if "_chunk" in df.columns else df.withColumn("_chunk", chunk_of(order, size))


def chunk_carry(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    exprs: Mapping[str, Column],
    extra: Sequence[Column] = (),
    size: int = CHUNK,
) -> DataFrame:
    """Per key and chunk, the last non-null value of each expression in the chunks before it.

    The result has one row per chunk: keys, `_chunk`, the values as `_c_<name>`, and the extra
    aggregates over the chunk itself.
    """
    df = _in_chunks(df, order, size)
    last = [
        F.max(F.when(e.isNotNull(), F.struct(F.col(order), e.alias("v")))).alias(f"_s_{n}") for n, e in exprs.items()
    ]
    per_chunk = df.groupBy(*keys, "_chunk").agg(*last, *extra)
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.last(f"_s_{n}", True).over(before)["v"].alias(f"_c_{n}") for n in exprs]
    plain = [c for c in per_chunk.columns if not c.startswith("_s_")]
    return per_chunk.select(*plain, *carried)


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    current: Mapping[str, Column] | None = None,
    previous: Mapping[str, Column] | None = None,
    carry: DataFrame | None = None,
    size: int = CHUNK,
) -> DataFrame:
    """Last non-null value of each expression along `order` within `keys`.

    `current` looks at rows up to and including the row itself, `previous` only at earlier rows.
    The result has `_chunk` too, and is left hash-partitioned by (keys, `_chunk`): rows are shuffled once
    for the join, which hashes the few carried rows, and the windows. `carry` may hand in the result of
    `chunk_carry` for the same expressions. A `df` that has its `_chunk` keeps it: dealt out by (keys, `_chunk`) and sorted by
    these and `order`, it is neither shuffled nor sorted again.
    """
    current, previous = dict(current or {}), dict(previous or {})
    exprs = {**current, **previous}
    if carry is None:
        carry = chunk_carry(df, keys, order, exprs, size=size)
    place = [*keys, "_chunk"]
    states = [F.col(f"_c_{n}") for n in exprs]
    kept = [c for c in df.columns if c != "_chunk"]
    joined = (
        _in_chunks(df, order, size)
        .join(carry.select(*place, *states).hint("shuffle_hash"), place)
        .select(*kept, "_chunk", *states, *[e.alias(f"_e_{n}") for n, e in exprs.items()])
    )
    within = Window.partitionBy(*place).orderBy(order)
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    ahead = within.rowsBetween(Window.unboundedPreceding, -1)
    filled = [
        F.coalesce(F.last(f"_e_{n}", True).over(upto if n in current else ahead), F.col(f"_c_{n}")).alias(n)
        for n in exprs
    ]
    return joined.select(*kept, "_chunk", *filled)


def concat_ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    text: str,
    out: str,
    sep: str = "\n",
    size: int = 4096,
    keep: Column | None = None,
) -> DataFrame:
    """Texts of each key joined along `order`, a distinct number per text of a key; `keep` filters them.

    Keys whose numbers reach `size` are looked up first, in a scan of the order column alone. Without
    any, one aggregation joins at most `size` texts per key. Long keys are joined per chunk, and then
    from one text per chunk.
    """
    keys = list(keys)

    def joined(rows: DataFrame, by: str, column: str, *place: str) -> DataFrame:
        text_of = F.expr(f"listagg(`{column}`, {sep!r}) within group (order by `{by}`)")
        return rows.groupBy(*keys, *place).agg(text_of.alias(out))

    long = df.filter(F.col(order) >= size).select(*keys).distinct()
    n_long = long.limit(BROADCAST_KEYS + 1).count()
    df = df if keep is None else df.filter(keep)
    if n_long == 0:
        return joined(df, order, text)
    if n_long <= BROADCAST_KEYS:
        long = F.broadcast(long)
    short = joined(null_safe_join(df, long, keys, "left_anti"), order, text)
    rows = null_safe_join(df, long, keys, "left_semi").withColumn("_chunk", chunk_of(order, size))
    return short.unionByName(joined(joined(rows, order, text, "_chunk"), "_chunk", out))
