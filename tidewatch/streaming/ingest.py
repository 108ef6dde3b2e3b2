"""Incremental ingest of landed rows, safe to run again."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators.coerce import coerce_by_suffix, ip_columns
from tidewatch.operators.geo import geo_enrich
from tidewatch.operators.joins import broadcast_if_short
from tidewatch.session import checkpointed
from tidewatch.sources.landed import envelope_variants, row_keys, spread_keys
from tidewatch.sources.sinks import INPUT_KEYS, loaded_inputs, loaded_partitions, register_inputs, with_partitions, write_index


def prepare(
    rows: DataFrame, table: str, day: str, exclude: Sequence[str] = (), offset_hours: int = 8, ranges: DataFrame | None = None
) -> DataFrame:
    """Typed rows with partition columns, and the places of their addresses if `ranges` is given. `day` names the column with
    the local day."""
    typed = coerce_by_suffix(rows, (day, *exclude), offset_hours)
    if ranges is not None:
        typed = geo_enrich(typed, ip_columns(typed, exclude), ranges)
    return with_partitions(typed, F.lit(table), F.col(day), offset_hours)


def prepare_answers(
    answers: DataFrame,
    table: str,
    day: str,
    field: str = "result",
    exclude: Sequence[str] = (),
    ranges: DataFrame | None = None,
    offset_hours: int = 8,
) -> DataFrame:
    """Rows of answers (`value`) with a column for every key that any of them has, then as `prepare`. `day` is the key of the
    local day. Objects and arrays stay what they are, in variant columns. A row without a readable day has null partitions, and
    `_row_id`, by which loads know it. Serves whole loads and micro-batches alike."""
    rows = checkpointed(envelope_variants(answers, "value", field))
    keys = row_keys(rows)
    wide = spread_keys(rows, keys)
    if day not in wide.columns:
        wide = wide.withColumn(day, F.lit(None).cast("string"))
    dated = wide.withColumn(day, F.col(day).try_cast("date"))
    known = dated.withColumn("_row_id", F.when(F.col(day).isNull(), F.col("_row_id")))
    return prepare(known, table, day, (*exclude, "_row_id"), offset_hours, ranges)


def not_yet_loaded(batch: DataFrame, path: str, name: str) -> DataFrame:
    """Rows of a micro-batch whose files (`INPUT_KEYS`) no other batch of the index table at `path` has taken.

    The files of the batch are few and are compared first; rows are filtered only if some are known.
    """
    spark = batch.sparkSession
    known = batch.select(*INPUT_KEYS).distinct().join(loaded_inputs(spark, path, name), list(INPUT_KEYS), "left_semi")
    known = checkpointed(known)
    if known.isEmpty():
        return batch
    return batch.join(broadcast_if_short(known), list(INPUT_KEYS), "left_anti").select(*batch.columns)


def ingest(
    rows: DataFrame,
    prepare_rows: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    external: Callable[[DataFrame, int], None] | None = None,
    skip_loaded_days: bool = False,
) -> StreamingQuery:
    """Write what has landed since the last run into the index table at `path`, then stop.

    The table is that of `write_index`. A micro-batch is named after the stream, whose id lives in its checkpoint, and its own
    number. So a batch that is repeated after a failure replaces its first attempt, and a stream with another
    checkpoint, whose numbers begin anew, replaces nothing.

    If `rows` names the file of each row (`sinks.with_input`) and `prepare_rows` keeps these columns, files that any other batch has taken are
    left out, whichever checkpoint or stream took them: the table keeps a register of its inputs. A file counts as another one
    if its path or length differs. With `skip_loaded_days`, rows of days that the table already holds from other loads than
    this stream are left out too; a row without a day is kept.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        name, spark = f"stream-{stream}-{batch_id}", batch.sparkSession
        tracked = set(INPUT_KEYS) <= set(batch.columns)
        fresh = not_yet_loaded(batch, path, name) if tracked else batch
        out = prepare_rows(fresh)
        if skip_loaded_days:
            held = loaded_partitions(spark, path).where(~F.col("batch").startswith(f"stream-{stream}-"))
            held = checkpointed(held.select("tbl", "day").distinct())
            out = out.join(broadcast_if_short(held), ["tbl", "day"], "left_anti").select(*out.columns)
        write_index(out, path, name)
        none = spark.createDataFrame([], "input_file string, input_bytes bigint")  # a note even so: the batch is not asked for its inputs later
        register_inputs(fresh.select(*INPUT_KEYS).distinct() if tracked else none, path, name)
        if external is not None:
            external(out, batch_id)

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
