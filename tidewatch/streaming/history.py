"""The latest requests of each server, kept as keyed state of a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewatch.operators.rpclog import HISTORY
from tidewatch.sources.sinks import exists

_ROW = "server string, at long, tie long, request string"


def latest(requests: DataFrame, n: int = HISTORY) -> DataFrame:
    """The latest `n` requests of every server that a micro-batch names: `server`, `at`, `tie`, `request`, `age` (1 is the newest).

    `requests` is a stream of `server`, `at` (microseconds), `tie` and `request`. State holds `n` rows a server, whatever came in
    which order. Tasks keep the latest `n` of each server of what they read before anything is shuffled, so a server with very many
    requests sends few. Rows that are newest together go by `tie`; a request that comes twice counts twice. A null server is one too.
    """

    def pruned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            newest = batch.sort_values(["at", "tie"], ascending=False, kind="stable")
            yield newest.groupby("server", dropna=False, sort=False).head(n)

    def keep(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = [pd.DataFrame(dict(zip(("at", "tie", "request"), state.get, strict=True)))] if state.exists else []
        rows = pd.concat([*held, *(b[["at", "tie", "request"]] for b in batches)], ignore_index=True)
        rows = rows.sort_values(["at", "tie"], ascending=False, kind="stable").head(n)
        state.update((rows["at"].tolist(), rows["tie"].tolist(), rows["request"].tolist()))
        yield rows.assign(server=key[0], age=range(1, len(rows) + 1))[["server", "at", "tie", "request", "age"]]

    few = requests.select("server", "at", "tie", "request").mapInPandas(pruned, _ROW)
    return few.groupBy("server").applyInPandasWithState(
        keep, f"{_ROW}, age long", "at array<bigint>, tie array<bigint>, request array<string>", "update", GroupStateTimeout.NoTimeout
    )


def follow(requests: DataFrame, path: str, checkpoint: str, n: int = HISTORY) -> StreamingQuery:
    """Keep the history of what has come since the last run at `path`, a folder per micro-batch, then stop. A batch that is repeated
    replaces its first attempt."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return latest(requests, n).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def history(spark: SparkSession, path: str) -> DataFrame:
    """The latest requests of every server: those of the last micro-batch that named it."""
    fields = f"{_ROW}, age long, batch long"
    if not exists(spark, path):
        return spark.createDataFrame([], fields).drop("batch")
    rows = spark.read.schema(fields).parquet(path)
    last = rows.groupBy("server").agg(F.max("batch").alias("_last")).withColumnRenamed("server", "_server")
    met = rows.join(last, F.col("server").eqNullSafe(F.col("_server")) & (F.col("batch") == F.col("_last")))
    return met.select("server", "at", "tie", "request", "age")
