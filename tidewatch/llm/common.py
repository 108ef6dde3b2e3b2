"""Shared parts: Arrow batches of bounded size, row keys, cuts of long texts, checkpoints."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import shared_folder, work_path

# Rows and bytes of one Arrow batch handed to a Python worker.
BATCH_ROWS = 1024
BATCH_BYTES = 4 << 20
# Rows of ids and keys, about 50 bytes each in a task, that may be sent to all tasks.
MOST_SENT = 500_000

# A single space between two characters that are neither a space nor SentencePiece's mark for one.
SAFE_CUT = re.compile("(?<=[^\\s▁]) (?=[^\\s▁])")


def bounded_batches(spark: SparkSession) -> None:
    """Bound the batches of Arrow functions by rows and by bytes; one longer row is a batch of its own."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def sent_by_value(spark: SparkSession, value):
    """A broadcast of the pickled value with its class, for workers without this package; `pickle.loads` restores it."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def saved(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder of the cluster, so that later uses read it instead of making it anew."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written as Parquet to the shared folder: for many rows, smaller than a checkpoint."""
    path = work_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hashable(value: Column, kind: T.DataType) -> Column:
    """`value` with its maps as lists of entries by key and its variants as text, as neither can be hashed."""
    if isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.struct(_hashable(e["key"], kind.keyType), _hashable(e["value"], kind.valueType)))
        return F.array_sort(entries)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _hashable(x, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*[_hashable(value[f.name], f.dataType) for f in kind.fields]))
    return F.to_json(value) if isinstance(kind, T.VariantType) else value


def row_key(df: DataFrame) -> Column:
    """A number made of all columns of a row: equal rows have equal keys, whatever the order of their maps."""
    told = {f.name: f.dataType for f in df.schema.fields}
    odd = {c: kind for c, kind in told.items() if any(word in kind.simpleString() for word in ("map<", "variant"))}
    return F.xxhash64(*[_hashable(F.col(f"`{c}`"), odd[c]) if c in odd else F.col(f"`{c}`") for c in sorted(told)])


def sent_if_few(rows: DataFrame) -> DataFrame:
    """`rows`, cheap to count, for a join: sent to all tasks if they are `MOST_SENT` at most, else as they are."""
    return F.broadcast(rows) if rows.limit(MOST_SENT + 1).count() <= MOST_SENT else rows


def without_rows(df: DataFrame, dropped: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of `df` but for those whose id and `row_key` are in `dropped` (columns `id`, `key`).

    The dropped keys are written first. If they are few, the rows of `df` are not shuffled.
    """
    keyed = df.withColumn("_tw_key", row_key(df))
    gone = sent_if_few(saved(dropped.select(F.col("id").alias("_tw_gone_id"), F.col("key").alias("_tw_gone_key"))))
    same = F.col(id_col).eqNullSafe(F.col("_tw_gone_id")) & (F.col("_tw_key") == F.col("_tw_gone_key"))
    return keyed.join(gone, same, "left_anti").drop("_tw_key")


def raw_texts(texts: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text, null as empty, without making Python strings."""
    return (b if b is not None else b"" for b in texts.cast(pa.binary()).to_pylist())


def safe_pieces(text: str, limit: int, drop_space: bool = False) -> Iterator[str]:
    """Cut a text at spaces between words into pieces of about `limit` characters.

    The space belongs to the piece behind the cut, or to none with `drop_space`. A run without such a
    space stays whole.
    """
    at = 0
    while len(text) - at > limit:
        cut = SAFE_CUT.search(text, at + limit)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.end() if drop_space else cut.start()
    yield text[at:]


def piece_calls(texts: list[str], limit: int | None, call_bytes: int, drop_space: bool = False) -> Iterator[tuple[list[str], list[int]]]:
    """Pieces of the texts with the row of each, packed into calls of about `call_bytes` bytes. No limit: uncut."""
    pieces, rows, size = [], [], 0
    for row, text in enumerate(texts):
        for piece in safe_pieces(text, limit, drop_space) if limit else (text,):
            pieces.append(piece)
            rows.append(row)
            size += len(piece.encode())
            if size >= call_bytes:
                yield pieces, rows
                pieces, rows, size = [], [], 0
    if pieces:
        yield pieces, rows
