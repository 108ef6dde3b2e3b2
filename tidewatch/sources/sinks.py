"""Writers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from itertools import batched

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.coerce import stamp_eventdate
from tidewatch.operators.firewall import POLICY_COLUMNS, POLICY_HEADERS
from tidewatch.functions.times import day_label, month_label

# Documents per request.
BATCH = 5000
# Partition columns of an index table, before the batch.
INDEX_KEYS = ("tbl", "month", "day")
# Columns that name the file a row came from, and where an index table keeps the files it has taken, beside its rows.
INPUT_KEYS = ("input_file", "input_bytes")
REGISTER = "_inputs"


def with_partitions(df: DataFrame, table: Column, day: Column, offset_hours: int = 8) -> DataFrame:
    """Adds `tbl`, `month` and `day` of the local day, and the stamped `eventdate`."""
    return stamp_eventdate(df, day, offset_hours).withColumns(
        {"tbl": table, "month": month_label(day), "day": day_label(day)}
    )


def write_index(df: DataFrame, path: str, batch: str | None = None, replace_days: bool = False, max_rows: int = 5_000_000) -> None:
    """Add rows to the table at `path`, partitioned by table, month, local day and batch.

    A batch, by default one of a new name, only ever replaces itself: written again under its name, it takes the place of its
    first attempt, and no other load is touched. The rebalance hint gathers each partition's rows before writing and lets
    adaptive execution cut a hot day into several files, so neither many tiny files nor one huge task
    results. `replace_days` then removes all other batches of the days in `df`, which repairs half-loaded days.
    """
    batch = batch or f"load-{uuid.uuid4().hex}"
    rows = df.withColumn("batch", F.lit(batch))
    (
        rows.hint("rebalance", *INDEX_KEYS)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_rows)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*INDEX_KEYS, "batch")
        .parquet(path)
    )
    if replace_days:
        _remove_other_batches(df.sparkSession, path, batch)


def _remove_other_batches(spark: SparkSession, path: str, batch: str) -> None:
    """Delete the folders of other batches in the days that `batch` has rows of."""
    files = spark.read.parquet(path).where(F.col("batch").cast("string") == batch)
    own = files.select(F.regexp_extract("_metadata.file_path", "^(.*)/batch=[^/]*/[^/]*$", 1).alias("day")).distinct()
    jvm = spark.sparkContext._jvm
    for row in own.toLocalIterator():
        day = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row["day"]))
        store = day.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for entry in store.listStatus(day):
            name = entry.getPath().getName()
            if name.startswith("batch=") and name != f"batch={batch}":
                store.delete(entry.getPath(), True)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def has_index(spark: SparkSession, path: str) -> bool:
    """Whether there is a table at `path` yet."""
    return exists(spark, path)


def index_files(spark: SparkSession, path: str, *tables: str) -> DataFrame:
    """Files of an index table with the partition they lie in: `path`, `tbl`, `month`, `day`, `batch`, all as text.

    The folders are listed; no file is opened. A partition without a value is null.
    """
    listed = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.parquet").load(path).select("path")

    def label(key: str) -> Column:
        text = F.regexp_extract("path", f"/{key}=([^/]*)/", 1)
        return F.when(text != "__HIVE_DEFAULT_PARTITION__", F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))).alias(key)

    files = listed.select("path", *[label(k) for k in (*INDEX_KEYS, "batch")])
    return files.where(F.col("tbl").isin(*tables)) if tables else files


def loaded_partitions(spark: SparkSession, path: str, *tables: str) -> DataFrame:
    """Tables, months, days and batches that an index table at `path` holds, from its folders alone; none if there is no table."""
    if not has_index(spark, path):
        return spark.createDataFrame([], "tbl string, month string, day string, batch string")
    return index_files(spark, path, *tables).drop("path").distinct()


def loaded_counts(spark: SparkSession, path: str, *tables: str) -> DataFrame:
    """Rows of each table, month and day of an index table, from its folders and the row counts in the footers of its files."""
    labels = T.StructType([T.StructField(k, T.StringType()) for k in (*INDEX_KEYS, "batch")])
    rows = spark.read.schema(labels).parquet(path)
    chosen = rows.where(F.col("tbl").isin(*tables)) if tables else rows
    return chosen.groupBy(*INDEX_KEYS).agg(F.count(F.lit(1)).alias("n_rows"))


def loaded_undated(spark: SparkSession, path: str, table: str) -> DataFrame:
    """`_row_id` of the rows without a day that an index table holds; only their partitions are read."""
    fields = "_row_id string, " + ", ".join(f"{k} string" for k in (*INDEX_KEYS, "batch"))
    return spark.read.schema(fields).parquet(path).where((F.col("tbl") == table) & F.col("day").isNull()).select("_row_id").distinct()


def with_input(source: DataFrame, *columns: str) -> DataFrame:
    """Columns of a file source, by default all, with the file and its length that each row comes from, as `INPUT_KEYS`."""
    return source.select(*(columns or ["*"]), F.col("_metadata.file_path").alias("input_file"), F.col("_metadata.file_size").alias("input_bytes"))


def register_inputs(inputs: DataFrame, path: str, batch: str) -> None:
    """Note the files (`INPUT_KEYS`) that a batch of the index table at `path` has taken. A repeated batch replaces its note."""
    inputs.coalesce(1).write.mode("overwrite").parquet(f"{path}/{REGISTER}/{batch}")


def loaded_inputs(spark: SparkSession, path: str, batch: str | None = None) -> DataFrame:
    """Files that batches of the index table at `path`, other than `batch`, have taken.

    They are read from the register. A batch that was written but whose note was lost is asked for the files that its rows
    name, which reads its partitions only.
    """
    kind = "input_file string, input_bytes bigint"
    none = spark.createDataFrame([], kind)
    if not has_index(spark, path):
        return none
    noted, own = none.select("*", F.lit(None).cast("string").alias("batch")), F.lit(batch or "")
    if exists(spark, f"{path}/{REGISTER}"):
        notes = spark.read.schema(kind).option("recursiveFileLookup", True).parquet(f"{path}/{REGISTER}")
        noted = notes.select(*INPUT_KEYS, F.regexp_extract("_metadata.file_path", f"/{REGISTER}/([^/]*)/", 1).alias("batch"))
    found = noted.where(F.col("batch") != own).select(*INPUT_KEYS)
    held = index_files(spark, path).select("batch").where((F.col("batch") != own) & F.col("batch").startswith("stream-")).distinct()
    lost = [r["batch"] for r in held.join(noted.select("batch").distinct(), "batch", "left_anti").collect()]  # as many as runs that failed
    if not lost:
        return found
    labels = ", ".join(f"{k} string" for k in (*INDEX_KEYS, "batch"))
    rows = spark.read.schema(f"{kind}, {labels}").parquet(path).where(F.col("batch").isin(*lost))
    return found.unionByName(rows.select(*INPUT_KEYS)).distinct()


def read_index(spark: SparkSession, path: str, *tables: str) -> DataFrame:
    """The table of `write_index`, partition columns as text, with the columns of all its batches."""
    found = spark.read.option("mergeSchema", True).parquet(path).schema
    labels = (*INDEX_KEYS, "batch")
    fields = [T.StructField(f.name, T.StringType()) if f.name in labels else f for f in found]
    rows = spark.read.schema(T.StructType(fields)).parquet(path)
    return rows.where(F.col("tbl").isin(*tables)) if tables else rows


def send_documents(df: DataFrame, send: Callable[[list[Row]], None], size: int = BATCH) -> None:
    """Hand rows to an external sink in slices, from the tasks that hold them."""

    def each(rows: Iterator[Row]) -> None:
        for part in batched(rows, size):
            send(list(part))

    df.foreachPartition(each)


def write_policy_sheet(policies: DataFrame, path: str, compression: str = "none") -> None:
    """The flat policy table as CSV with its fixed ten columns, packed by a codec that CSV readers know, such as `gzip`, if one is named.

    Rows of a rule repeat nearly all of the row before, so the fastest level of packing does.
    """
    named = [F.col(c).alias(POLICY_HEADERS.get(c, c)) for c in POLICY_COLUMNS]
    packed = {"compression": compression, "zlib.compress.level": "BEST_SPEED"}
    policies.select(*named).write.mode("overwrite").options(header=True, **packed).csv(path)


def write_changes(changes: DataFrame, text: Column, path: str) -> None:
    """Changes as statement text, in the order of sheet rows."""
    order = [c for c in ("row_idx", "tbl", "seq", "id") if c in changes.columns]
    changes.orderBy(*order).select(text.alias("value")).write.mode("overwrite").text(path)


def append_records(records: DataFrame, path: str) -> None:
    records.write.mode("append").parquet(path)
