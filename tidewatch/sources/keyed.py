"""Tables stored by key: bucketed and sorted once, so that joins on the key shuffle neither side."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_keyed(table: DataFrame, path: str, key: str, buckets: int) -> None:
    """`table` as Parquet at `path`, in buckets of `key` that are sorted by it. Its name in the catalog lives for the call only."""
    name = f"tidewatch_keyed_{uuid.uuid4().hex}"
    rows = table.repartition(buckets, key)
    rows.write.format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    table.sparkSession.sql(f"DROP TABLE {name}")


def read_keyed(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """The table of `write_keyed`, by any session that knows its key and buckets, with the layout that joins make use of."""
    name = f"tidewatch_keyed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'")
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def store_monitoring(tables: dict[str, DataFrame], path: str, buckets: int) -> dict[str, DataFrame]:
    """Monitoring tables with alerts and events, the large two, stored by event, so that alerts find their events without a shuffle."""
    out = dict(tables)
    for name in ("alerts", "events"):
        write_keyed(tables[name], f"{path}/{name}", "eventid", buckets)
        out[name] = read_keyed(tables[name].sparkSession, f"{path}/{name}", tables[name].schema, "eventid", buckets)
    return out
