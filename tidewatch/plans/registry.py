"""The list of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from tidewatch.plans.local import ensure_shared_folder

Query = Callable[["Tables"], DataFrame]
MODULES = ("ingest", "backfill", "events", "network", "machines", "hosts", "papers", "models", "requests", "streams", "landing", "stored")

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


class Tables:
    """Tables of one folder, read on first use: `t.orders`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} exists")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return add


def _load() -> None:
    for module in MODULES:
        import_module(f"tidewatch.plans.{module}")


def _runner(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ensure_shared_folder(spark)
        return fn(Tables(spark, folder))

    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: _runner(fn) for name, fn in _QUERIES.items()}


def all_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
