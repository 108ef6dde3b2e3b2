"""Typing of columns by their names, derived columns and document wrapping."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.numbers import comma_int
from tidewatch.functions.times import local_to_utc, month_label, parse_local

# Headers of flow files and their short names.
FLOW_NAMES = {
    "设备编号": "dev",
    "协议名称": "xyname",
    "起始时间": "starttime",
    "结束时间": "endtime",
    "源地址": "sip",
    "源端口": "sport",
    "目标地址": "dip",
    "目标端口": "dport",
    "域名": "domain",
    "上行流量": "upcount",
    "下行流量": "downcount",
    "运营商": "op",
    "地理位置": "geoloc",
    "NAT地址": "natip",
    "NAT端口": "napport",
    "用户账号": "user",
}

COUNT_SUFFIXES = ("count", "port")
TIME_SUFFIX = "time"
IP_SUFFIX = "ip"


def rename_headers(df: DataFrame, names: Mapping[str, str] = FLOW_NAMES) -> DataFrame:
    """Short names for known headers; other columns are kept."""
    return df.withColumnsRenamed(dict(names))


def column_kind(name: str) -> str | None:
    """`count`, `time`, `ip` or None. The address suffix alone is case-sensitive."""
    low = name.lower()
    if low.endswith(COUNT_SUFFIXES):
        return "count"
    if low.endswith(TIME_SUFFIX):
        return "time"
    return "ip" if name.endswith(IP_SUFFIX) else None


def ip_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [c for c in df.columns if c not in skip and column_kind(c) == "ip"]


def _typed(field: T.StructField, offset_hours: int) -> Column | None:
    kind, c = column_kind(field.name), F.col(f"`{field.name}`")
    if kind == "count":
        return comma_int(c) if isinstance(field.dataType, T.StringType) else c.try_cast("bigint")
    if kind == "time" and isinstance(field.dataType, T.StringType):
        return parse_local(c, offset_hours)
    if kind == "time" and isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return local_to_utc(c, offset_hours)
    return None


def coerce_by_suffix(
    df: DataFrame, exclude: Iterable[str] = (), offset_hours: int = 8, strict: bool = False
) -> DataFrame:
    """Type every column by the ending of its name, in one projection.

    Endings match inside longer words too (`discount`, `runtime`); list such columns in `exclude`.
    A row with unreadable values is kept, and `_errors` names the columns; `strict` raises instead. Numbers
    that are not finite or too large for a count are unreadable like text.
    """
    skip, selected, failed = set(exclude), [], []
    for field in df.schema.fields:
        raw = F.col(f"`{field.name}`")
        typed = None if field.name in skip else _typed(field, offset_hours)
        if typed is None:
            selected.append(raw)
            continue
        bad = raw.isNotNull() & typed.isNull()
        if strict:
            message = F.concat(F.lit(f"unreadable {field.name}: "), raw.cast("string"))
            typed = F.when(bad, F.raise_error(message).cast("string").cast(_type_of(field))).otherwise(typed)
        else:
            failed.append(F.when(bad, F.lit(field.name)))
        selected.append(typed.alias(field.name))
    if not strict:
        names = F.array_compact(F.array(*failed)) if failed else F.array()
        selected.append(names.cast("array<string>").alias("_errors"))
    return df.select(*selected)


def _type_of(field: T.StructField) -> str:
    if column_kind(field.name) == "count":
        return "bigint"
    return "timestamp" if isinstance(field.dataType, T.TimestampType) else "timestamp_ntz"


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without and with entries in `_errors`."""
    bad = F.size("_errors") > 0
    return df.filter(~bad).drop("_errors"), df.filter(bad)


def stamp_eventdate(df: DataFrame, day: Column, offset_hours: int = 8) -> DataFrame:
    """`eventdate`: the start of the local day, in UTC."""
    return df.withColumn("eventdate", local_to_utc(day.cast("timestamp_ntz"), offset_hours))


def index_name(day: Column, table: Column | None = None, prefix: str = "waf_") -> Column:
    """Monthly index of a local day: `<prefix><table>-YYYY.MM`, or `<prefix>-YYYY.MM` without table."""
    parts = [F.lit(prefix)] + ([table] if table is not None else [])
    return F.concat(*parts, F.lit("-"), month_label(day))


def merge_columns(df: DataFrame, derived: Mapping[str, Column]) -> DataFrame:
    """Add derived columns; a derived column replaces one of the same name."""
    return df.withColumns(dict(derived))


def wrap_documents(df: DataFrame, index: Column, doc_type: Column, drop: Iterable[str] = ()) -> DataFrame:
    """Rows as `_index`, `_type`, `_source`."""
    hidden = set(drop)
    source = F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in hidden])
    return df.select(index.alias("_index"), doc_type.alias("_type"), source.alias("_source"))
