"""Readers. Remote systems are read through what they landed: files, tables, or a JDBC query."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.coerce import FLOW_NAMES
from tidewatch.operators.joins import small_or_hashed
from tidewatch.session import checkpointed

# Most keys that the rows of a table may have.
MOST_KEYS = 10_000

_PLACES = "lon double, lat double, country_name string, country_name_zh string, country_iso_code string, city_name_en string, city_name_zh string, region_code string, region_zh string"

# Columns of the landed tables.
SCHEMAS = {
    "etl_jobs": "httpurl string, tblname string, purl string",
    "alerts": "alertid bigint, eventid bigint, clock bigint",
    "events": "eventid bigint, objectid bigint, clock bigint",
    "triggers": "triggerid bigint",
    "functions": "triggerid bigint, itemid bigint",
    "items": "itemid bigint, hostid bigint, key_ string",
    "hosts": "hostid bigint, name string",
    "proxy_history": "id bigint, clock bigint",
    "geo_ranges": f"start_ip bigint, end_ip bigint, {_PLACES}",
    "geo_ranges6": f"start_ip string, end_ip string, {_PLACES}",
    "vms": "vm_id bigint, name string, node string, type string, status string",
    "vm_volumes": "vm_id bigint, key string, value string",
    "vm_config": "vm_id bigint, smbios1 string",
    "rrd": (
        "vm_id bigint, time bigint, cpu double, diskread double, diskwrite double,"
        " netin double, netout double"
    ),
    "desired_hosts": (
        "row_idx bigint, status string, cpu string, mem string, host string, name string,"
        " grp string, nc_id string, ip string, pip string"
    ),
    "actual_hosts": "hostid string, host string, name string, template_ids array<string>",
    "actual_groups": "groupid string, name string",
    "repair_sheet": "row_idx bigint, name string, op string, ud1 timestamp_ntz, ud2 timestamp_ntz",
    "keep_names": "row_idx bigint, name string",
    "doc_paras": "doc_id bigint, pos bigint, text string",
    "doc_cells": "doc_id bigint, table_no int, r int, c int, text string",
    "doc_images": "doc_id bigint, pos int, content binary",
    "model_fields": "model string, field_name string, seq bigint",
    "catalog": "name string, type string, url string",
    "rpc_log": "server string, ts timestamp, request string, response string, prio string",
}


def _strings(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _headers(spark: SparkSession, folder: str, sep: str, encoding: str) -> DataFrame:
    """First line of each file of a folder, cut at the separator: `_file`, `header`.

    One pass over the lines, of which each task keeps the first of a file.
    """
    lines = spark.read.options(sep="\x00", encoding=encoding, header=False, quote="").schema("value string").csv(folder)
    first = lines.where(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_at"), "value"
    )
    top = first.groupBy("_file").agg(F.min_by("value", "_at").alias("value"))
    clean = F.regexp_replace(F.coalesce("value", F.lit("")), "^\ufeff|\r$", "")
    return top.select("_file", F.transform(F.split(clean, sep), lambda c: F.trim(F.btrim(c, F.lit('"')))).alias("header"))


def read_headed_files(spark: SparkSession, folder: str, names: Iterable[str], sep: str, encoding: str) -> DataFrame:
    """Text files with a header line, all columns as text, bound by the names in it, with the `_file` of each row.

    Layouts may differ between files, in order, with missing and with further columns: a missing column is null, a further
    one is kept. Files of equal headers are read together, so there are as many reads as layouts. Of equal headers in a
    file the first counts. Only the files of the folder itself are read. A file without header or rows gives none.
    """
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    layouts = _headers(spark, folder, sep, encoding).groupBy("header").agg(F.sort_array(F.collect_list("_file")).alias("files"))
    out = spark.createDataFrame([], _strings((*names, "_file")))
    for layout in layouts.orderBy(F.array_join("header", "\x01")).collect():
        header: dict[str, int] = {}
        for i, name in enumerate(layout["header"]):
            if name:
                header.setdefault(name, i)
        places = _strings(f"_{i}" for i in range(len(layout["header"])))
        rows = spark.read.options(header=True, sep=sep, encoding=encoding).schema(places).csv([unquote(f) for f in layout["files"]])
        named = [F.col(f"_{i}").alias(n) for n, i in header.items()]
        out = out.unionByName(rows.select(*named, F.col("_metadata.file_path").alias("_file")), allowMissingColumns=True)
    return out.select(*[c for c in out.columns if c != "_file"], "_file")


def read_flow_files(spark: SparkSession, folder: str, columns: Iterable[str] = tuple(FLOW_NAMES)) -> DataFrame:
    """Tab-separated GBK files with header, all columns as text, with the file each row came from."""
    return read_headed_files(spark, folder, columns, "\t", "GBK")


def envelope_rows(answers: DataFrame, text: str, row_schema: str, field: str = "result") -> DataFrame:
    """Rows of the array in each answer text, beside the answer's other columns.

    An answer that is broken JSON, or has no such array, gives no rows.
    """
    lenient = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true"}
    parsed = F.from_json(text, f"`{field}` array<{row_schema}>", lenient)
    other = [c for c in answers.columns if c != text]
    return answers.select(*other, F.explode(parsed[field]).alias("_row")).select(*other, "_row.*")


def envelope_variants(answers: DataFrame, text: str, field: str = "result") -> DataFrame:
    """Rows of the array in each answer text as `_row`, a variant, and `_row_id`, beside the answer's other columns.

    The id is made of the whole answer and the row's place in it, so the same answer gives the same ids whenever it is read. An
    answer that is broken, repeats a key in one object or has no such array gives no rows.
    """
    lenient = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true"}
    parsed = F.from_json(text, f"`{field}` array<variant>", lenient)
    other = [c for c in answers.columns if c != text]
    placed = answers.select(*other, F.md5(text).alias("_answer"), F.posexplode(parsed[field]).alias("_place", "_row"))
    return placed.select(*other, "_row", F.concat_ws(":", "_answer", "_place").alias("_row_id"))


@dataclass(frozen=True)
class RowKey:
    """A key of landed rows: its spellings, the column's name first, and whether it has plain and nested values."""

    spellings: tuple[str, ...]
    plain: bool = True
    nested: bool = False

    @property
    def name(self) -> str:
        return self.spellings[0]


def row_keys(rows: DataFrame) -> list[RowKey]:
    """All keys of the objects in `_row`, sorted; keys that differ in case only are one, under their first spelling.

    Keys are folded map-side; their number is that of a table's columns, and more than `MOST_KEYS` raise.
    """
    entries = rows.select(F.explode(F.col("_row").try_cast("map<string,variant>")).alias("key", "value"))
    kind = F.expr("schema_of_variant(value)")
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    found = entries.groupBy("key").agg(F.bool_or(~nested).alias("plain"), F.bool_or(nested).alias("nested"))
    listed = found.limit(MOST_KEYS + 1).collect()
    if len(listed) > MOST_KEYS:
        raise ValueError(f"rows have more than {MOST_KEYS} keys")
    alike: dict[str, list[Row]] = {}
    for row in sorted(listed, key=lambda r: r["key"]):
        alike.setdefault(row["key"].lower(), []).append(row)
    return [RowKey(tuple(r["key"] for r in g), any(r["plain"] for r in g), any(r["nested"] for r in g)) for g in alike.values()]


def spread_keys(rows: DataFrame, keys: Iterable[RowKey], nested_suffix: str = "_nested") -> DataFrame:
    """Columns for the given keys of `_row`: text for plain values, and a variant named with `nested_suffix` for objects and arrays.

    All keys are taken in one pass over a row, and one more for each further spelling that some keys have, so work grows with
    the number of keys. A row's value is that of the first spelling it has. A plain and a nested column never share a name, so a
    table whose loads differ in what a key holds stays readable.
    """
    keys = list(keys)
    depth = max((len(k.spellings) for k in keys), default=0)
    taken = {k.name.lower() for k in keys}
    out = rows
    for n in range(depth):
        fields = [T.StructField(k.spellings[n], T.VariantType()) for k in keys if len(k.spellings) > n]
        out = out.withColumn(f"_values{n}", F.col("_row").try_cast(T.StructType(fields)))
    columns = {}
    for key in keys:
        found = F.coalesce(*[F.col(f"_values{n}")[name] for n, name in enumerate(key.spellings)])
        is_nested = F.schema_of_variant(found).startswith("OBJECT") | F.schema_of_variant(found).startswith("ARRAY")
        if not key.nested:
            columns[key.name] = found.cast("string")
            continue
        if key.plain:
            columns[key.name] = F.when(~is_nested, found).cast("string")
        name = key.name + nested_suffix
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        columns[name] = F.when(is_nested, found)
    return out.withColumns(columns).drop("_row", *[f"_values{n}" for n in range(depth)])


def row_count(text: Column, field: str = "rowCount") -> Column:
    """Number of rows that an answer announces; null if unreadable."""
    return F.get_json_object(text, f"$.{field}").try_cast("bigint")


def read_answers(spark: SparkSession, folder: str, row_schema: str, field: str = "result") -> DataFrame:
    """Rows of landed JSON answers, one answer per line."""
    return envelope_rows(spark.read.text(folder), "value", row_schema, field)


def read_answer_files(spark: SparkSession, folder: str, row_schema: str, field: str = "result") -> DataFrame:
    """Rows of landed JSON answers, one answer (a page of bounded size) per file."""
    return envelope_rows(spark.read.text(folder, wholetext=True), "value", row_schema, field)


def read_day_answers(spark: SparkSession, folder: str, row_schema: str, day: str | None = None) -> DataFrame:
    """Event answers below `eventdate=` folders, whose rows are in `list`; `day` prunes to one folder."""
    answers = spark.read.text(folder)
    if day is not None:
        answers = answers.filter(F.col("eventdate") == F.lit(day).cast("date"))
    return envelope_rows(answers, "value", row_schema, "list")


def read_json_lines(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(folder)


def read_lines(spark: SparkSession, folder: str, parts_of: str | None = None) -> DataFrame:
    """Lines of text files as `file, line_no, line`, numbered from 0 in each file, also for files cut into many splits.

    With `parts_of`, a pattern with one group, files whose paths have the same group are parts of one file, which has that name: shorter names
    come first, and of equal length the lesser, which is the order in which Spark's tasks number what they write.

    The lines are read once and written to the shared folder with the start of their split and their row number in the task that
    read it. The number of a line follows from the lines in the splits before it, which is one row per split to add
    up. So numbers do not depend on how a file is cut, and a later use never reads the files anew.
    """
    row = F.monotonically_increasing_id()
    start = F.col("_metadata.file_block_start")
    lines = checkpointed(
        spark.read.text(folder).select(F.col("_metadata.file_path").alias("_path"), start.alias("_start"), row.alias("_row"), F.col("value").alias("line"))
    )
    splits = lines.groupBy("_path", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    splits = splits.withColumn("file", F.regexp_extract("_path", parts_of, 1) if parts_of else F.col("_path"))
    before = Window.partitionBy("file").orderBy(F.length("_path"), "_path", "_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = checkpointed(splits.select("file", "_path", "_start", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    numbered = lines.join(small_or_hashed(splits), ["_path", "_start"])
    return numbered.select("file", (F.col("_before") + F.col("_row") - F.col("_first")).alias("line_no"), "line")


def read_table(
    spark: SparkSession, name: str, path: str | None = None, jdbc: Mapping[str, str] | None = None
) -> DataFrame:
    """A landed table by name: Parquet below `path`, or a table behind JDBC options."""
    columns = T.StructType.fromDDL(SCHEMAS[name]).names
    if jdbc is not None:
        return spark.read.format("jdbc").options(dbtable=name, **jdbc).load().select(*columns)
    return spark.read.schema(SCHEMAS[name]).parquet(f"{path}/{name}")


def read_sheet(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A sheet landed as CSV with header, bound by the names in it; columns it lacks are null, further ones are dropped."""
    fields = T.StructType.fromDDL(SCHEMAS[name]).fields
    rows = read_headed_files(spark, path, [f.name for f in fields], ",", "UTF-8")
    return rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields])


def monitoring_tables(spark: SparkSession, path: str | None = None, jdbc: Mapping[str, str] | None = None) -> dict:
    names = ("alerts", "events", "triggers", "functions", "items", "hosts")
    return {n: read_table(spark, n, path, jdbc) for n in names}
