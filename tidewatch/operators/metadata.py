"""Views and defaults from model field lists, and catalog copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.ordered import concat_ordered

# Name prefixes, view names and view texts.
FIELD_PREFIX = "x_"
CATALOG_PREFIX = "waf_"
VIEW_PREFIX = "uv_"
FIELD_TAG = '  <field name="%s"/>\n'
LIST_VIEW = '<tree string="%s">\n%s</tree>'
FORM_VIEW = '<?xml version="1.0"?>\n<form string="%s">\n<sheet>\n%s</sheet></form>'


def with_prefix(df: DataFrame, name: str, prefix: str) -> DataFrame:
    return df.filter(F.col(name).startswith(prefix))


def model_views(fields: DataFrame, prefix: str = FIELD_PREFIX) -> DataFrame:
    """List and form view text per model from its fields in order; a model without fields gets empty ones."""
    tagged = with_prefix(fields, "field_name", prefix).withColumn(
        "_tag", F.format_string(FIELD_TAG, "field_name")
    )
    body = concat_ordered(tagged, ["model"], "seq", "_tag", "_xml", sep="")
    views = fields.select("model").distinct().join(body, "model", "left")
    xml = F.coalesce(F.col("_xml"), F.lit(""))

    def name(kind: str) -> Column:
        return F.concat(F.lit(VIEW_PREFIX), F.col("model"), F.lit(f"_{kind}"))

    return views.select(
        "model",
        name("list").alias("list_name"),
        F.format_string(LIST_VIEW, name("list"), xml).alias("list_xml"),
        name("form").alias("form_name"),
        F.format_string(FORM_VIEW, name("form"), xml).alias("form_xml"),
    )


def defaults_of(records: DataFrame, ids: Sequence[str], prefix: str, model: str) -> DataFrame:
    """One row per record and field whose name starts with the prefix: `model, field, value`."""
    names = [c for c in records.columns if c.startswith(prefix)]
    text = records.select(*ids, *[F.col(c).cast("string").alias(c) for c in names])
    return text.unpivot(list(ids), names, "field", "value").withColumn("model", F.lit(model))


def copy_catalog(catalog: DataFrame, target: DataFrame | None = None, prefix: str = CATALOG_PREFIX) -> DataFrame:
    """Catalog entries with the prefix, appended to the target."""
    chosen = with_prefix(catalog, "name", prefix)
    return chosen if target is None else target.unionByName(chosen)
