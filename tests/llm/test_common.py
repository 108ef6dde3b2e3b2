from __future__ import annotations

from tests.llm import rows
from tidewatch.llm import decontaminate, simhash
from tidewatch.llm.common import row_key, without_rows

EXTRA = ["map('b', array(map('x', 1)), 'a', null) AS more", "named_struct('m', map('k', 1), 'n', 2) AS nested", "parse_json('{\"v\": [1, null]}') AS v"]


def test_rows_with_maps_and_variants_have_keys(spark):
    df = rows.docs(spark, [(1, "a"), (2, "b")]).selectExpr("*", *EXTRA)
    keys = df.select(row_key(df).alias("k")).collect()
    turned = df.drop("more").selectExpr("*", "map('a', null, 'b', array(map('x', 1))) AS more")
    assert keys == turned.select(row_key(turned).alias("k")).collect() and keys[0] != keys[1]
    other = df.drop("more").selectExpr("*", "map('a', null, 'b', array(map('x', 2))) AS more")
    assert keys[0] != other.select(row_key(other).alias("k")).first()


def test_operators_take_tables_with_maps(spark):
    df = rows.docs(spark).selectExpr("*", *EXTRA)
    assert without_rows(df, df.where("doc_id = 2").select(df["doc_id"].alias("id"), row_key(df).alias("key"))).count() == df.count() - 2
    assert simhash.one_per_group(df).columns == df.columns
    items = spark.createDataFrame([(1, rows.prose(90, 3))], "item_id long, text string")
    assert decontaminate.leaks(df, items).count() >= 1
