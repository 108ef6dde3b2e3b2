from __future__ import annotations


def one(spark, column, schema="x int", row=(1,)):
    """Value of an expression over one row."""
    return spark.createDataFrame([row], schema).select(column.alias("v")).first()["v"]


def each(spark, values, kind, make):
    """Values of an expression for each input, in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r["v"] for r in df.select("i", make("x").alias("v")).orderBy("i").collect()]


def rows(df, *columns):
    """Rows as sorted tuples, nulls first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((x is not None, str(x)) for x in t))
