"""Runs registered queries beside their SQL and compares the results.

    python -m tests.compare [folder] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (bytearray, bytes)):
        return bytes(v)
    return v


def bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def spark_bag(df):
    return bag(df.columns, df.collect())


def duck_bag(con, sql: str):
    res = con.execute(sql)
    return bag([d[0] for d in res.description], res.fetchall())


def difference(df, con, sql: str) -> str | None:
    """None if equal, else a short account."""
    cols_s, s = spark_bag(df)
    cols_d, d = duck_bag(con, sql)
    if cols_s != cols_d:
        return f"columns {cols_s} != {cols_d}"
    if s != d:
        return (
            f"rows {sum(s.values())} vs {sum(d.values())};"
            f" only spark {list((s - d).items())[:3]}; only sql {list((d - s).items())[:3]}"
        )
    return None


def main(argv: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as e
    from tests.conftest import make_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con = make_session(), duck(folder)
    queries, sql = e.queries(), e.oracle_sql()
    bad = 0
    for name in argv[1:] or list(queries):
        began = time.time()
        try:
            df = queries[name](spark, folder)
            if name in sql:
                diff = difference(df, con, sql[name])
                n = duck_bag(con, sql[name])[1].total()
            else:
                diff, n = None, df.count()
        except Exception as x:  # noqa: BLE001 - report and go on with the next query
            diff, n = f"{type(x).__name__}: {str(x)[:1500]}", -1
        bad += diff is not None
        note = "" if name in sql else " (rows only)"
        print(f"{'ok ' if diff is None else 'BAD'} {name:24s} rows={n:<8d} {time.time() - began:5.1f}s{note} {diff or ''}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
