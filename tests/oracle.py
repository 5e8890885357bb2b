"""Run a query and its SQL twin and compare the rows."""
from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, bool) or v is None or isinstance(v, (int, str)):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    return str(v)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    cols = sorted(df.columns)
    return cols, [tuple(plain(row[c]) for c in cols) for row in df.select(*[f"`{c}`" for c in cols]).collect()]


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(plain(r[i]) for i in order) for r in cur.fetchall()]


def sort_key(row: tuple):
    return tuple((v is None, type(v).__name__, str(v)) for v in row)


# Operators that would pair every row with every row, or leave the JVM.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups")


def compare(spark: SparkSession, con, fn, sql: str, sf_dir: str) -> tuple[int, str | None]:
    """Rows of the query and a description of the first difference, None when equal."""
    df = fn(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in UNWANTED:
        if op in plan:
            return 0, f"plan has {op}"
    cols, got = spark_rows(df)
    want_cols, want = duck_rows(con, sql)
    if cols != want_cols:
        return len(got), f"columns {cols} != {want_cols}"
    if len(got) != len(want):
        return len(got), f"{len(got)} rows != {len(want)}; {sorted(got, key=sort_key)[:2]} / {sorted(want, key=sort_key)[:2]}"
    for a, b in zip(sorted(got, key=sort_key), sorted(want, key=sort_key)):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return len(got), f"{cols}: {a} != {b}"
    return len(got), None
