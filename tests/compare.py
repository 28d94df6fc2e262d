"""Run a query and its SQL on the same tables and compare all rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql, sf_dir):
    """Difference as text, or None when columns and rows agree."""
    df = query(spark, sf_dir)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    other = rows_of(names, result.fetchall())
    if mine == other:
        return None
    return (
        f"rows {sum(mine.values())} vs {sum(other.values())}\n"
        f"only here: {list((mine - other).items())[:2]}\nonly sql: {list((other - mine).items())[:2]}"
    )
