"""Side-by-side run of a plan and its check SQL."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb
import numpy as np
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, np.integer)):
        return int(v)
    if isinstance(v, (float, np.floating)):
        return float(v) + 0.0
    if isinstance(v, Decimal):
        return v.normalize()
    return v


def rows_of(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=lambda t: [(x is None, str(x)) for x in t])


def compare(df, con, sql: str) -> list[str]:
    """Differences in column names, types, row count and exact values."""
    rel = con.execute(sql)
    sql_names = [d[0] for d in rel.description]
    sql_types = [str(d[1]) for d in rel.description]
    expected = rel.fetchall()
    out = []
    if sorted(df.columns) != sorted(sql_names):
        return [f"columns {sorted(df.columns)} != {sorted(sql_names)}"]
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    want = dict(zip(sql_names, sql_types))
    for n, t in df.dtypes:
        k = kinds.get(t, t)
        if k.upper() != want[n].upper().replace(" ", "").replace("TIMESTAMP_US", "TIMESTAMP"):
            out.append(f"type of {n}: {t} != {want[n]}")
    got = df.collect()
    a, b = rows_of(got, df.columns), rows_of(expected, sql_names)
    if len(a) != len(b):
        out.append(f"rows {len(a)} != {len(b)}")
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        out.append(f"{len(diff)} rows differ, e.g. {diff[0][0]} != {diff[0][1]} ({sorted(sql_names)})")
    if not b:
        out.append("EMPTY")
    return out
