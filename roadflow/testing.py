"""Result comparison between a Spark query and its DuckDB oracle SQL.

Mirrors the external correctness gate: same row count, same column names,
same multiset of rows (columns sorted by name, values normalised).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (int, decimal.Decimal, float)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        return round(f, 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark_df, con, sql: str):
    """Returns (ok, message)."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    a, b = canon(s_cols, s_rows), canon(d_cols, d_rows)
    if a != b:
        for x, y in zip(a, b):
            if x != y:
                return False, f"first diff (cols {sorted(s_cols)}):\n spark={x}\n duck ={y}"
    return True, f"{len(s_rows)} rows"
