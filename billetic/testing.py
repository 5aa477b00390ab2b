"""Comparison helpers shared by the tests and ``tools/check_oracle.py``:
run a registered query on Spark and its oracle SQL on DuckDB over the same
parquet tables, and compare column names and the multiset of rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

DRIVER_VIEWS = ("region nation customer supplier part orders lineitem events documents "
                "embeddings pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def canonical(columns, rows):
    """Columns sorted by name, rows normalised and sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    data = sorted((tuple(norm(r[i]) for i in order) for r in rows), key=_key)
    return cols, data


def duckdb_views(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in DRIVER_VIEWS:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def run_duckdb(con, sql: str):
    res = con.execute(sql)
    return [d[0] for d in res.description], res.fetchall()


def run_spark(df):
    return df.columns, df.collect()
