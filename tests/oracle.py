"""Compare a query's rows with its SQL run by DuckDB on the same files."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _kind(value):
    return type(value).__name__ if value is not None else None


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=repr)


def differences(df, con, sql) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    got_names = df.columns
    got = rows_of(got_names, [tuple(r.asDict(recursive=True).values()) for r in df.collect()])
    result = con.execute(sql)
    want_names = [d[0] for d in result.description]
    want = rows_of(want_names, result.fetchall())
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}: {got[:2]} / {want[:2]}"
    for g, w in zip(got, want):
        if g != w:
            return f"columns {sorted(got_names)}: {g} != {w}"
        if [_kind(a) for a in g] != [_kind(b) for b in w]:
            return f"types {[_kind(a) for a in g]} != {[_kind(b) for b in w]}"
    return None
