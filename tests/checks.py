"""Compare a Spark result with a DuckDB result, ignoring row order."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
from collections import Counter

import duckdb


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """An in-process DuckDB connection with the test tables as views."""
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when names, types and rows agree; otherwise what differs."""
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    ours, theirs = _bag(df.columns, df.collect()), _bag(names, cursor.fetchall())
    if ours == theirs:
        return ""
    return (
        f"{sum(ours.values())} rows vs {sum(theirs.values())}; only ours "
        f"{list((ours - theirs).items())[:3]}; only theirs {list((theirs - ours).items())[:3]}"
    )
