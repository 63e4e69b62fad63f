"""Compare a Spark result with DuckDB on the same parquet files, as row multisets."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if isinstance(value, decimal.Decimal):
        return ("decimal", value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def differences(df, sql: str, con) -> str | None:
    """None if columns and rows agree, else a short account of what does not."""
    names = sorted(df.columns)
    got = Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())
    result = con.sql(sql)
    if sorted(result.columns) != names:
        return f"columns {names} != {sorted(result.columns)}"
    order = [result.columns.index(n) for n in names]
    want = Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    if got == want:
        return None
    return (
        f"rows {sum(got.values())} vs {sum(want.values())}; only in Spark {list((got - want).items())[:3]}; "
        f"only in SQL {list((want - got).items())[:3]}"
    )
