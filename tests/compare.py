"""Run registered queries in Spark and their SQL in DuckDB and compare all values."""

from __future__ import annotations

import math
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ("", "null")
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, float):
        return ("float", value + 0.0)
    if isinstance(value, int):
        return ("int", value)
    return (type(value).__name__, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name, function, sql):
    """(rows, seconds, problem or None)."""
    began = time.time()
    df = function(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - began
    if sql is None:
        return len(got), took, None
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return len(got), took, f"columns {sorted(df.columns)} / {sorted(columns)}"
    want = rows_of(columns, cursor.fetchall())
    if got == want:
        return len(got), took, None
    extra = sorted(set(got) - set(want))[:2]
    missing = sorted(set(want) - set(got))[:2]
    counts = f"{len(got)}/{len(want)} rows, {len(set(got) - set(want))} differ"
    return len(got), took, f"{counts}; only spark {extra}; only sql {missing}"
