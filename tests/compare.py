"""Rows of a query against those of its SQL, without regard to order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings works files downloads extractions catalog_records subject_labels categories corpus_specs".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir, f"{name}.parquet")
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if path.is_dir() else ''}'")
    return con


def plain(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return f"{value:.6g}"
    return str(value)


def rows(columns: list[str], data) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


def differ(df, con, sql: str) -> str:
    """'' where both sides agree, else what differs first."""
    got = rows(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows and {len(want)}; only left {next((x for x in got if x not in set(want)), None)}; only right {next((x for x in want if x not in set(got)), None)}"
    return next((f"{a} and {b}" for a, b in zip(got, want, strict=True) if a != b), "")
