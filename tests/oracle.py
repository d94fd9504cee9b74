"""Rows of a Spark query against DuckDB's rows of its SQL, both sorted."""

from __future__ import annotations

import math
import os

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    got = con.execute(sql)
    return [c[0] for c in got.description], got.fetchall()


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    if type(x).__name__ == "Decimal":
        return float(x)
    return x


def rows(columns: list[str], found: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


def differ(df, sf_dir: str, sql: str) -> str:
    """What differs first, or an empty text."""
    columns, want = duck(sf_dir, sql)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    a, b = rows(df.columns, [tuple(r) for r in df.collect()]), rows(columns, want)
    if len(a) != len(b):
        return f"{len(a)} rows instead of {len(b)}"
    return next((f"{x!r} instead of {y!r}" for x, y in zip(a, b, strict=True) if x != y), "")
