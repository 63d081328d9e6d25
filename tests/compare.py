"""Compares a query with its SQL: rows, columns and values, in any order."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    def one(x):
        if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x):
            return "null"
        if isinstance(x, bool) or type(x).__name__ == "bool_":
            return str(bool(x))
        if hasattr(x, "isoformat"):
            return str(pd.Timestamp(x))
        if isinstance(x, float) or type(x).__name__.startswith("float"):
            return f"{float(x):.6g}"
        if type(x).__name__.startswith(("int", "uint")):
            return f"{float(x):.6g}" if abs(int(x)) < 10**6 else str(int(x))
        return str(x)

    return sorted(tuple(one(v) for v in row) for row in frame[sorted(frame.columns)].astype(object).itertuples(index=False))


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str:
    """What differs, or an empty string."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} and {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"{len(spark_frame)} and {len(sql_frame)} rows"
    a, b = canonical(spark_frame), canonical(sql_frame)
    odd = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(odd)} rows differ, first {odd[0]}" if odd else ""
