"""Comparison of a query's rows with DuckDB's."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(x: object) -> str:
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x):
        return "~"
    if isinstance(x, (int, float)) and not isinstance(x, bool) or hasattr(x, "dtype") and getattr(x, "ndim", 1) == 0 and x.dtype.kind in "iuf":
        return f"{float(x):.10g}"
    return str(list(x)) if hasattr(x, "tolist") and getattr(x, "ndim", 0) else str(x)


def rows(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    return sorted(tuple(map(plain, r)) for r in df.itertuples(index=False))
