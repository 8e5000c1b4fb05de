"""Where queries and the SQL that they are held against are listed."""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a function (spark, sf_dir) under its name."""
    def put(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """Doubles to some places, so that sums in another order compare equal."""
    return df.withColumns({c: F.round(c, places) for c, t in df.dtypes if t == "double"})


def sql_sets(columns: list[str], keep: Callable[[set[str]], bool]) -> str:
    """GROUPING SETS text of every subset of columns that passes: the brute-force form of a cube's constraints."""
    subsets = [s for k in range(len(columns) + 1) for s in combinations(columns, k) if keep({*s})]
    return "GROUPING SETS (" + ", ".join(f"({', '.join(s)})" for s in subsets) + ")"
