"""Exact percentiles of groups of any size, for several grouping sets at once, without holding a group's values in one task.

Values are dealt to bins between a thousand quantiles of the whole column. Counts by finest cell and bin are rolled up
to all sets and tell in which bin of a cell each percentile lies; only the values of those bins are counted one by one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import isfinite

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bins of the column; a bin holds about this part of its rows, or one value that is more frequent.
BINS = 1024


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def same_cell(a: str, b: str, dims: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in dims], F.lit(True))


def rolled_up(df: DataFrame, sets: Sequence[Sequence[str]], dims: Sequence[str], more: Sequence[str]) -> DataFrame:
    """Sums of _n by each set's dimensions, null where rolled up, and the further columns."""
    return df.groupingSets([[F.col(c) for c in (*s, *more)] for s in sets], *(F.col(c) for c in (*dims, *more))).agg(F.sum("_n").alias("_n"))


def exact_percentiles(df: DataFrame, dims: Sequence[str], sets: Sequence[Sequence[str]], value: Column, pcts: Sequence[float], name: str) -> DataFrame:
    """dims and ``name``: for each cell of the sets an array of the percentiles of value (a number), as percentile() gives them.

    Nulls in value don't count; a cell without values has no row. Dimensions must not be null where there are several sets.
    Reads df three times: what is dear to make should be written before.
    """
    sets = [*dict.fromkeys(map(tuple, sets))]
    rows = df.select(*dims, value.cast("double").alias("_v")).filter("_v is not null")
    cuts = rows.agg(F.percentile_approx("_v", F.expr(f"array({', '.join(f'{i / BINS}D' for i in range(1, BINS))})"), 10_000)).first()[0]
    cuts = sorted({x + 0.0 for x in cuts or () if isfinite(x)})
    dealt = Bucketizer(splits=[-float("inf"), *(cuts or [0.0]), float("inf")], inputCol="_v", outputCol="_bin", handleInvalid="keep").transform(rows)  # NaN: last

    cell = Window.partitionBy(*dims)
    counts = rolled_up(dealt.groupBy(*dims, "_bin").agg(F.count("*").alias("_n")), sets, dims, ["_bin"])
    counts = counts.withColumns({"_seen": F.sum("_n").over(cell.orderBy("_bin")), "_all": F.sum("_n").over(cell)})
    at = [(F.col("_all") - 1) * F.lit(p / 100) for p in pcts]  # places from 0, between two values
    ends = [end(x).cast("long") for x in at for end in (F.floor, F.ceil)]
    wanted = counts.filter(any_of([(x >= F.col("_seen") - F.col("_n")) & (x < F.col("_seen")) for x in ends]))
    wanted = wanted.select(*dims, "_bin", (F.col("_seen") - F.col("_n")).alias("_before"), "_all")

    near = dealt.join(wanted.select("_bin").distinct(), "_bin", "left_semi").groupBy(*dims, "_bin", "_v").agg(F.count("*").alias("_n"))
    near = rolled_up(near, sets, dims, ["_bin", "_v"]).alias("r").join(wanted.alias("w"), same_cell("r", "w", dims) & (F.col("r._bin") == F.col("w._bin")))
    near = near.select(*(f"r.{c}" for c in dims), "r._bin", "_v", "_n", "_before", "_all")
    near = near.withColumn("_to", F.col("_before") + F.sum("_n").over(Window.partitionBy(*dims, "_bin").orderBy("_v")))
    here = lambda x: (x >= F.col("_to") - F.col("_n")) & (x < F.col("_to"))
    found = near.groupBy(*dims).agg(F.first("_all").alias("_all"), *(F.min(F.when(here(x), F.col("_v"))).alias(f"_{i}") for i, x in enumerate(ends)))

    def between(i: int) -> Column:
        low, high = F.col(f"_{2 * i}"), F.col(f"_{2 * i + 1}")
        return F.when(low == high, low).otherwise((F.ceil(at[i]) - at[i]) * low + (at[i] - F.floor(at[i])) * high)

    return found.select(*dims, F.array(*(between(i) for i in range(len(pcts)))).alias(name))
