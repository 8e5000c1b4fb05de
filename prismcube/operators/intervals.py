"""Interval joins whose work follows their result, also where one key holds much of all rows (M2, M3)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prismcube.operators.ordered import carried


def ticks(df: DataFrame, c: str) -> Column:
    """A bound as a whole number that keeps its order: microseconds, days, or the number itself (fractions go down)."""
    kind = dict(df.dtypes)[c]
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(c).cast("timestamp"))
    if kind == "date":
        return F.unix_date(c).cast("long")
    return F.floor(F.col(c)).cast("long") if kind in ("float", "double") or kind.startswith("decimal") else F.col(c).cast("long")


def level_of(low: Column, high: Column) -> Column:
    """A level whose cells, of 2^level ticks, are wider than high - low, so that an interval lies in two of them at most."""
    return F.length(F.bin(high - low))


def cell(at: Column) -> Column:
    return F.call_function("shiftright", at, F.col("_level"))


def near(a: DataFrame, b: DataFrame, on: Sequence[str], bounds: tuple[str, str], outer: tuple[str, str]) -> DataFrame:
    """Pairs of equal keys of which b's interval (outer) may contain a's (bounds).

    b's intervals stand in the cells that they touch at their own level, a's in the cell of their start at each level at
    which there are containers and which is not below their own. Only equal keys, levels and cells meet.
    """
    low, high = (ticks(b, c) for c in outer)
    r = b.filter(F.col(outer[0]) <= F.col(outer[1])).withColumn("_level", level_of(low, high))
    levels = sorted(x["_level"] for x in r.select("_level").distinct().collect())  # at most 64
    r = r.withColumn("_cell", F.explode(F.array_distinct(F.array(cell(low), cell(high)))))
    start, end = (ticks(a, c) for c in bounds)
    some = F.filter(F.array(*map(F.lit, levels)).cast("array<int>"), lambda x: x >= level_of(start, end))
    left = a.filter(F.col(bounds[0]) <= F.col(bounds[1])).withColumn("_level", F.explode(some)).withColumn("_cell", cell(start))
    return left.join(r, [*on, "_level", "_cell"]).drop("_level", "_cell")


def join_contained(a: DataFrame, b: DataFrame, on: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """Pairs of equal keys in which a's interval lies inside b's (M2); b's bounds get the suffix _b.

    Null keys and bounds match nothing, nor do intervals that end before they start.
    """
    r = b.withColumnsRenamed({c: f"{c}_b" for c in b.columns if c not in on})
    return near(a, r, on, (start, end), (f"{start}_b", f"{end}_b")).filter((F.col(start) >= F.col(f"{start}_b")) & (F.col(end) <= F.col(f"{end}_b")))


def join_point_in_interval(points: DataFrame, intervals: DataFrame, on: Sequence[str], at: str, start: str = "start", end: str = "end") -> DataFrame:
    """Points with the intervals of their key that hold them, both ends included (M3); intervals may overlap."""
    return near(points, intervals, on, (at, at), (start, end)).filter(F.col(at).between(F.col(start), F.col(end)))


def join_point_by_key(points: DataFrame, intervals: DataFrame, on: Sequence[str], at: str, start: str = "start", end: str = "end") -> DataFrame:
    """join_point_in_interval() where each key has few intervals: one join on the key, then all its pairs are compared. The
    cheapest of the three there; for keys with many intervals take one of the others (M3)."""
    return points.join(intervals, [*on]).filter(F.col(at).between(F.col(start), F.col(end)))


def join_point_in_disjoint(points: DataFrame, intervals: DataFrame, on: Sequence[str], at: str, start: str = "start", end: str = "end", parts: int | None = None) -> DataFrame:
    """join_point_in_interval() where intervals of a key share ends at most: no pair is formed but those of the result (M3).

    Points and intervals are put in one order of key and time, in ranges; each point takes the last interval that began
    at or before it, from an earlier range where its own has none. A point on the end of an interval finds that one by an
    equi-join. Null keys, points and bounds match nothing.
    """
    whole = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in on])
    names = [c for c in intervals.columns if c not in on]
    p = points.filter(whole & F.col(at).isNotNull())
    i = intervals.filter(whole & (F.col(start) <= F.col(end)))
    row, held = F.struct("*"), F.struct(*names)
    none = lambda df, c: F.lit(None).cast(df.select(c).schema[0].dataType)
    began = i.select(*on, F.col(start).alias("_at"), F.lit(0).alias("_kind"), F.col(end).alias("_end"), none(p, row).alias("_p"), held.alias("_i"))
    asked = p.select(*on, F.col(at).alias("_at"), F.lit(1).alias("_kind"), none(i, F.col(end)).alias("_end"), row.alias("_p"), none(i, held).alias("_i"))
    # very many equal points may be parted anywhere
    both = began.unionByName(asked).withColumn("_tie", F.when(F.col("_kind") == 1, F.xxhash64("_p")))
    last = carried(both, on, ["_at", "_kind", "_end", "_tie"], F.col("_i"), "_found", parts)
    # both sides are read again from what carried() has written
    asked, began = last.filter("_kind = 1"), last.filter("_kind = 0")
    inside = asked.filter(F.col("_at") < F.col("_found")[end]).select("_p", F.col("_found").alias("_i"))
    ends = asked.select(*on, "_at", "_p").join(began.select(*on, F.col("_end").alias("_at"), "_i"), [*on, "_at"]).select("_p", "_i")
    return inside.unionByName(ends).select("_p.*", *(F.col("_i")[c].alias(c) for c in names))
