"""Order-dependent work over groups of any size: running sums, ranks and carried values without one task per group.

Rows are dealt in ranges of (group, order) and written, so that each knows its
range. Inside a range a window does the work; what a group's later ranges need
from its earlier ones is one row for each group and range. Only a group that
crosses a border has several ranges, and each border is crossed by one group, so
these rows number at most twice the ranges and can be handed to all tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prismcube.sources.checkpoints import cut

PART = "_range"


def null_safe(a: str, b: str, names: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in names], F.lit(True))


def in_ranges(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], parts: int | None = None) -> DataFrame:
    """df dealt in ranges of (by, order) and written, with the number of its range in ``_range``; a group's ranges follow each other.

    Rows equal in all of by and order lie in one range; break such ties in order where they may be many.
    """
    cols = [*by, *order]
    dealt = df.repartitionByRange(parts, *cols) if parts else df.repartitionByRange(*cols)
    return cut(dealt.withColumn(PART, F.spark_partition_id()), "ranges")


def across(totals: DataFrame, by: Sequence[str]) -> DataFrame:
    """Of rows (by, _range, ...) those of groups with several ranges: at most two for each range, so small enough to broadcast."""
    n = totals.groupBy(*by).agg(F.count("*").alias("_n")).filter("_n > 1")
    return totals.alias("t").join(n.alias("n"), null_safe("t", "n", by), "left_semi")


def running_totals(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], value: Column, name: str, parts: int | None = None) -> DataFrame:
    """df and ``name``: the sum of value over the rows of the group that come before, 0 for the first.

    Rows equal in by and order come in any order. Null groups are groups; order as the columns sort (nulls first by default).
    """
    rows = in_ranges(df.withColumn("_v", value), by, order, parts)
    inside = Window.partitionBy(PART, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
    totals = across(rows.groupBy(PART, *by).agg(F.sum("_v").alias("_t")), by)
    earlier = Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.withColumn("_before", F.sum("_t").over(earlier)).filter("_before is not null").drop("_t")
    joined = rows.alias("r").join(F.broadcast(before).alias("b"), null_safe("r", "b", by) & (F.col(f"r.{PART}") == F.col(f"b.{PART}")), "left")
    return joined.select(*(f"r.{c}" for c in df.columns), (F.col("_in") + F.coalesce("_before", F.lit(0))).alias(name))


def percent_ranks(df: DataFrame, by: Sequence[str], values: Mapping[str, str], parts: int | None = None) -> DataFrame:
    """df and a column for each of values (column: name): its percent_rank within the group, nulls first, in doubles.

    Values are counted first, so equal ones are one row however many they are; a running total of the counts gives the rows
    below. One group with all rows is ranked by as many tasks as there are ranges. All columns share one pass; where their
    types differ they are compared as doubles.
    """
    kinds = {t for c, t in df.dtypes if c in values}
    own = lambda c: F.col(c) if len(kinds) == 1 else F.col(c).cast("double")
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), own(c).alias("value")) for i, c in enumerate(values))))
    counts = df.select(*by, each.alias("_x")).select(*by, F.col("_x.i").alias("_i"), F.col("_x.value").alias("_value")).groupBy(*by, "_i", "_value").agg(F.count("*").alias("_n"))
    below = running_totals(counts, [*by, "_i"], ["_value"], F.col("_n"), "_below", parts)
    total = below.filter("_i = 0").groupBy(*by).agg(F.sum("_n").alias("_all"))
    ranks = below.alias("c").join(total.alias("t"), null_safe("c", "t", by)).select(*(F.col(f"c.{c}").alias(f"_g_{c}") for c in by), "_i", F.col("_value").alias("_g_value"), F.when(F.col("_all") > 1, F.col("_below") / (F.col("_all") - 1)).otherwise(0.0).alias("_rank"))
    for i, (c, name) in enumerate(values.items()):
        same = reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(f"_g_{x}")) for x in by], own(c).eqNullSafe(F.col("_g_value")))
        df = df.join(ranks.filter(F.col("_i") == i).withColumnRenamed("_rank", name), same).drop("_g_value", "_i", *(f"_g_{x}" for x in by))
    return df


def carried(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], value: Column, name: str, parts: int | None = None) -> DataFrame:
    """df and ``name``: the last value that is not null of the row or the rows of its group before it; null before the first one."""
    rows = in_ranges(df.withColumn("_v", value), by, order, parts)
    inside = Window.partitionBy(PART, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_in", F.last("_v", ignorenulls=True).over(inside))
    # what a range ends with; one without values hands on what came before it
    ends = rows.withColumn("_end", F.lead(F.lit(1)).over(Window.partitionBy(PART, *by).orderBy(*order)).isNull()).filter("_end").select(PART, *by, F.col("_in").alias("_t"))
    ends = across(ends, by)
    earlier = Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    before = ends.withColumn("_before", F.last("_t", ignorenulls=True).over(earlier)).filter("_before is not null").drop("_t")
    joined = rows.alias("r").join(F.broadcast(before).alias("b"), null_safe("r", "b", by) & (F.col(f"r.{PART}") == F.col(f"b.{PART}")), "left")
    return joined.select(*(f"r.{c}" for c in df.columns), F.coalesce("_in", "_before").alias(name))
