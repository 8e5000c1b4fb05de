"""Features (F1-F7) and imputation (F8-F10) as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prismcube.sources.checkpoints import cut


def null_safe(by: Sequence[str], prefix: str = "_g_") -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(prefix + c)) for c in by], F.lit(True))


@dataclass(frozen=True)
class ColumnFeature:
    """A column from an expression over the row (F1)."""

    name: str
    expr: str

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.name, F.expr(self.expr))


@dataclass(frozen=True)
class GroupFeature:
    """Aggregates of a group, optionally combined, on each of its rows (F2). Rows with a null key are dropped.

    The group is summed up before it is joined back, so that a group of a third of all rows stays in no one task.
    """

    name: str
    by: tuple[str, ...]
    aggs: Mapping[str, str] = field(default_factory=dict)
    combine: str | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        n = df.groupBy(*self.by).agg(*(F.expr(e).alias(k) for k, e in self.aggs.items()))
        value = F.expr(self.combine) if self.combine else F.col(next(iter(self.aggs)))
        return df.join(n.select(*self.by, value.alias(self.name)), [*self.by])


@dataclass(frozen=True)
class WindowFeature:
    """The sum of window functions over (by, order); or, with ``rank_test``, an aggregate over the rows whose rank passes it."""

    name: str
    by: tuple[str, ...]
    order: tuple[str, ...]
    functions: tuple[str, ...] = ("rank()",)
    rank_test: str | None = None
    agg: str | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        over = f" OVER (PARTITION BY {', '.join(self.by)} ORDER BY {', '.join(self.order)})"
        if not self.rank_test:
            return df.withColumn(self.name, reduce(lambda a, b: a + b, [F.expr(f + over) for f in self.functions]))
        ranked = df.withColumn("_rank", F.expr("rank()" + over)).filter(f"_rank {self.rank_test}")
        n = ranked.groupBy(*(F.col(c).alias(f"_g_{c}") for c in self.by)).agg(F.expr(self.agg or "count(1)").alias(self.name))
        return df.join(n, null_safe(self.by), "left").drop(*(f"_g_{c}" for c in self.by))


def apply_features(df: DataFrame, features: Sequence[ColumnFeature | GroupFeature | WindowFeature], keep: Sequence[str] | None = None) -> DataFrame:
    """Features in the order given, then a subset of columns."""
    df = reduce(lambda d, f: f.apply(d), features, df)
    return df.select(*keep) if keep else df


def categorise(df: DataFrame, column: str, levels: Mapping[str, str], default: str | None = None, out: str | None = None) -> DataFrame:
    """The first level whose pattern is found, letters in either case; else the default, null for a null."""
    value = F.lit(default).cast("string")
    for level, pattern in reversed(levels.items()):
        value = F.when(F.col(column).rlike(f"(?i){pattern}"), level).otherwise(value)
    return df.withColumn(out or f"{column}_category", F.when(F.col(column).isNotNull(), value))


def run_workflow(df: DataFrame, steps: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]], cut_after: Sequence[str] = ()) -> DataFrame:
    """Named steps in order; after those in cut_after the data is written to the shared folder."""
    for name, step in steps:
        df = df.transform(step)
        df = cut(df, name) if name in cut_after else df
    return df


def impute(df: DataFrame, by: Sequence[str], columns: Mapping[str, str], inplace: bool = True) -> DataFrame:
    """Nulls of several columns filled with an aggregate of their group, all in one aggregation (F8)."""
    stats = df.groupBy(*(F.col(c).alias(f"_g_{c}") for c in by)).agg(*(F.expr(e).alias(f"_v_{c}") for c, e in columns.items()))
    joined = df.join(stats, null_safe(by), "left")
    made = {c if inplace else f"{c}_imputed": F.coalesce(F.col(c), F.col(f"_v_{c}")) for c in columns}
    return joined.withColumns(made).drop(*(f"_g_{c}" for c in by), *(f"_v_{c}" for c in columns))


def impute_generic(df: DataFrame, by: Sequence[str], columns: Sequence[str], max_missing: float = 70, accuracy: int = 3000, exact: bool = False) -> DataFrame:
    """Nulls filled where less than max_missing percent of the group's values are missing: UNKNOWN for strings, the
    rounded median for whole numbers, the median for doubles, the rounded mean for others (F9)."""
    types = dict(df.dtypes)
    share = lambda c: (100.0 * F.sum(F.col(c).isNull().cast("int")) / F.count("*")).alias(f"_m_{c}")
    median = lambda c: F.percentile(c, F.lit(0.5)) if exact else F.percentile_approx(c, 0.5, accuracy)

    def value(c: str) -> Column:
        if types[c] == "string":
            return F.max(F.lit("UNKNOWN"))
        if types[c] in ("int", "bigint"):
            return F.round(median(c)).cast(types[c])
        return median(c).cast("double") if types[c] == "double" else F.round(F.avg(c)).cast(types[c])

    stats = df.groupBy(*(F.col(c).alias(f"_g_{c}") for c in by)).agg(*(x for c in columns for x in (share(c), value(c).alias(f"_v_{c}"))))
    joined = df.join(stats, null_safe(by), "left")
    made = {c: F.coalesce(F.col(c), F.when(F.col(f"_m_{c}") < max_missing, F.col(f"_v_{c}"))) for c in columns}
    return joined.withColumns(made).drop(*(f"_g_{c}" for c in by), *(f"_{x}_{c}" for c in columns for x in "mv"))


def latest_rank(by: Sequence[str], order: Sequence[Column]) -> Column:
    return F.row_number().over(Window.partitionBy(*by).orderBy(*order))
