"""Profiles kept per partition and merged for any period without reading old rows.

A stored profile holds, for each partition and column, what adds up: counts,
sums of powers, extremes, a quantile sketch and a distinct-count sketch. A run
profiles only partitions that the store lacks; any union of stored partitions
gives a profile of the period. What needs counts of single values (entropy,
share of unique values) is not part of it: profile() gives these from the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prismcube.operators.shape import PERCENTILES, ColumnRule, is_numeric
from prismcube.sources.checkpoints import cut
from prismcube.sources.tables import exists, write_table

#: Of the quantile sketch: its size, and five standard deviations of the rank error, merged or not (from the published error
#: of KLL sketches). Of the distinct sketch: the logarithm of its size, and three relative standard deviations.
QUANTILE_K, RANK_ERROR = 800, 0.0068
DISTINCT_LG_K, DISTINCT_ERROR = 14, 3 * 1.04 / 2**7


def sketch_profile(df: DataFrame, partition: Sequence[str], analyze: Sequence[str] | None = None, exclude: Sequence[str] = (), virtual: Mapping[str, str] | None = None, rules: Sequence[ColumnRule] = ()) -> DataFrame:
    """partition, column_name, column_type, num_records, num_missing, num_invalid, squares, center, low, high, quantiles,
    distinct: one row for each partition and column, from one aggregation over the rows.

    Powers are summed around a column's ``center`` (its mean in the partition), so they keep their digits when merged.
    """
    df = df.withColumns({k: F.expr(e) for k, e in (virtual or {}).items()})
    columns = [c for c in (analyze or df.columns) if c not in {*partition, *exclude}]
    types, ruled = dict(df.dtypes), {r.column: r for r in rules}

    def measures(c: str) -> list[Column]:
        value, own = F.col(c), f"{c}__"
        out = [F.sum(value.isNull().cast("long")).alias(own + "missing"), (F.sum(ruled[c].invalid()) if c in ruled else F.lit(0)).cast("long").alias(own + "invalid")]
        out.append(F.hll_sketch_agg(F.trim(value.cast("string")), DISTINCT_LG_K).alias(own + "distinct"))
        if is_numeric(types[c]):
            v = value.cast("double")
            out += [F.avg(v).alias(own + "center"), F.var_pop(v).alias(own + "spread"), F.min(v).alias(own + "low"), F.max(v).alias(own + "high"), F.kll_sketch_agg_double(v, QUANTILE_K).alias(own + "quantiles")]
        return out

    wide = df.groupBy(*(F.col(c).cast("string").alias(c) for c in partition)).agg(F.count("*").alias("_n"), *(x for c in columns for x in measures(c)))

    def record(c: str) -> Column:
        have = is_numeric(types[c])
        of = lambda k, kind="double": F.col(f"{c}__{k}") if have else F.lit(None).cast(kind)
        n = F.col("_n") - F.col(f"{c}__missing")
        return F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("column_type"), F.col("_n").alias("num_records"), F.col(f"{c}__missing").alias("num_missing"), F.col(f"{c}__invalid").alias("num_invalid"), (of("spread") * n).alias("squares"), of("center").alias("center"), of("low").alias("low"), of("high").alias("high"), of("quantiles", "binary").alias("quantiles"), F.col(f"{c}__distinct").alias("distinct"))

    return wide.select(*partition, F.explode(F.array(*(record(c) for c in columns))).alias("r")).select(*partition, "r.*")


STORED = "column_name string, column_type string, num_records long, num_missing long, num_invalid long, squares double, center double, low double, high double, quantiles binary, distinct binary"


def stored(spark: SparkSession, store: str, partition: Sequence[str]) -> DataFrame:
    """The stored profiles; partition columns are strings."""
    return spark.read.schema(", ".join([STORED, *(f"`{c}` string" for c in partition)])).parquet(store)


def lacking(df: DataFrame, known: DataFrame, partition: Sequence[str], pruned: int = 1000) -> DataFrame:
    """The rows of df's partitions that known lacks; null ones are partitions too.

    Their values of the first partition column, unless they are very many, become a filter, so a table that is partitioned
    by it is read there only.
    """
    text = [F.col(c).cast("string").alias(c) for c in partition]
    same = lambda a, b: reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").cast("string").eqNullSafe(F.col(f"{b}.{c}")) for c in partition])
    new = df.select(*text).distinct().alias("n").join(known.select(*partition).distinct().alias("k"), same("n", "k"), "left_anti")
    values = [r[0] for r in new.select(partition[0]).distinct().limit(pruned + 1).collect()]
    if len(values) <= pruned:
        own = F.col(partition[0]).cast("string")
        df = df.filter(own.isin([v for v in values if v is not None]) | (own.isNull() if None in values else F.lit(False)))
    return df.alias("d").join(new.alias("n"), same("d", "n"), "left_semi")


def collect_profiles(df: DataFrame, store: str, partition: Sequence[str], rerun: bool = False, only: str | None = None, **what: object) -> int:
    """Brings the stored profiles under ``store`` up to date with df (G13); returns how many partitions were profiled.

    Partitions that the store has are left alone; with rerun all of df's are profiled anew. ``only`` restricts the run to one
    value of the first partition column. A partition's profile is replaced whole; nothing is written where nothing is left
    to do. ``what`` goes to sketch_profile().
    """
    spark = df.sparkSession
    rows = df.filter(F.col(partition[0]).cast("string") == only) if only is not None else df
    if not rerun and exists(spark, store):
        rows = lacking(rows, stored(spark, store, partition), partition)
    made = cut(sketch_profile(rows, partition, **what), "profiles")
    n = made.select(*partition).distinct().count()
    if n:
        write_table(made, store, partition)
    return n


def merged(profiles: DataFrame, by: Mapping[str, Column] | None = None) -> DataFrame:
    """by, column_name, column_type and the measures of profile() but those that need counts of values, for each period.

    by maps names to expressions over the partition columns; without it all stored partitions are one period. Counts,
    extremes and moments are exact; percentiles keep RANK_ERROR, distinct counts DISTINCT_ERROR (with fewer values than the
    sketch holds they are exact or nearly so).
    """
    by = {**(by or {})}
    n = F.col("num_records") - F.col("num_missing")
    keyed = profiles.select("*", *(e.alias(f"_b_{k}") for k, e in by.items())) if by else profiles
    names = [f"_b_{k}" for k in by]
    # the moments of a union: sums around one center, here each column's mean over all stored partitions
    center = profiles.groupBy(F.col("column_name").alias("_c")).agg((F.sum(F.col("center") * n) / F.sum(F.when(F.col("center").isNotNull(), n))).alias("_mid"))
    near = keyed.join(F.broadcast(center), F.col("column_name") == F.col("_c")).withColumn("_off", F.col("center") - F.col("_mid"))
    total = near.groupBy(*names, "column_name", "column_type").agg(
        F.sum("num_records").alias("num_records"), F.sum("num_missing").alias("num_missing"), F.sum("num_invalid").alias("num_invalid"),
        F.sum(F.when(F.col("center").isNotNull(), n)).alias("_n"), F.sum(F.col("_off") * n).alias("_s"), F.sum(F.col("squares") + F.col("_off") * F.col("_off") * n).alias("_q"), F.first("_mid", ignorenulls=True).alias("_mid"),
        F.min("low").alias("min"), F.max("high").alias("max"), F.kll_merge_agg_double("quantiles").alias("_k"), F.hll_union_agg("distinct").alias("_d"),
    )
    off = F.try_divide(F.col("_s"), F.col("_n"))
    pcts = F.when(F.col("_n") > 0, F.kll_sketch_get_quantile_double("_k", F.array(*(F.lit(p / 100) for p in PERCENTILES))))
    out = total.withColumns({"mean": F.col("_mid") + off, "stddev": F.when(F.col("_n") > 0, F.sqrt(F.greatest(F.lit(0.0), F.try_divide(F.col("_q"), F.col("_n")) - off * off))), "_p": pcts, "distinct_count": F.hll_sketch_estimate("_d")})
    return out.select(*(F.col(f"_b_{k}").alias(k) for k in by), "column_name", "column_type", "num_records", "num_missing", "num_invalid", "mean", "stddev", "min", "max", *(F.get("_p", F.lit(i)).alias(f"p{p}") for i, p in enumerate(PERCENTILES)), "distinct_count")


def quantile_errors(rows: DataFrame, profiled: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """by, column_name, p, error: how far the rank of each percentile of a profile is from what it stands for, on the rows themselves.

    A value's ranks are the share of rows below it to the share not above it; the error is 0 inside.
    """
    pcts = F.explode(F.array(*(F.struct(F.lit(p).alias("p"), F.col(f"p{p}").alias("q")) for p in PERCENTILES))).alias("x")
    asked = profiled.filter(F.col("column_name").isin(*columns)).select(*by, "column_name", pcts).select(*by, "column_name", "x.*")
    each = rows.select(*by, F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns))).alias("r")).select(*by, "r.*").filter("v is not null")
    counts = each.groupBy(*by, "column_name", "v").agg(F.count("*").alias("n"))
    same = reduce(lambda a, b: a & b, [F.col(f"c.{k}").eqNullSafe(F.col(f"a.{k}")) for k in [*by, "column_name"]])
    ranks = counts.alias("c").join(F.broadcast(asked).alias("a"), same).groupBy(*(F.col(f"a.{k}").alias(k) for k in [*by, "column_name"]), "p").agg((F.sum(F.when(F.col("v") < F.col("q"), F.col("n")).otherwise(0)) / F.sum("n")).alias("low"), (F.sum(F.when(F.col("v") <= F.col("q"), F.col("n")).otherwise(0)) / F.sum("n")).alias("high"))
    share = F.col("p") / 100
    return ranks.select(*by, "column_name", "p", F.greatest(F.lit(0.0), F.col("low") - share, share - F.col("high")).alias("error"))
