"""Bias metrics of a prediction against protected classes (H)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bias_metrics(df: DataFrame, dims: Sequence[str], groups: Sequence[str] = (), y: str = "y", y_hat: str = "y_hat") -> DataFrame:
    """group_name, group_value, dim_name, dim_value, n and means, each also minus the mean over the *other* classes of the group (H1-H3).

    One pass over sums and counts for each class, then (S - s) / (N - n) within the group; no job for each class. Without
    groups there is one, ``all``. ``equal_opportunity`` is the prediction's mean at y = 1 and ``mis_opportunity`` at y <> 1,
    both minus the others'. A missing column is an error; a null class is one of its own.
    """
    if missing := {*dims, *groups, y, y_hat} - {*df.columns}:
        raise ValueError(f"no such columns: {sorted(missing)}")
    pairs = [F.struct(F.lit(g).alias("group_name"), (F.col(g).cast("string") if g != "all" else F.lit("all")).alias("group_value"), F.lit(d).alias("dim_name"), F.col(d).cast("string").alias("dim_value")) for g in groups or ("all",) for d in dims]
    rows = df.select(F.explode(F.array(*pairs)).alias("k"), F.col(y).cast("double").alias("y"), F.col(y_hat).cast("double").alias("h")).select("k.*", "y", "h")
    one = F.col("y") == 1
    parts: dict[str, tuple[Column, Column]] = {
        "target": (F.col("y"), F.lit(True)),
        "prediction": (F.col("h"), F.lit(True)),
        "residual": (F.col("y") - F.col("h"), F.lit(True)),
        "equal_opportunity": (F.col("h"), one),
        "mis_opportunity": (F.col("h"), ~one),
    }
    keys = ["group_name", "group_value", "dim_name"]
    cells = rows.groupBy(*keys, "dim_value").agg(F.count("*").alias("n"), *(x for k, (v, c) in parts.items() for x in (F.sum(F.when(c, v)).alias(f"s_{k}"), F.count(F.when(c, v)).alias(f"n_{k}"))))
    whole = cells.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(*(x for k in parts for x in (F.sum(f"s_{k}").alias(f"all_s_{k}"), F.sum(f"n_{k}").alias(f"all_n_{k}"))))
    both = cells.join(whole, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]))
    mean = lambda k: F.try_divide(F.col(f"s_{k}"), F.col(f"n_{k}"))
    rest = lambda k: F.try_divide(F.col(f"all_s_{k}") - F.coalesce(F.col(f"s_{k}"), F.lit(0.0)), F.col(f"all_n_{k}") - F.col(f"n_{k}"))
    out = [x for k in ("target", "prediction", "residual") for x in (mean(k).alias(f"{k}_mean"), (mean(k) - rest(k)).alias(f"{k}_bias"))]
    return both.select(*keys, "dim_value", "n", *out, *((mean(k) - rest(k)).alias(k) for k in ("equal_opportunity", "mis_opportunity")))


def flag_thresholds(metrics: DataFrame, limit: float = 0.1) -> DataFrame:
    """metrics and ``flagged``: whether the prediction's bias is beyond the limit."""
    return metrics.withColumn("flagged", F.coalesce(F.abs("prediction_bias") > limit, F.lit(False)))


def stamp_period(df: DataFrame, as_of: str, freq: str, seen: DataFrame | None = None) -> DataFrame:
    """df with period (yyyy, yyyyQn or yyyyMM), version v<n> (one more than the largest of that period in ``seen``) and a row id (H4)."""
    day = F.lit(as_of).cast("date")
    year = F.year(day).cast("string")
    period = {"yearly": year, "quarterly": F.concat(year, F.lit("Q"), F.quarter(day).cast("string")), "monthly": F.date_format(day, "yyyyMM")}[freq]
    out = df.withColumn("period", period)
    if seen is None:
        return out.withColumn("version", F.lit("v1")).withColumn("row_id", F.md5(F.to_json(F.struct(*out.columns, F.lit("v1")))))
    last = seen.groupBy("period").agg(F.max(F.substring("version", 2, 10).try_cast("int")).alias("_v"))
    out = out.join(last, "period", "left").withColumn("version", F.concat(F.lit("v"), (F.coalesce("_v", F.lit(0)) + 1).cast("string"))).drop("_v")
    return out.withColumn("row_id", F.md5(F.to_json(F.struct(*out.columns))))
