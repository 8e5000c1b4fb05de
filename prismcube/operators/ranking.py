"""Recommender features, bandit statistics and rankings (D)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prismcube.sources.checkpoints import cut


def dimension_key(dims: Sequence[str], values: Sequence[str] = ()) -> Column:
    """The names of the set dimensions, sorted, joined by _, then the values of other columns."""
    names = F.array_sort(F.filter(F.array(*(F.when(F.col(d).isNotNull(), d) for d in dims)), lambda x: x.isNotNull()))
    return F.concat_ws("_", names, *(F.coalesce(F.col(v).cast("string"), F.lit("")) for v in values))


def label_encode(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Codes from 0 by falling frequency, ties by value; null stays null (D3).

    Values are dealt in ranges of that order; a code is the place inside the range plus the values of the ranges before,
    so no task numbers all values.
    """
    n = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v")).agg(F.count("*").alias("_n"))
    dealt = cut(n.repartitionByRange(F.col("_n").desc(), "_v").withColumn("_p", F.spark_partition_id()), "codes")
    ranges = dealt.groupBy("_p").agg(F.count("*").alias("_size"))  # a row for each partition
    before = ranges.select("_p", (F.sum("_size").over(Window.orderBy("_p")) - F.col("_size")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_p").orderBy(F.col("_n").desc(), "_v")) - 1
    codes = dealt.withColumn("_place", place).join(F.broadcast(before), "_p").select("_v", (F.col("_place") + F.col("_before")).cast("int").alias(out or f"{column}_code"))
    return df.join(codes, F.col(column) == F.col("_v"), "left").drop("_v")


def one_hot(df: DataFrame, column: str, values: Sequence[str] | None = None) -> DataFrame:
    """A 0/1 column for each value, given or found; nulls give zeros (D4). Values are columns, so there must be few."""
    found = values if values is not None else sorted(str(r[0]) for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(1001).collect())
    if len(found) > 1000:
        raise ValueError(f"{column} has over 1000 values")
    return df.withColumns({f"{column}_{v}": F.coalesce((F.col(column).cast("string") == v).cast("int"), F.lit(0)) for v in found})


def update_arm_stats(events: DataFrame, previous: DataFrame, rate: float, as_of: str, days: int = 7) -> DataFrame:
    """arm, clicks, misses: what the last days brought plus the decayed totals before (D5). events: arm, at, clicked."""
    since = F.lit(as_of).cast("timestamp") - F.expr(f"interval {days} days")
    recent = events.filter((F.col("at") > since) & (F.col("at") <= F.lit(as_of).cast("timestamp")))
    new = recent.groupBy("arm").agg(F.count_if("clicked").alias("_c"), F.count_if(~F.col("clicked")).alias("_m"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return previous.join(new, "arm", "full").select("arm", (zero(F.col("_c")) + zero(F.col("clicks")) * rate).alias("clicks"), (zero(F.col("_m")) + zero(F.col("misses")) * rate).alias("misses"))


def uniforms(key: np.ndarray, stream: int) -> np.ndarray:
    """Numbers in (0, 1), one for each key, that depend on key and stream alone: the bits of a mixed counter."""
    u = np.uint64
    x = key + u((stream + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> u(30))) * u(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> u(27))) * u(0x94D049BB133111EB)
    return ((x ^ (x >> u(31))) >> u(11)).astype(float) / (1 << 53) + 2.0**-54


def gammas(shape: np.ndarray, key: np.ndarray, stream: int) -> np.ndarray:
    """Gamma draws of shapes of 1 or more by rejection (Marsaglia and Tsang), all keys at once."""
    d = shape - 1 / 3
    c, out, left, turn = 1 / np.sqrt(9 * d), np.empty(len(shape)), np.arange(len(shape)), 0
    while len(left):
        one, two, three = (uniforms(key[left], (stream << 20) + 3 * turn + i) for i in range(3))
        normal = np.sqrt(-2 * np.log(one)) * np.cos(2 * np.pi * two)
        v = (1 + c[left] * normal) ** 3
        with np.errstate(invalid="ignore", divide="ignore"):
            fits = (v > 0) & (np.log(three) < 0.5 * normal**2 + d[left] * (1 - v + np.log(v)))
        out[left[fits]] = (d[left] * v)[fits]
        left, turn = left[~fits], turn + 1
    return out


def thompson_rank(arms: DataFrame, by: Sequence[str], seed: int, most: int = 500) -> DataFrame:
    """arms, draw, arm_rank: a beta(clicks + 1, misses + 1) draw for each arm, best first.

    Counts beyond ``most`` pulls are scaled down. A draw depends on the seed and the arm alone, so a task that runs again
    draws the same. The arms of a group are ranked in one task: they are the choices of one place, some thousands at most.
    """
    n = F.col("clicks") + F.col("misses")
    scale = F.when(n > most, most / n).otherwise(1.0)

    @F.pandas_udf("double")
    def draw(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b, key in parts:
            own = key.to_numpy(np.int64).view(np.uint64)
            good, bad = (gammas(x.to_numpy(float) + 1, own, 2 * seed + i) for i, x in enumerate((a, b)))
            yield pd.Series(good / (good + bad))

    drawn = arms.withColumn("draw", draw(F.col("clicks") * scale, F.col("misses") * scale, F.xxhash64(*by, "arm")))
    return drawn.withColumn("arm_rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.col("draw").desc(), "arm")))


def rerank(df: DataFrame, by: Sequence[str], score: str, metric: str, key: str, pick: str, top: int = 4, size: str | None = None, seed: int | None = None) -> DataFrame:
    """df, is_bandit and position: the best rows of ``top`` distinct metrics, then the bandit's pick, then the rest by score.

    The pick is, of the rows not at the top, that of the largest ``pick`` (an arm's draw); of an arm's rows that of the largest
    ``size``. With a seed it is put in a drawn place before, between or after the top rows, the same in every run for
    a group and seed. Ties go by key.
    """
    group = Window.partitionBy(*by)
    order = [F.col(score).desc(), F.col(key)]
    first = df.withColumn("_own", F.row_number().over(Window.partitionBy(*by, metric).orderBy(*order)))
    first = first.withColumn("_head", F.when(F.col("_own") == 1, F.row_number().over(Window.partitionBy(*by, "_own").orderBy(*order))))
    first = first.withColumn("_top", F.coalesce(F.col("_head") <= top, F.lit(False)))
    chosen = [F.col(pick).desc(), *([F.col(size).desc()] if size else []), F.col(key)]
    first = first.withColumn("is_bandit", ~F.col("_top") & (F.row_number().over(Window.partitionBy(*by, "_top").orderBy(*chosen)) == 1))
    tops = F.sum(F.col("_top").cast("int")).over(group)
    drawn = F.pmod(F.xxhash64(F.lit(seed), *by), tops + 1) if seed is not None else tops
    place = F.when(F.col("_top"), F.col("_head").cast("double")).when(F.col("is_bandit"), drawn + 0.5).otherwise(tops + 1.0)
    first = first.withColumn("_place", place)
    return first.withColumn("position", F.row_number().over(group.orderBy("_place", *order))).drop("_own", "_head", "_top", "_place")


def recent_counts(events: DataFrame, user: str, at: str, metric: str, days: int) -> DataFrame:
    """user, metric, n: events within ``days`` of that user's own latest event."""
    last = events.groupBy(user).agg(F.max(at).alias("_last"))
    near = events.join(last, user).filter(F.col(at) >= F.col("_last") - F.expr(f"interval {days} days"))
    return near.groupBy(user, metric).agg(F.count("*").alias("n"))


def time_grain(df: DataFrame, quarter: str, month: str, at: str) -> DataFrame:
    """grain (month, quarter or year, by which code a row has) and grain_weight by the month of the row's date.

    A month weighs 1, a year 1/month, a quarter 1, 2/3 and 1/3 in its first, second and third month; without a date 1.
    """
    m = F.month(at)
    given = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) != ""
    grain = F.when(given(month), "month").when(given(quarter), "quarter").otherwise("year")
    weight = F.when(F.col("grain") == "year", 1 / m).when(F.col("grain") == "quarter", F.when(m % 3 == 0, 1 / 3).when(m % 3 == 2, 2 / 3).otherwise(1.0))
    return df.withColumn("grain", grain).withColumn("grain_weight", F.coalesce(weight, F.lit(1.0)))


def coalesce_score(rules: DataFrame, scored: DataFrame, key: str, score: str) -> DataFrame:
    """rules with the batch model's score where there is one."""
    s = scored.select(F.col(key), F.col(score).alias("_s"))
    return rules.join(s, key, "left").withColumn(score, F.coalesce("_s", score)).drop("_s")


def time_split(df: DataFrame, at: str, as_of: str, key: str, days: int = 90, test_days: int = 15, validation: float = 0.2) -> DataFrame:
    """Rows of the last days with ``fold``: test for the latest ones, a fifth of the rest validation, else train.

    The fold of a row follows from its key (the first eight hexadecimal digits of its MD5, modulo 1000), so it is the same in
    every run; rows without a key are for training.
    """
    end = F.lit(as_of).cast("timestamp")
    since = lambda d: end - F.expr(f"interval {d} days")
    own = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % 1000 < int(1000 * validation)
    fold = F.when(F.col(at) > since(test_days), "test").when(own, "validation").otherwise("train")
    return df.filter((F.col(at) > since(days)) & (F.col(at) <= end)).withColumn("fold", fold)


def train_ranker(train: DataFrame, test: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str, rounds: int = 10, seed: int = 7) -> tuple[object, dict[str, float]]:
    """A fitted pipeline (median fill, robust scaling, one-hot codes, boosted trees) and its accuracy, F1 and AUC on test."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
    from pyspark.ml.feature import Imputer, OneHotEncoder, RobustScaler, StringIndexer, VectorAssembler

    filled = [f"{c}_filled" for c in numeric]
    stages = [Imputer(strategy="median", inputCols=[*numeric], outputCols=filled), VectorAssembler(inputCols=filled, outputCol="_numbers"), RobustScaler(inputCol="_numbers", outputCol="_scaled")]
    parts = ["_scaled"]
    for c in categorical:
        stages += [StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep"), OneHotEncoder(inputCol=f"{c}_index", outputCol=f"{c}_hot")]
        parts.append(f"{c}_hot")
    stages += [VectorAssembler(inputCols=parts, outputCol="features"), GBTClassifier(labelCol=label, maxIter=rounds, seed=seed)]
    cast = lambda d: d.withColumns({c: F.col(c).cast("double") for c in numeric} | {label: F.col(label).cast("double")})
    model = Pipeline(stages=stages).fit(cast(train))
    scored = model.transform(cast(test))
    of = lambda name: MulticlassClassificationEvaluator(labelCol=label, metricName=name).evaluate(scored)
    return model, {"accuracy": of("accuracy"), "f1": of("f1"), "auc": BinaryClassificationEvaluator(labelCol=label).evaluate(scored)}
