"""Profiles kept per partition."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from prismcube.operators import shape, sketches


def plan_of(df):
    from contextlib import redirect_stdout
    from io import StringIO

    with redirect_stdout(StringIO()) as text:
        df.explain("formatted")
    return text.getvalue()


def data(spark, n=6000):
    rnd = random.Random(8)
    rows = [("hot" if i % 2 else rnd.choice(["a", "b", None]), rnd.choice([None, 1e9 + rnd.gauss(0, 3), 1e9 + rnd.expovariate(0.1)]), rnd.choice(["x", " x", None, f"v{rnd.randrange(3000)}"]), None) for i in range(n)]
    return spark.createDataFrame(rows, "p string, v double, s string, nothing double")


def test_merged_equals_whole(spark, tmp_path):
    df, store = data(spark), f"{tmp_path}/store"
    assert sketches.collect_profiles(df, store, ["p"]) == 4
    kept = sketches.stored(spark, store, ["p"])
    got = {r["column_name"]: r for r in sketches.merged(kept).collect()}
    exact = {r["column_name"]: r for r in shape.profile(df.drop("p"), exact=True).collect()}
    assert got.keys() == exact.keys()
    for c, r in exact.items():
        for k in ("num_records", "num_missing", "num_invalid", "min", "max"):
            assert got[c][k] == r[k]
        for k in ("mean", "stddev"):
            assert got[c][k] == (r[k] if r[k] is None else pytest.approx(r[k], rel=1e-6))
        assert abs(got[c]["distinct_count"] - r["distinct_count"]) <= 1 + sketches.DISTINCT_ERROR * r["distinct_count"]
    errors = sketches.quantile_errors(df, sketches.merged(kept), ["v"])
    assert errors.count() == len(shape.PERCENTILES) and errors.agg(F.max("error")).first()[0] <= sketches.RANK_ERROR


def test_runs(spark, tmp_path):
    df, store = data(spark, 400), f"{tmp_path}/store"
    run = lambda rows, **how: sketches.collect_profiles(rows, store, ["p"], analyze=["v"], **how)
    assert run(df.filter("false")) == 0
    assert run(df.filter("p = 'a'")) == 1
    assert run(df) == 3 and run(df) == 0
    changed = df.withColumn("v", F.lit(5.0))
    assert run(changed) == 0
    assert run(changed, only="b") == 0 and run(changed, only="b", rerun=True) == 1
    of = lambda: {r["p"]: r["center"] for r in sketches.stored(spark, store, ["p"]).collect()}
    assert of()["b"] == 5.0 and of()["a"] > 1e8 and None in of()
    assert run(changed, rerun=True) == 4 and {*of().values()} == {5.0}


def test_old_partitions_are_not_read(spark, tmp_path):
    """A table that is partitioned by the period: the scan for a new one lists that one only."""
    at = f"{tmp_path}/t"
    spark.range(40).select("id", (F.col("id") % 4).alias("p")).write.partitionBy("p").parquet(at)
    df = spark.read.parquet(at)
    known = spark.createDataFrame([("0",), ("1",), ("3",)], "p string")
    rows = sketches.lacking(df, known, ["p"])
    assert {r["p"] for r in rows.collect()} == {2}
    assert re.search(r"PartitionFilters: \[[^\]]*= 2\)", plan_of(rows))
