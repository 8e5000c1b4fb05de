"""Work over groups that hold much of all rows: running sums, ranks, carried values, intervals, correlations."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from prismcube.operators.insight import Dim, InsightSpec, correlate_facts, correlation_rows, rank_cells
from prismcube.operators.ordered import PART, carried, in_ranges, percent_ranks, running_totals


def hot(rnd, n):
    """Half of the rows in one group, some in the null one."""
    return [(i, "hot" if i % 2 else rnd.choice(["a", "b", None]), rnd.choice([None, *range(30)])) for i in range(n)]


def brute_ranks(data):
    out = {}
    for i, g, v in data:
        own = [x for _, h, x in data if h == g]
        less = sum(x is None and v is not None or x is not None and v is not None and x < v for x in own)
        out[i] = less / (len(own) - 1) if len(own) > 1 else 0.0
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_percent_ranks(spark, parts):
    data = [*hot(random.Random(1), 1200), (5000, "alone", 3), (5001, "none", None), (5002, "none", None)]
    df = spark.createDataFrame(data, "i int, g string, v int").withColumn("w", F.col("v") * -1.0)
    got = {r["i"]: (r["p"], r["q"]) for r in percent_ranks(df, ["g"], {"v": "p", "w": "q"}, parts).collect()}
    up, down = brute_ranks(data), brute_ranks([(i, g, None if v is None else -v) for i, g, v in data])
    assert got.keys() == up.keys()
    assert all(got[i] == pytest.approx((up[i], down[i])) for i in got)


def test_one_group_with_all_rows_is_ranked_by_many_tasks(spark):
    df = spark.range(40_000).select(F.lit("one").alias("g"), F.xxhash64("id").alias("v"))
    ranges = in_ranges(df, ["g"], ["v"], 16).groupBy(PART).count().collect()
    assert len(ranges) == 16 and max(r["count"] for r in ranges) < 3 * 40_000 / 16
    got = percent_ranks(df, ["g"], {"v": "p"}, 16)
    assert got.selectExpr("count(*) AS n", "count(DISTINCT p) AS d", "min(p) AS a", "max(p) AS z").first()[:] == (40_000, 40_000, 0.0, 1.0)


@pytest.mark.parametrize("parts", [1, 5])
def test_running_totals_and_carried_values(spark, parts):
    rnd = random.Random(2)
    data = [(i, g, v) for i, g, v in hot(rnd, 900)]
    df = spark.createDataFrame(data, "i int, g string, v int")
    sums = {r["i"]: r["s"] for r in running_totals(df, ["g"], ["i"], F.coalesce("v", F.lit(0)), "s", parts).collect()}
    last = {r["i"]: r["l"] for r in carried(df, ["g"], ["i"], F.when(F.col("v") > 27, F.col("v")), "l", parts).collect()}
    total, held = {}, {}
    for i, g, v in data:
        assert sums[i] == total.get(g, 0)
        total[g] = total.get(g, 0) + (v or 0)
        held[g] = v if v is not None and v > 27 else held.get(g)
        assert last[i] == held[g]


def test_ranks_of_cells_in_one_group(spark):
    rnd = random.Random(3)
    data = [(1, f"c{i}", rnd.choice([None, 0.0, -1.0, *map(float, range(9))])) for i in range(300)]
    df = spark.createDataFrame(data, "p int, c string, f double")
    spec = InsightSpec(dims=(Dim("p", "ephemeral", (1,)), Dim("c", "nullvariant", percentile=True)), facts=("f",), group=("p",))
    got = {r["c"]: r for r in rank_cells(df, spec).collect()}
    up = brute_ranks([(c, p, f) for p, c, f in data])
    have = [f for _, _, f in data if f is not None]
    for _, c, f in data:
        assert got[c]["percentile_f"] == pytest.approx(100 * up[c])
        assert (got[c]["min_f"], got[c]["max_f"]) == (min(have), max(have))
        assert got[c]["mean_f"] == pytest.approx(np.mean(have)) and got[c]["stddev_f"] == pytest.approx(np.std(have))


# --- correlations (C2, C3) --------------------------------------------------------------------------------------------


def test_many_facts_in_one_aggregation(spark):
    """60 facts and 4 lags: equal to corr() on the pairs that are looked at, with one exchange for the sums."""
    rnd = np.random.default_rng(4)
    n, facts = 200, [f"f{i}" for i in range(60)]
    x = rnd.normal(0, 1, (n, 60)).cumsum(axis=0) + 1e6
    gaps = rnd.random((n, 60)) < 0.1
    data = [("hot" if i % 2 else [None, "b"][i % 4 // 2], i, *(None if gaps[i, j] else float(x[i, j]) for j in range(60))) for i in range(n)]
    df = spark.createDataFrame(data, f"g string, t int, {', '.join(f'{f} double' for f in facts)}")
    rows = correlation_rows(df, facts, ["g"], order=["t"], leads=[1, 2, 3, 4])
    got = {(r["g"], r["fact"], r["other"], r["lag"]): (r["corr"], r["n"]) for r in rows.collect()}
    assert len(got) == 3 * (60 * 59 // 2) * 5
    from prismcube.operators.insight import lead_facts

    led = lead_facts(df, facts, ["g"], ["t"], [1, 2, 3, 4])
    pairs = [("f0", "f1", 0), ("f0", "f1", 4), ("f3", "f59", 2), ("f57", "f58", 1), ("f58", "f59", 3)]
    other = lambda b, k: b if k == 0 else f"{b}_lead_{k}"
    exact = led.groupBy("g").agg(*(e for a, b, k in pairs for e in (F.round(F.corr(a, other(b, k)), 4).alias(f"c_{a}_{b}_{k}"), F.count_if(F.col(a).isNotNull() & F.col(other(b, k)).isNotNull()).alias(f"n_{a}_{b}_{k}"))))
    for r in exact.collect():
        for a, b, k in pairs:
            assert got[(r["g"], a, b, k)] == pytest.approx((r[f"c_{a}_{b}_{k}"], r[f"n_{a}_{b}_{k}"]), abs=1e-4)


def test_correlations_of_few_values(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, 5.0), ("a", 2.0, 4.0, 5.0), ("a", None, 9.0, 5.0), ("b", 1.0, 1.0, 1.0), (None, 1.0, None, 2.0)], "g string, x double, y double, z double")
    got = {r["g"]: r for r in correlate_facts(df, ["x", "y", "z"], ["g"]).collect()}
    assert got["a"]["corr_x_y"] == [1.0] and got["a"]["n_x_y"] == [2] and got["a"]["n_y_z"] == [3] and got["a"]["corr_y_z"] == [None]
    numbered = spark.createDataFrame([(1, 1.0, 2.0), (None, 1.0, 3.0), (None, 2.0, 5.0), (1, 3.0, 1.0), (1, 4.0, 1.0)], "g int, x double, y double").repartition(3)
    assert {(r["g"], r["corr"], r["n"]) for r in correlation_rows(numbered, ["x", "y"], ["g"]).collect()} == {(1, -0.9449, 3), (None, 1.0, 2)}
    assert correlation_rows(numbered.filter("false"), ["x", "y"], ["g"]).count() == 0 and correlation_rows(numbered, ["x", "y"], []).count() == 1
    assert got["b"]["corr_x_y"] == [None] and got[None]["n_x_y"] == [0] and got[None]["n_x_z"] == [1] and got["a"]["n_records"] == 3


# --- intervals (M2, M3) -----------------------------------------------------------------------------------------------


def some_intervals(rnd, n, longest):
    """Half under one key; null keys and bounds, empty and reversed ones."""
    out = []
    for i in range(n):
        low = rnd.randrange(-500, 500)
        out.append((i, "hot" if i % 2 else rnd.choice(["a", "b", None]), rnd.choice([None, low, low, low, low]), low + rnd.choice([0, 1, 2, rnd.randrange(-2, longest)])))
    return out


@pytest.mark.parametrize("longest", [3, 40, 900])
def test_contained_equals_brute_force(spark, longest):
    from prismcube.operators.intervals import join_contained, join_point_in_interval

    rnd = random.Random(longest)
    a, b = some_intervals(rnd, 300, 60), some_intervals(rnd, 200, longest)
    left = spark.createDataFrame(a, "i int, k string, start int, end int")
    right = spark.createDataFrame(b, "j int, k string, start int, end int")
    fits = lambda x, y: x[1] is not None and x[1] == y[1] and None not in (x[2], y[2]) and x[2] <= x[3] and y[2] <= x[2] and x[3] <= y[3]
    expected = sorted((x[0], y[0]) for x in a for y in b if fits(x, y))
    assert sorted((r["i"], r["j_b"]) for r in join_contained(left, right, ["k"]).collect()) == expected
    when = lambda df: df.select(*(F.timestamp_seconds(c).alias(c) if c in ("start", "end") else c for c in df.columns))
    assert sorted((r["i"], r["j_b"]) for r in join_contained(when(left), when(right), ["k"]).collect()) == expected
    points = left.select("i", "k", F.col("start").alias("at"))
    held = sorted((x[0], y[0]) for x in a for y in b if x[1] is not None and x[1] == y[1] and None not in (x[2], y[2]) and y[2] <= x[2] <= y[3])
    assert sorted((r["i"], r["j"]) for r in join_point_in_interval(points, right, ["k"], "at").collect()) == held
    assert join_contained(left, right.filter("false"), ["k"]).count() == 0


@pytest.mark.parametrize("parts", [1, 6])
def test_points_in_disjoint_intervals(spark, parts):
    from prismcube.operators.intervals import join_point_in_disjoint

    rnd = random.Random(parts)
    spans = []
    for k in ("hot", "a", "b"):
        at = 0
        for _ in range(150 if k == "hot" else 40):
            at += rnd.choice([0, 0, 1, 5])
            end = at + rnd.choice([0, 0, 3, 9])
            spans.append((len(spans), k, at, end))
            at = end
    spans += [(900, None, 0, 99), (901, "a", None, 3), (902, "hot", 5000, 4000)]
    points = [(i, "hot" if i % 2 else rnd.choice(["a", "b", "c", None]), rnd.choice([None, *range(-5, 700)])) for i in range(900)]
    points += [(1000 + i, "hot", 44) for i in range(300)]  # very many equal points
    p, s = spark.createDataFrame(points, "i int, k string, at int"), spark.createDataFrame(spans, "j int, k string, start int, end int")
    expected = sorted((i, j) for i, k, at in points for j, h, low, high in spans if k is not None and k == h and None not in (at, low) and low <= at <= high)
    got = join_point_in_disjoint(p, s, ["k"], "at", parts=parts)
    assert got.columns == ["i", "k", "at", "j", "start", "end"]
    assert sorted((r["i"], r["j"]) for r in got.collect()) == expected
    assert join_point_in_disjoint(p.filter("false"), s, ["k"], "at").count() == 0


def test_pairs_that_meet_follow_the_result(spark):
    """One key with all rows: the pairs that are compared stay near those that are returned."""
    from prismcube.operators.intervals import near

    a = spark.range(20_000).select(F.lit("k").alias("k"), (F.col("id") * 10).alias("start"), (F.col("id") * 10 + 3).alias("end"))
    b = spark.range(5_000).select(F.lit("k").alias("k"), (F.col("id") * 40).alias("s"), (F.col("id") * 40 + 35).alias("e"))
    met = near(a, b, ["k"], ("start", "end"), ("s", "e"))
    inside = met.filter("start >= s AND end <= e").count()
    assert inside == 20_000 and met.count() <= 6 * inside
