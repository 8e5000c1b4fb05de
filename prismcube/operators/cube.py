"""Constrained cubes (A): explicit grouping sets, one- and two-level facts, calendar days, scans."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import redirect_stdout
from functools import reduce
from io import StringIO

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from prismcube.operators.percentiles import exact_percentiles, same_cell
from prismcube.plans.cube_spec import CubeSpec, Derived, Fact
from prismcube.sources.checkpoints import cut

#: Aggregates that keep a sketch or a set for each group; beside a distinct count they would keep one for each value counted.
LARGE_STATE = frozenset({"approx_count_distinct", "percentile", "hist_percentile", "collect_set"})


def fact_input(fact: Fact) -> Column:
    """The value that a fact aggregates, cleaned."""
    if fact.expr:
        value = F.expr(fact.expr)
    elif fact.matches:
        value = F.when(F.col(fact.column or fact.name).rlike(fact.matches), 1).otherwise(0)
    else:
        value = F.col(fact.column or fact.name)
    if fact.when:
        value = F.when(F.expr(fact.when), value)
    if fact.exclude_zeros:
        return F.when(value != 0, value)
    if fact.between:
        return F.when(value.between(*fact.between), value)
    return F.coalesce(value, F.lit(fact.default)) if fact.default is not None else value


def hist_quantiles(hist: Column, pcts: Sequence[int]) -> Column:
    """Quantiles from a histogram's bins (x, y): the first bin that reaches the rank, on the line from the bin before it by the
    share of its rows that the rank takes; in the first bin its centre (A15).

    Histograms of several partitions are put together without merging bins of one value while there is room for all, so
    neighbours with one centre (but for the rounding of its weighted means) count as one bin.
    """
    total = F.aggregate(hist, F.lit(0.0), lambda a, b: a + b["y"])
    none = F.lit(None).cast("double")

    def one(p: int) -> Column:
        rank = total * (p / 100)
        start = F.struct(F.lit(0.0).alias("seen"), none.alias("before"), none.alias("x"), F.lit(0.0).alias("y"), none.alias("q"))

        def reached(a: Column) -> Column:
            """The quantile once the bin that is held is whole."""
            here = F.when(a["before"].isNull(), a["x"]).otherwise(a["before"] + (a["x"] - a["before"]) * (rank - a["seen"]) / a["y"])
            return F.when(a["q"].isNull() & a["x"].isNotNull() & (a["seen"] + a["y"] >= rank), here).otherwise(a["q"])

        def step(a: Column, b: Column) -> Column:
            x, y = b["x"].cast("double"), b["y"].cast("double")
            same = a["x"].isNotNull() & (F.abs(x - a["x"]) <= 1e-9 * F.greatest(F.abs(x), F.abs(a["x"])))
            more = F.struct(a["seen"].alias("seen"), a["before"].alias("before"), a["x"].alias("x"), (a["y"] + y).alias("y"), a["q"].alias("q"))
            new = F.struct((a["seen"] + a["y"]).alias("seen"), a["x"].alias("before"), x.alias("x"), y.alias("y"), reached(a).alias("q"))
            return F.when(same, more).otherwise(new)

        return F.aggregate(hist, start, step, reached)

    return F.when(F.size(hist) > 0, F.array(*(one(p) for p in pcts)))


def fact_aggregate(fact: Fact, value: Column) -> Column:
    """The aggregate of a one-level fact."""
    shares = F.array(*(F.lit(p / 100) for p in fact.pcts)) if fact.pcts else None
    rounded = F.round(value, fact.round_first) if fact.round_first is not None else value
    if fact.error is not None:  # the nearest multiple, halves up
        rounded = F.floor(value / fact.error + 0.5) * F.lit(float(fact.error))
    made = {
        "sum": lambda: F.sum(value),
        "min": lambda: F.min(value),
        "max": lambda: F.max(value),
        "count": lambda: F.count(value),
        "avg": lambda: F.avg(value),
        "stddev": lambda: F.stddev_pop(value),
        "count_distinct": lambda: F.count_distinct(value, *(F.expr(a) for a in fact.args)),
        "approx_count_distinct": lambda: F.approx_count_distinct(value, fact.rsd),
        "percent": lambda: F.avg(100 * value),
        "percentile": lambda: F.percentile(rounded, shares) if fact.exact else F.percentile_approx(rounded, shares, fact.accuracy),
        "hist_percentile": lambda: hist_quantiles(F.histogram_numeric(rounded.cast("double"), F.lit(fact.bins)), fact.pcts),
        "num_missing": lambda: F.sum(F.when(value.isNull(), 1)),
        "num_non_missing": lambda: F.count(value),
        "collect_set": lambda: F.array_sort(F.collect_set(value)),
    }
    return made[fact.agg]()


def spread_percentiles(df: DataFrame, facts: Sequence[Fact]) -> DataFrame:
    """Array facts as one column for each percentile, ``<fact>_<p>th_percentile``."""
    arrays = {f.name: f.pcts for f in facts if f.pcts}
    cols = []
    for c in df.columns:
        cols += [F.get(F.col(c), i).alias(f"{c}_{p}th_percentile") for i, p in enumerate(arrays[c])] if c in arrays else [F.col(c)]
    return df.select(*cols)


def derived(df: DataFrame, post: Sequence[Derived]) -> DataFrame:
    """Columns from finished facts, null outside their range."""
    for d in post:
        value = F.expr(d.expr)
        low, high = d.between or (None, None)
        fits = reduce(lambda a, b: a & b, [value >= low] * (low is not None) + [value <= high] * (high is not None), F.lit(True))
        df = df.withColumn(d.name, F.when(fits, value))
    return df


def one_level(flat: DataFrame, spec: CubeSpec, sets: list[tuple[str, ...]], run: bool = True) -> DataFrame:
    """Cells of facts without partitions: one partial and one final aggregation, but for two kinds of facts.

    Exact percentiles are found by counting in bins, and distinct counts beside facts of large state over the distinct rows;
    the input is then written first. Without run nothing is written, and all facts are one aggregation.
    """
    dims = spec.all_dims
    kind = {f.name: flat.schema[f"_in_{f.name}"].dataType for f in spec.facts}
    exact = [f for f in spec.facts if run and f.agg == "percentile" and f.exact and isinstance(kind[f.name], NumericType)]
    large = any(f.agg in LARGE_STATE for f in spec.facts)
    distinct = [f for f in spec.facts if run and large and f.agg == "count_distinct"]
    flat = cut(flat, "cube") if exact or distinct else flat
    value = lambda f: F.col(f"_in_{f.name}")

    def cells_of(df: DataFrame, aggs: Sequence[Column]) -> DataFrame:
        return df.groupingSets([[F.col(c) for c in s] for s in sets], *(F.col(d) for d in dims)).agg(*aggs)

    rest = [fact_aggregate(f, value(f)).alias(f.name) for f in spec.facts if f not in exact and f not in distinct]
    cells = cells_of(flat, rest or [F.count("*").alias("_rows")])
    parts = []
    for f in exact:
        v = F.round(value(f), f.round_first) if f.round_first is not None else value(f)
        parts.append((f, exact_percentiles(flat, dims, sets, v, f.pcts, f.name)))
    for f in distinct:
        once = flat.select(*dims, value(f), *(F.expr(a).alias(f"_arg_{i}") for i, a in enumerate(f.args))).distinct()
        own = F.count_distinct(value(f), *(F.col(f"_arg_{i}") for i in range(len(f.args)))).alias(f.name)
        parts.append((f, cells_of(once, [own]).dropDuplicates([*dims])))
    for f, part in parts:
        cells = cells.alias("c").join(part.alias("p"), same_cell("c", "p", dims), "left").select("c.*", f"p.{f.name}")
    return cells.select(*dims, *(f.name for f in spec.facts)) if parts else cells


def build_cube(df: DataFrame, spec: CubeSpec, run: bool = True) -> DataFrame:
    """The cube of df: dimensions (null where rolled up), facts, aggregation_depth.

    Only the allowed grouping sets are planned. Dimensions are strings in the cells; a null in the data is told from a
    rolled-up one by a sentinel, and its cells are dropped unless asked for. Exact percentiles are found when this is called.
    """
    dims, sets = spec.all_dims, spec.sets()
    for condition in spec.filters:
        df = df.filter(condition)
    inputs = {f"_in_{f.name}": fact_input(f) for f in spec.facts}
    extra = {c for f in spec.facts for c in df.columns if any(c in a for a in f.args)}
    keys = [F.coalesce(F.col(d).cast("string"), F.lit(spec.null_sentinel)).alias(d) for d in dims]
    parts = [F.col(p) for p in spec.partition_by if p not in dims]
    flat = df.select(*keys, *parts, *(v.alias(k) for k, v in inputs.items()), *(F.col(c) for c in sorted(extra - {*dims, *spec.partition_by})))
    if spec.partition_by:
        cells = two_level(flat, spec, sets)
    else:
        cells = one_level(flat, spec, sets, run)
    if spec.ignore_null_groupings:
        cells = cells.filter(reduce(lambda a, b: a & b, [F.coalesce(F.col(d) != spec.null_sentinel, F.lit(True)) for d in dims]))
    cells = derived(spread_percentiles(cells, spec.facts), spec.post)
    for condition in spec.post_filters:
        cells = cells.filter(condition)
    depth = reduce(lambda a, b: a + b, [F.col(d).isNotNull().cast("int") for d in spec.base_dims])
    return cells.drop(*(f.name for f in spec.facts if f.exclude)).withColumn("aggregation_depth", depth)


def two_level(flat: DataFrame, spec: CubeSpec, sets: list[tuple[str, ...]]) -> DataFrame:
    """Cells over partitions: level 1 for each cell and partition, level 2 over the partitions of a cell."""
    dims, parts = spec.all_dims, [p for p in spec.partition_by if p not in spec.all_dims]
    first = []
    for f in spec.facts:
        value = F.col(f"_in_{f.name}")
        first.append((F.avg(100 * value) if f.agg == "percentile_of_percentages" else F.approx_count_distinct(value, f.rsd)).alias(f.name))
    own = flat.groupingSets([[F.col(c) for c in (*s, *parts)] for s in sets], *(F.col(c) for c in (*dims, *parts))).agg(F.grouping_id().alias("_set"), *first)
    second = []
    for f in spec.facts:
        if f.agg == "percentile_of_percentages":
            shares = F.array(*(F.lit(p / 100) for p in f.pcts))
            second.append((F.percentile(f.name, shares) if f.exact else F.percentile_approx(f.name, shares, min(f.accuracy, 2000))).alias(f.name))
        else:
            second.append(F.sum(f.name).alias(f.name))
    return own.groupBy("_set", *dims).agg(*second).drop("_set")


def calendar_rollup(spark: SparkSession, start: str, end: str) -> DataFrame:
    """yr_cd, qtr_cd, mnth_cd, wk_cd, days: numbers of days of each year, quarter, month and ISO week from start to end."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("d"))
    year = F.year("d").cast("string")
    coded = days.select(
        year.alias("yr_cd"),
        F.concat(year, F.lit("Q"), F.quarter("d").cast("string")).alias("qtr_cd"),
        F.date_format("d", "yyyyMM").alias("mnth_cd"),
        F.concat(F.extract(F.lit("YEAROFWEEK"), F.col("d")).cast("string"), F.lit("W"), F.lpad(F.weekofyear("d").cast("string"), 2, "0")).alias("wk_cd"),
    )
    y, q, m, w = (F.col(c) for c in ("yr_cd", "qtr_cd", "mnth_cd", "wk_cd"))
    return coded.groupingSets([[y], [y, q], [y, q, m], [w]], y, q, m, w).agg(F.count("*").alias("days"))


def with_calendar_days(cube: DataFrame, calendar: DataFrame, levels: Sequence[str] = ("yr_cd", "qtr_cd", "mnth_cd")) -> DataFrame:
    """cube and sys_calendar_days: the days of the period that a cell's time columns name; time levels it lacks must be null.

    The calendar has a row for each period, so a century of it is a few thousand rows; it is joined null-safely.
    """
    unused = [c for c in ("yr_cd", "qtr_cd", "mnth_cd", "wk_cd") if c not in levels]
    for c in unused:
        calendar = calendar.filter(F.col(c).isNull())
    small = calendar.select(*(F.col(c).alias(f"_{c}") for c in levels), F.col("days").alias("sys_calendar_days"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in levels])
    return cube.join(small, same, "left").drop(*(f"_{c}" for c in levels))


def scan_dimensions(df: DataFrame, spec: CubeSpec, numeric_limit: int = 200, limit: int = 1500, size_limit: float = 2e11) -> DataFrame:
    """dimension, cardinality, warning: distinct counts of dimensions and hierarchies and the cube's potential size.

    One pass: each dimension or hierarchy is a distinct count of a struct. A clean scan has no warnings; it never stops a build.
    """
    tails = {c for h in spec.hierarchies for c in h}
    groups = [(d,) for d in spec.all_dims if d not in tails] + list(spec.hierarchies)
    numeric = {c for c, t in df.dtypes if t in ("int", "bigint", "double", "float", "smallint", "tinyint") or t.startswith("decimal")}
    counts = df.agg(*(F.count_distinct(F.struct(*g)).alias("__".join(g)) for g in groups))
    rows = counts.select(F.explode(F.array(*(F.struct(F.lit(" > ".join(g)).alias("dimension"), F.col(f"`{'__'.join(g)}`").alias("cardinality"), F.lit(len(g) == 1 and g[0] in numeric).alias("numeric")) for g in groups))).alias("r")).select("r.*")
    warning = F.when(F.col("numeric") & (F.col("cardinality") > numeric_limit), "numeric dimension of many values").when(F.col("cardinality") > limit, "dimension of many values")
    each = rows.select("dimension", F.col("cardinality").cast("double").alias("cardinality"), warning.alias("warning"))
    size = rows.agg(F.product(F.col("cardinality") + 1).alias("cardinality")).select(F.lit("(cells)").alias("dimension"), "cardinality", F.when(F.col("cardinality") > size_limit, "cube may be too large").alias("warning"))
    return each.unionByName(size)


def binned_percentile(df: DataFrame, by: Sequence[str], column: str, width: float, low: float, high: float, pcts: Sequence[int]) -> DataFrame:
    """by, p<pct>: the lower bound of the fixed-width bin that holds each percentile, values clamped to [low, high].

    Two stages: counts by bin, then a running sum over the bins of a group, of which there are (high - low) / width at most.
    """
    from pyspark.sql import Window

    value = F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), F.col(column).cast("double")))
    bins = df.filter(F.col(column).isNotNull()).groupBy(*by, (F.floor(value / width) * width).cast("double").alias("_bin")).agg(F.count("*").alias("_n"))
    group = Window.partitionBy(*by)
    seen = bins.withColumns({"_seen": F.sum("_n").over(group.orderBy("_bin")), "_all": F.sum("_n").over(group)})
    return seen.groupBy(*by).agg(*(F.min(F.when(F.col("_seen") * 100 >= F.col("_all") * p, F.col("_bin"))).alias(f"p{p}") for p in pcts))


def distribute(df: DataFrame, spec: CubeSpec, distribute_by: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    """The cube's input, dealt by given columns; else by the mandatory dimensions if they have about as many values as there
    are shuffle partitions (0.7 of them or more); else left to adaptive execution. A row limit is the test mode (A29)."""
    if not distribute_by and spec.mandatory:
        values = df.select(*spec.mandatory).distinct().count()
        distribute_by = spec.mandatory if values >= 0.7 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else ()
    df = df.repartition(*distribute_by) if distribute_by else df
    return df.limit(limit) if limit else df


def explain_cube(df: DataFrame, spec: CubeSpec) -> str:
    """The plan of a cube as text: the mode that runs nothing (A29); all facts are shown as one aggregation."""
    with redirect_stdout(StringIO()) as text:
        build_cube(df, spec, run=False).explain("formatted")
    return text.getvalue()
