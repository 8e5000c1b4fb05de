"""Analytic patterns over facts, intervals and insight rows (M)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def safe_keys(a: str, b: str, keys: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys], F.lit(True))


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by the order columns (M1): an aggregate of whole rows, so each key is summed up before the shuffle.

    Rows equal in all order columns are told apart by their remaining columns, so the result is the same each time.
    """
    rest = [c for c in df.columns if c not in {*keys, *order}]
    return df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_r")).select(*keys, *(F.col("_r")[c].alias(c) for c in [*order, *rest])).select(*df.columns)


def join_overlap(a: DataFrame, weeks: DataFrame, start: str, end: str, week_start: str = "wk_start", week_end: str = "wk_end") -> DataFrame:
    """a's rows, one for each calendar week that they touch, and overlap_days.

    Each interval is exploded into the Mondays that it touches, so the range join becomes an equi-join on the week.
    """
    monday = lambda c: F.date_trunc("week", F.col(c)).cast("date")
    each = a.filter(F.col(start) <= F.col(end)).withColumn("_week", F.explode(F.sequence(monday(start), monday(end), F.expr("interval 7 days"))))
    joined = each.join(weeks.withColumn("_week", monday(week_start)), "_week").drop("_week")
    days = F.datediff(F.least(F.col(end).cast("date"), F.col(week_end)), F.greatest(F.col(start).cast("date"), F.col(week_start))) + 1
    return joined.withColumn("overlap_days", days).filter("overlap_days > 0")


def retention(df: DataFrame, key: str, start: str, end: str, dims: Sequence[str], periods: Mapping[str, str], first: str, last: str) -> DataFrame:
    """period, dims (null: all), period_start, active, retained: keys active when a period begins and still when it ends (M4).

    periods maps names to date_trunc units. Each interval is exploded into the starts of the periods in which it was active.
    """
    out = []
    for name, unit in periods.items():
        step = {"year": "interval 1 year", "quarter": "interval 3 months", "month": "interval 1 month"}[unit]
        begin = F.date_trunc(unit, F.greatest(F.col(start), F.lit(first).cast("timestamp")))
        stop = F.least(F.coalesce(F.col(end), F.lit(last).cast("timestamp")), F.lit(last).cast("timestamp"))
        spans = df.filter(F.col(start) <= F.lit(last).cast("timestamp")).withColumn("period_start", F.explode(F.when(begin <= stop, F.sequence(begin, stop, F.expr(step)))))
        spans = spans.filter((F.col(start) <= F.col("period_start")) & (F.coalesce(F.col(end), F.lit(last).cast("timestamp")) >= F.col("period_start")))
        done = F.col("period_start") + F.expr(step) - F.expr("interval 1 day")
        kept = F.col(end).isNull() | (F.col(end) >= done)
        g = [F.col(d) for d in dims]
        cells = spans.withColumn("_kept", kept).groupingSets([[F.col("period_start")], *([F.col("period_start"), d] for d in g)], F.col("period_start"), *g)
        out.append(cells.agg(F.count_distinct(key).alias("active"), F.count_distinct(F.when(F.col("_kept"), F.col(key))).alias("retained")).withColumn("period", F.lit(name)))
    return reduce(DataFrame.unionByName, out).withColumn("retention", F.try_divide(100.0 * F.col("retained"), F.col("active")))


def unpivot_metrics(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """keys, metric, value: a row for each metric (M5)."""
    return df.select(*keys, *(F.col(m).cast("double").alias(m) for m in metrics)).unpivot([*keys], [*metrics], "metric", "value")


def hash_id(df: DataFrame, cols: Sequence[str], out: str = "row_id") -> DataFrame:
    """An id from the columns' values, nulls as a dash (M6)."""
    return df.withColumn(out, F.md5(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in cols))))


def refine_reason(df: DataFrame, reason: str, value: str, low: str, high: str, period: str, period_r: str) -> DataFrame:
    """Reasons with MIN_ or MAX_ in front where the value is its group's least or largest, _TIME behind where periods differ (M7)."""
    head = F.when(F.col(value).eqNullSafe(F.col(low)), "MIN_").when(F.col(value).eqNullSafe(F.col(high)), "MAX_").otherwise("")
    tail = F.when(~F.col(period).eqNullSafe(F.col(period_r)), "_TIME").otherwise("")
    return df.withColumn(reason, F.concat(head, F.col(reason), tail))


def weight_score(df: DataFrame, score: str, metric_weight: str, weights: Mapping[str, str], out: str = "weighted_score") -> DataFrame:
    """The score times the metric's weight times the weight of each dimension that is set; weights names their columns (M8)."""
    factors = [F.when(F.col(d).isNotNull(), F.col(w)).otherwise(1) for d, w in weights.items()]
    return df.withColumn(out, reduce(lambda a, b: a * b, factors, F.col(score) * F.col(metric_weight)))


def metrics_json(df: DataFrame, metrics: Sequence[str], out: str = "metrics_json") -> DataFrame:
    """The metrics as one JSON document, nulls left out (M9)."""
    return df.withColumn(out, F.to_json(F.struct(*metrics)))


def drop_duplicated_ids(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key stands once; all rows of the others go (M10). Counts are summed before the shuffle; null keys count as a key."""
    twice = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").select(*keys)
    return df.alias("a").join(twice.alias("b"), safe_keys("a", "b", keys), "left_anti")


def prune_time(df: DataFrame, keys: Sequence[str], period: str, finer: Sequence[str]) -> DataFrame:
    """Among rows without finer dimensions only those of the latest period of their key stay; other rows stay."""
    coarse = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in finer], F.lit(True))
    last = df.filter(coarse).groupBy(*keys).agg(F.max(period).alias("_last"))
    joined = df.alias("a").join(last.alias("b"), safe_keys("a", "b", keys), "left").select("a.*", "b._last")
    return joined.filter(~coarse | F.col(period).eqNullSafe(F.col("_last"))).drop("_last")


def prune_dims(df: DataFrame, keys: Sequence[str], size: str, dims: Sequence[str]) -> DataFrame:
    """Of the cells of a key with one size the most specific stay: those of the highest presence code, first dimension first."""
    code = reduce(lambda a, b: a + b, [F.col(d).isNotNull().cast("int") * (1 << (len(dims) - 1 - i)) for i, d in enumerate(dims)])
    w = Window.partitionBy(*keys, size).orderBy(F.col("_code").desc())
    return df.withColumn("_code", code).withColumn("_rank", F.dense_rank().over(w)).filter("_rank = 1").drop("_code", "_rank")


def outlier_ladder(df: DataFrame, by: Sequence[str], value: str, fixed: float, fence: float = 1.25, sigma: float = 1.5, exact: bool = False) -> DataFrame:
    """df, group_size, threshold and is_outlier by the size of the group.

    1-2: above the fixed threshold; 3-4: above the mean; 5-20: from Q3 + fence x IQR on, or where the IQR is 0 a log z-score
    above sigma; beyond 20: a log z-score above sigma. Without deviation (but for rounding) there is no log threshold.
    """
    v = F.col(value).cast("double")
    log = F.when(v > 0, F.log(v))
    q = lambda p: F.percentile(v, F.lit(p)) if exact else F.percentile_approx(v, p, 5000)
    stats = df.groupBy(*(F.col(c).alias(f"_g_{c}") for c in by)).agg(F.count(v).alias("group_size"), F.avg(v).alias("_mean"), q(0.25).alias("_q1"), q(0.75).alias("_q3"), F.avg(log).alias("_lm"), F.stddev_pop(log).alias("_ls"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by])
    s = df.join(stats, same, "left")
    by_log = F.when(F.col("_ls") > 1e-9, F.exp(F.col("_lm") + sigma * F.col("_ls")))
    iqr = F.col("_q3") - F.col("_q1")
    n = F.col("group_size")
    fenced = (n > 4) & (n <= 20) & (iqr > 0)
    top = F.when(n <= 2, F.lit(float(fixed))).when(n <= 4, F.col("_mean")).when(fenced, F.col("_q3") + fence * iqr).otherwise(by_log)
    out = s.withColumn("threshold", top)
    over = F.when(fenced, v >= F.col("threshold")).otherwise(v > F.col("threshold"))
    return out.withColumn("is_outlier", F.coalesce(over, F.lit(False))).drop(*(f"_g_{c}" for c in by), "_mean", "_q1", "_q3", "_lm", "_ls")


def top_n_list(df: DataFrame, by: Sequence[str], label: str, value: str, n: int, out: str = "top_list") -> DataFrame:
    """by and the n labels of the largest values as text, largest first, ties by label (M14). The limit is the feature."""
    w = Window.partitionBy(*by).orderBy(F.col(value).desc(), F.col(label))
    top = df.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= n)
    items = F.array_sort(F.collect_list(F.struct("_k", F.col(label).cast("string").alias("l"))))
    return top.groupBy(*by).agg(F.concat_ws(", ", F.transform(items, lambda x: x["l"])).alias(out))


def backfill_benchmark(benchmarks: DataFrame, children: DataFrame, parent: str, child: str, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """benchmarks (child, keys, values) and, for each (child, keys) without a row, that of the child's parent."""
    above = children.select(F.col(child).alias("_child"), F.col(parent).alias("_parent"))
    copied = benchmarks.join(above, F.col(child) == F.col("_parent")).select(F.col("_child").alias(child), *keys, *values)
    return benchmarks.select(child, *keys, *values).unionByName(copied.join(benchmarks, [child, *keys], "left_anti"))


def multi_level_zscore(df: DataFrame, value: str, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """zscore_<level> and log_zscore_<level> of a value against the mean and deviation of each level's group, joined null-safely."""
    v = F.col(value).cast("double")
    log = F.when(v > 0, F.log(v))
    for name, by in levels.items():
        stats = df.groupBy(*(F.col(c).alias(f"_g_{c}") for c in by)).agg(F.avg(v).alias("_m"), F.stddev_pop(v).alias("_s"), F.avg(log).alias("_lm"), F.stddev_pop(log).alias("_ls"))
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by], F.lit(True))
        df = df.join(stats, same, "left").withColumns({f"zscore_{name}": F.when(F.col("_s") > 0, (v - F.col("_m")) / F.col("_s")), f"log_zscore_{name}": F.when(F.col("_ls") > 0, (log - F.col("_lm")) / F.col("_ls"))}).drop("_m", "_s", "_lm", "_ls", *(f"_g_{c}" for c in by))
    return df


def exceeds_peers(df: DataFrame, value: str, levels: Mapping[str, Sequence[str]], direction: int = 1, z: float = 1.0) -> DataFrame:
    """df and exceeds: at every level the deviation from the mean, in the direction, is at least the average of those beyond
    the mean, and the z-score of the value or of its logarithm is beyond z (M17)."""
    v = F.col(value).cast("double")
    df = multi_level_zscore(df, value, levels)
    every = F.lit(True)
    for name, by in levels.items():
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by], F.lit(True))
        mean = df.groupBy(*(F.col(c).alias(f"_g_{c}") for c in by)).agg(F.avg(v).alias("_mean"))
        df = df.join(mean, same, "left").withColumn(f"_dev_{name}", direction * (v - F.col("_mean"))).drop("_mean", *(f"_g_{c}" for c in by))
        beyond = df.groupBy(*(F.col(c).alias(f"_g_{c}") for c in by)).agg(F.avg(F.when(F.col(f"_dev_{name}") > 0, F.col(f"_dev_{name}"))).alias(f"_avg_{name}"))
        df = df.join(beyond, same, "left").drop(*(f"_g_{c}" for c in by))
        far = F.greatest(direction * F.col(f"zscore_{name}"), direction * F.col(f"log_zscore_{name}")) > z
        every = every & F.coalesce((F.col(f"_dev_{name}") >= F.col(f"_avg_{name}")) & far, F.lit(False))
    return df.withColumn("exceeds", every).drop(*(f"_{x}_{n}" for n in levels for x in ("dev", "avg")))


def annualise(df: DataFrame, by: Sequence[str], amount: str, start: str, end: str, least: int = 30) -> DataFrame:
    """by, observed_days, annual_amount: the sum x 365 / observed days, null under ``least`` days."""
    n = df.groupBy(*by).agg(F.sum(amount).alias("_a"), F.datediff(F.max(end), F.min(start)).alias("observed_days"))
    return n.select(*by, "observed_days", F.when(F.col("observed_days") >= least, F.col("_a") * 365 / F.col("observed_days")).alias("annual_amount"))


def grain_summary(df: DataFrame, dims: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """grain (the set dimensions, joined by +; ``all``) and aggregates, in one grouping."""
    grain = F.concat_ws("+", *(F.when(F.col(d).isNotNull(), d) for d in dims))
    return df.groupBy(F.when(grain == "", "all").otherwise(grain).alias("grain")).agg(*aggs)


def insight_report(df: DataFrame, by: Sequence[str], distinct: Sequence[str], least: int = 1) -> DataFrame:
    """by, n_insights and distinct counts, groups of at least ``least`` rows."""
    return df.groupBy(*by).agg(F.count("*").alias("n_insights"), *(F.count_distinct(c).alias(f"n_{c}") for c in distinct)).filter(F.col("n_insights") >= least)


def recent_periods(df: DataFrame, month: str, as_of: str) -> DataFrame:
    """Rows of the last full month before as_of, the one before, and the same month a year earlier; period_kind says which."""
    day = F.lit(as_of).cast("date")
    at = lambda k: F.date_format(F.add_months(day, -k), "yyyyMM")
    kind = F.when(F.col(month) == at(1), "last").when(F.col(month) == at(2), "previous").when(F.col(month) == at(13), "year_ago")
    return df.withColumn("period_kind", kind).filter("period_kind is not null")


def fiscal_today(clients: DataFrame, as_of: str, first_month: str) -> DataFrame:
    """clients, fiscal_year, fiscal_quarter, fiscal_month of as_of, for years that begin in each client's first month."""
    day = F.lit(as_of).cast("date")
    shifted = F.add_months(day, -(F.col(first_month) - 1))
    return clients.withColumns({"fiscal_year": F.year(shifted), "fiscal_quarter": F.quarter(shifted), "fiscal_month": F.month(shifted)})


def latest_partition(df: DataFrame, column: str) -> DataFrame:
    """The rows of the largest partition value."""
    return df.join(F.broadcast(df.agg(F.max(column).alias(column))), column)


def enrich(fact: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """The fact left-joined to dimensions; which are broadcast is left to their measured size."""
    return reduce(lambda f, d: f.join(d[0], [*d[1]], "left"), dims, fact)


def load_status(tenants: DataFrame, loads: DataFrame, key: str, week: str, kind: str, kinds: Sequence[str]) -> DataFrame:
    """key, latest_week, n_<kind>: the latest week of each tenant and its rows by kind; zeros for tenants without any."""
    last = loads.groupBy(key).agg(F.max(week).alias("latest_week"))
    n = loads.join(last, [key]).filter(F.col(week) == F.col("latest_week")).groupBy(key).agg(F.first("latest_week").alias("latest_week"), *(F.count_if(F.col(kind) == k).alias(f"n_{k}") for k in kinds))
    return tenants.select(key).join(n, key, "left").withColumns({f"n_{k}": F.coalesce(f"n_{k}", F.lit(0)) for k in kinds})


def drill_across(cubes: Sequence[DataFrame], dims: Sequence[str], ratios: Mapping[str, tuple[str, str]], share_of: str | None = None) -> DataFrame:
    """Cubes joined null-safely on every dimension, ratio columns, and a fact's share of the all-null cell."""
    first = cubes[0]
    for other in cubes[1:]:
        o = other.withColumnsRenamed({d: f"_r_{d}" for d in dims})
        first = first.join(o, reduce(lambda a, b: a & b, [F.col(d).eqNullSafe(F.col(f"_r_{d}")) for d in dims])).drop(*(f"_r_{d}" for d in dims))
    out = first.withColumns({k: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")) for k, (a, b) in ratios.items()})
    if share_of:
        top = first.filter(reduce(lambda a, b: a & b, [F.col(d).isNull() for d in dims])).agg(F.max(share_of).cast("double").alias("_top"))
        out = out.join(F.broadcast(top), F.lit(True), "left").withColumn(f"{share_of}_share", F.try_divide(F.col(share_of).cast("double"), F.col("_top"))).drop("_top")
    return out


def union_missing(primary: DataFrame, fallback: DataFrame, keys: Sequence[str]) -> DataFrame:
    """primary, and the rows of fallback whose key primary lacks."""
    return primary.unionByName(fallback.select(*primary.columns).join(primary.select(*keys).distinct(), [*keys], "left_anti"))


def fill_from(df: DataFrame, other: DataFrame, keys: Sequence[str], columns: Sequence[str], missing: Sequence[object] = (0, "UNKNOWN")) -> DataFrame:
    """Columns whose value is null or counts as missing, filled from the other table's row of the key."""
    types = dict(df.dtypes)
    o = other.select(*keys, *(F.col(c).alias(f"_o_{c}") for c in columns))

    def known(c: str, kind: str) -> Column:
        gone = [m for m in missing if isinstance(m, str) == (kind == "string")]
        return F.when(~F.col(c).isin(gone), F.col(c)) if gone else F.col(c)

    joined = df.join(o, [*keys], "left")
    return joined.withColumns({c: F.coalesce(known(c, types[c]), F.col(f"_o_{c}"), F.col(c)) for c in columns}).drop(*(f"_o_{c}" for c in columns))


def band(column: str, edges: Sequence[float]) -> Column:
    """The label of the half-open band that holds a value: <a, a-b, ..., >=z; null for null."""
    c, out = F.col(column), F.lit(f">={edges[-1]:g}")
    for low, high in reversed([*zip(edges[:-1], edges[1:], strict=True)]):
        out = F.when(c < high, f"{low:g}-{high:g}").otherwise(out)
    return F.when(c.isNotNull(), F.when(c < edges[0], f"<{edges[0]:g}").otherwise(out))


def tenure_years(start: str, period_end: Column) -> Column:
    """Years from start to the period's end, to two places."""
    return F.round(F.months_between(period_end, F.col(start)) / 12, 2)
