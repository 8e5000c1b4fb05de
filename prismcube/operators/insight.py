"""Insights from cube cells (B) and correlations between facts (C)."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prismcube.operators.ordered import percent_ranks


@dataclass(frozen=True)
class Dim:
    """How a dimension is compared. kind: invariant, variant (left > right), nullvariant (left set, right null),
    ephemeral (left - right is one of differences), alwayson (left set, right null in every comparison).

    below and above: ancestors that must be set, and descendants that must be null, on both sides (B3).
    """

    name: str
    kind: str = "invariant"
    differences: tuple[int, ...] = ()
    above: tuple[str, ...] = ()
    below: tuple[str, ...] = ()
    percentile: bool = False


@dataclass(frozen=True)
class InsightSpec:
    dims: tuple[Dim, ...]
    facts: tuple[str, ...]
    rates: tuple[str, ...] = ()
    group: tuple[str, ...] = ()
    reason: str | None = None
    score: str | None = None
    prefilter: str | None = None

    def of(self, *kinds: str) -> list[Dim]:
        return [d for d in self.dims if d.kind in kinds]


def every(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def events_of(cells: DataFrame, spec: InsightSpec) -> list[str]:
    """The columns <fact>_events that cells have: how many events a fact rests on."""
    return [f"{f}_events" for f in spec.facts if f"{f}_events" in cells.columns]


def compare_cells(left: DataFrame, right: DataFrame, spec: InsightSpec) -> DataFrame:
    """Pairs of cells in which exactly one compared dimension differs: left's columns, right's with suffix _r, varying.

    One branch for each dimension and, for periods, each difference. Every branch is an equi-join: all dimensions but the
    varying one are keys, a parent's key is null and an earlier period's is shifted. Only ``variant`` keeps an inequality,
    inside its keys.
    """
    facts = [*spec.facts, *events_of(left, spec)]
    names = [d.name for d in spec.dims]
    r = right.select(*(F.col(c).alias(f"{c}_r") for c in [*names, *spec.facts, *events_of(right, spec)]))
    l_ = left.select(*names, *facts)
    always = spec.of("alwayson")
    out = []
    for d in spec.of("variant", "nullvariant", "ephemeral"):
        same = [F.col(x.name).eqNullSafe(F.col(f"{x.name}_r")) for x in spec.dims if x is not d and x.kind != "alwayson"]
        same += [F.col(x.name).isNotNull() & F.col(f"{x.name}_r").isNull() for x in always]
        sides = lambda c: (F.col(c), F.col(f"{c}_r"))
        same += [x.isNotNull() for c in d.above for x in sides(c)] + [x.isNull() for c in d.below for x in sides(c)]
        a, b = sides(d.name)
        if d.kind == "variant":
            branches = [same + [a > b]]
        elif d.kind == "nullvariant":
            branches = [same + [a.isNotNull(), b.isNull()]]
        else:
            branches = [same + [a - F.lit(k) == b] for k in d.differences]
        out += [l_.join(r, every(x)).withColumn("varying", F.lit(d.name)) for x in branches]
    return reduce(DataFrame.unionByName, out)


def add_diffs(pairs: DataFrame, spec: InsightSpec) -> DataFrame:
    """diff_<fact> and pctg_diff_<fact>: null where either side is 0; facts that aren't rates only between periods."""
    periods = [d.name for d in spec.of("ephemeral")]
    moved = F.col("varying").isin(*periods) if periods else F.lit(False)
    made = {}
    for f in spec.facts:
        a, b = F.col(f), F.col(f"{f}_r")
        usable = (a != 0) & (b != 0)
        usable = usable if f in spec.rates else usable & moved
        made[f"diff_{f}"] = F.when(usable, a - b)
        made[f"pctg_diff_{f}"] = F.when(usable, F.try_divide(100.0 * (a - b), F.abs(b)))
    return pairs.withColumns(made)


def log_normalise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """norm_<column>: the natural logarithm, null from zero down."""
    return df.withColumns({f"norm_{c}": F.when(F.col(c) > 0, F.log(F.col(c))) for c in cols})


def with_group_values(df: DataFrame, by: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """df and aggregates of its groups (nulls are a group). They are aggregated first and joined back null-safely, so that a
    group that holds a large part of the rows is summed up before the shuffle."""
    stats = df.groupBy(*(F.col(c).alias(f"_g_{c}") for c in by)).agg(*(v.alias(k) for k, v in values.items()))
    return df.join(stats, every([F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by])).drop(*(f"_g_{c}" for c in by))


def zscore(df: DataFrame, cols: Sequence[str], by: Sequence[str], keep: bool = False) -> DataFrame:
    """zscore_<column> within groups (nulls are a group): null where the deviation or the value is 0.

    With keep also mean_<column> and stddev_<column> (of the population).
    """
    joined = with_group_values(df, by, {f"{k}_{c}": f(c) for c in cols for k, f in (("mean", F.avg), ("stddev", F.stddev_pop))})
    made = {f"zscore_{c}": F.when((F.col(f"stddev_{c}") != 0) & (F.col(c) != 0), (F.col(c) - F.col(f"mean_{c}")) / F.col(f"stddev_{c}")) for c in cols}
    return joined.withColumns(made) if keep else joined.withColumns(made).drop(*(f"{k}_{c}" for k in ("mean", "stddev") for c in cols))


def rank_slice(cube: DataFrame, spec: InsightSpec) -> DataFrame:
    """Cells for ranking: not all dimensions null, those without the percentile mark null, exactly one marked one set."""
    marked = [d.name for d in spec.dims if d.percentile]
    plain = [d.name for d in spec.dims if not d.percentile and d.name not in spec.group]
    number = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in marked])
    return cube.filter(every([F.col(c).isNull() for c in plain])).filter(number == 1)


def rank_cells(cube: DataFrame, spec: InsightSpec) -> DataFrame:
    """percentile_, min_, max_, z-scores, means and deviations (value and logarithm) of each fact within the group and the
    pattern of set dimensions (B7). Ranks come from running counts over ranges, so a group of any size is ranked by many tasks."""
    marked = [d.name for d in spec.dims if d.percentile]
    cells = rank_slice(cube, spec).withColumn("_pattern", F.concat_ws("_", *(F.when(F.col(c).isNotNull(), c) for c in marked)))
    by = [*spec.group, "_pattern"]
    ranked = percent_ranks(cells, by, {f: f"percentile_{f}" for f in spec.facts})
    ranked = ranked.withColumns({f"percentile_{f}": 100 * F.col(f"percentile_{f}") for f in spec.facts})
    ranked = with_group_values(ranked, by, {f"{k}_{f}": v(f) for f in spec.facts for k, v in (("min", F.min), ("max", F.max))})
    ranked = log_normalise(ranked, spec.facts)
    return zscore(ranked, [*spec.facts, *(f"norm_{f}" for f in spec.facts)], by, keep=True).drop("_pattern")


def num_dimensions(spec: InsightSpec) -> Column:
    """How many dimensions are set; a hierarchy counts once, by its head."""
    heads = [d.name for d in spec.dims if not d.above]
    return reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in heads])


def reason_of(fact: str, spec: InsightSpec) -> Column:
    """Why a pair is worth telling: its rank, or the largest of the four scores, or NO_INSIGHT."""
    if spec.reason:
        return F.expr(spec.reason.replace("[fact]", fact))
    size = {
        "ABS_DIFF": F.abs(F.col(f"zscore_diff_{fact}")) / 3,
        "PCTG_DIFF": F.abs(F.col(f"zscore_pctg_diff_{fact}")),
        "NORM_ABS_DIFF": F.abs(F.col(f"zscore_norm_diff_{fact}")),
        "NORM_PCTG_DIFF": F.abs(F.col(f"zscore_norm_pctg_diff_{fact}")),
    }
    top = F.greatest(*size.values())
    reason = F.lit("NO_INSIGHT")
    for name, value in reversed(size.items()):
        reason = F.when(value == top, name).otherwise(reason)
    return F.when(F.col(f"percentile_{fact}").isNotNull(), "PERCENTILE_RANKING").when(top.isNull(), "NO_INSIGHT").otherwise(reason)


def score_of(fact: str, spec: InsightSpec) -> Column:
    """|z(diff) + z(percentage)| x |percentage|, or the template, to two places; without z(percentage) it counts 0, without percentage 1."""
    if spec.score:
        return F.round(F.expr(spec.score.replace("[fact]", fact)), 2)
    z = F.col(f"zscore_diff_{fact}") + F.coalesce(F.col(f"zscore_pctg_diff_{fact}"), F.lit(0.0))
    return F.round(F.abs(z) * F.coalesce(F.abs(F.col(f"pctg_diff_{fact}")), F.lit(1.0)), 2)


#: What the metrics array holds, in order, where a row has it: the cell and its partner, how many events stand behind
#: them, differences and their z-scores, ranks, then means and deviations of the groups that scores refer to.
_CHANGES = ("diff", "pctg_diff", "norm_diff", "norm_pctg_diff")
METRICS = (
    ("{f}", "{f}_r", "{f}_events", "{f}_events_r")
    + tuple(f"{c}_{{f}}" for c in _CHANGES)
    + tuple(f"zscore_{c}_{{f}}" for c in _CHANGES)
    + ("percentile_{f}", "min_{f}", "max_{f}", "zscore_{f}", "zscore_norm_{f}")
    + tuple(f"{k}_{c}_{{f}}" for c in _CHANGES for k in ("mean", "stddev"))
    + ("mean_{f}", "stddev_{f}", "mean_norm_{f}", "stddev_norm_{f}")
)
#: Metrics that keep all their places; the others are rounded to two.
UNROUNDED = ("percentile_{f}", "zscore_{f}", "zscore_norm_{f}")


def pack_metrics(df: DataFrame, facts: Sequence[str]) -> DataFrame:
    """metrics_<fact>: the 29 METRICS of a fact as array<double>, null where a row has none.

    Events are taken from columns <fact>_events of the cells, where there are such.
    """
    have = {*df.columns}

    def one(m: str, f: str) -> Column:
        value = F.col(m.format(f=f)).cast("double") if m.format(f=f) in have else F.lit(None).cast("double")
        return value if m in UNROUNDED else F.round(value, 2)

    return df.withColumns({f"metrics_{f}": F.array(*(one(m, f) for m in METRICS)) for f in facts})


def insights(left: DataFrame, right: DataFrame, spec: InsightSpec) -> DataFrame:
    """Ranked and compared cells with reasons, scores and metrics; rows without any insight are dropped.

    Both sides are read once for each comparison, so they should be written tables rather than cubes still to be built.
    """
    pairs = add_diffs(compare_cells(left, right, spec), spec)
    if spec.prefilter:
        pairs = pairs.filter(spec.prefilter)
    diffs = [f"{p}diff_{f}" for f in spec.facts for p in ("", "pctg_")]
    pairs = log_normalise(pairs, diffs)
    by = [*spec.group, "varying"]
    pairs = zscore(pairs, [*diffs, *(f"norm_{c}" for c in diffs)], by, keep=True)
    rows = pairs.unionByName(rank_cells(left, spec), allowMissingColumns=True)
    rows = pack_metrics(rows, spec.facts).withColumn("num_dimensions", num_dimensions(spec))
    rows = rows.withColumns({f"reason_{f}": reason_of(f, spec) for f in spec.facts} | {f"score_{f}": score_of(f, spec) for f in spec.facts})
    some = reduce(lambda a, b: a | b, [F.col(f"reason_{f}") != "NO_INSIGHT" for f in spec.facts])
    dims = [d.name for d in spec.dims]
    return rows.filter(some).select(*dims, *(f"{d}_r" for d in dims), "varying", "num_dimensions", *(f"{p}_{f}" for f in spec.facts for p in ("reason", "score", "metrics")))


def lead_facts(df: DataFrame, facts: Sequence[str], by: Sequence[str], order: Sequence[str], leads: Sequence[int]) -> DataFrame:
    """<fact>_lead_<k>: the fact k rows later within its series, 0 beyond its end."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumns({f"{f}_lead_{k}": F.lead(f, k, 0).over(w) for f in facts for k in leads})


def pair_sums(df: DataFrame, facts: Sequence[str], by: Sequence[str], leads: Sequence[int], held: int = 64) -> DataFrame:
    """by, a (number of a fact) and, over all (fact, lag), arrays of joint counts, sums, squares and products, of the rows of a task.

    Rows are sorted by group inside each partition, so a task sees each group once; matrix products give all pairs at once.
    """
    wide = len(facts) * (1 + len(leads))
    lists = ", ".join(f"{x} array<double>" for x in ("n", "sa", "sb", "qa", "qb", "p"))
    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in by), "a int", lists])

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}

        def out(done: dict[tuple, np.ndarray]) -> pd.DataFrame:
            rows = [(*raw, a, *(m[a] for m in six)) for raw, six in done.values() for a in range(len(facts))]
            return pd.DataFrame(rows, columns=[*by, "a", "n", "sa", "sb", "qa", "qb", "p"])

        for batch in batches:
            values = batch["_values"].to_numpy()
            x = np.array([[np.nan if v is None else v for v in row] for row in values], float).reshape(len(batch), wide)
            for key, at in batch.groupby([*by], dropna=False, sort=False).indices.items() if by else [((), np.arange(len(batch)))]:
                key = key if isinstance(key, tuple) else (key,)
                own = x[at]
                have = ~np.isnan(own)
                own, have = np.where(have, own, 0.0), have.astype(float)
                a, ha = own[:, : len(facts)], have[:, : len(facts)]
                six = np.stack([ha.T @ have, a.T @ have, ha.T @ own, (a * a).T @ have, ha.T @ (own * own), a.T @ own])
                name = tuple("nan" if k != k else k for k in key)
                raw = tuple(batch[c].iloc[at[0]] for c in by)
                sums[name] = (raw, sums[name][1] + six if name in sums else six)
            if len(sums) > held:
                last = [*sums][-1]
                yield out({k: v for k, v in sums.items() if k != last})
                sums = {last: sums[last]}
        yield out(sums)

    cols = [F.col(f"{f}_lead_{k}" if k else f).cast("double") for k in (0, *leads) for f in facts]
    return df.select(*by, F.array(*cols).alias("_values")).sortWithinPartitions(*by).mapInPandas(each, schema) if by else df.select(F.array(*cols).alias("_values")).mapInPandas(each, schema)


def correlation_rows(df: DataFrame, facts: Sequence[str], by: Sequence[str], series: Sequence[str] = (), order: Sequence[str] = (), leads: Sequence[int] = ()) -> DataFrame:
    """by, fact, other, lag (number in leads, 0: none), corr (Pearson, to 4 places), n (joint count): all pairs and lags.

    One aggregation whatever the number of facts and lags: each task gives every group's joint counts, sums, squares and
    products as arrays, which are added up by group and pair; all correlations follow from them. Values are taken from
    their overall means first, so that sums of squares keep their digits. Null groups are groups.
    """
    led = lead_facts(df, facts, series or by, order, leads) if leads else df
    means = df.agg(*(F.coalesce(F.avg(F.col(f).cast("double")), F.lit(0.0)).alias(f) for f in facts)).first()
    near = led.withColumns({c: F.col(c).cast("double") - F.lit(means[f]) for f in facts for c in [f, *(f"{f}_lead_{k}" for k in leads)]})
    names, wide = ("n", "sa", "sb", "qa", "qb", "p"), len(facts)
    each = pair_sums(near, facts, by, leads).select(*by, "a", F.posexplode(F.arrays_zip(*names)).alias("b", "x"))
    each = each.filter(F.col("b") % wide > F.col("a"))
    total = each.groupBy(*by, "a", "b").agg(*(F.sum(f"x.{c}").alias(c) for c in names))
    n, sa, sb, qa, qb, p = map(F.col, names)
    spread = lambda q, s: q - s * s / n
    # a spread that rounding left of equal values counts as none
    fine = (n > 0) & (spread(qa, sa) > 1e-12 * qa) & (spread(qb, sb) > 1e-12 * qb)
    r = F.when(fine, F.round((p - sa * sb / n) / F.sqrt(spread(qa, sa) * spread(qb, sb)), 4))
    name = F.lit([*facts])
    return total.select(*by, F.get(name, F.col("a")).alias("fact"), F.get(name, F.col("b") % wide).alias("other"), F.floor(F.col("b") / wide).cast("int").alias("lag"), r.alias("corr"), n.cast("long").alias("n"))


def correlate_facts(df: DataFrame, facts: Sequence[str], by: Sequence[str], series: Sequence[str] = (), order: Sequence[str] = (), leads: Sequence[int] = ()) -> DataFrame:
    """by, n_records, corr_<a>_<b> and n_<a>_<b>: correlation_rows() as arrays over the lags (0 first), a column for each pair."""
    rows = correlation_rows(df, facts, by, series, order, leads)
    lists = rows.groupBy(*by, F.concat_ws("\0", "fact", "other").alias("pair")).agg(F.array_sort(F.collect_list(F.struct("lag", "corr", "n"))).alias("lags"))
    maps = lists.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("pair", "lags"))).alias("_pairs"))
    records = df.groupBy(*(F.col(c).alias(f"_g_{c}") for c in by)).agg(F.count("*").alias("n_records"))
    joined = records.join(maps, every([F.col(f"_g_{c}").eqNullSafe(F.col(c)) for c in by]), "left")
    made = []
    for a, b in combinations(facts, 2):
        own = F.col("_pairs")[f"{a}\0{b}"]
        made += [F.transform(own, lambda x: x["corr"]).alias(f"corr_{a}_{b}"), F.transform(own, lambda x: x["n"]).alias(f"n_{a}_{b}")]
    return joined.select(*(F.col(f"_g_{c}").alias(c) for c in by), "n_records", *made)


def unpivot_correlations(df: DataFrame, facts: Sequence[str], by: Sequence[str]) -> DataFrame:
    """by, fact, other, lag, corr, n: a row for each pair of facts and lag."""
    rows = F.array(*(F.struct(F.lit(a).alias("fact"), F.lit(b).alias("other"), F.arrays_zip(F.col(f"corr_{a}_{b}").alias("corr"), F.col(f"n_{a}_{b}").alias("n")).alias("lags")) for i, a in enumerate(facts) for b in facts[i + 1 :]))
    pairs = df.select(*by, F.explode(rows).alias("p"))
    return pairs.select(*by, "p.fact", "p.other", F.posexplode("p.lags").alias("lag", "v")).select(*by, "fact", "other", "lag", "v.corr", "v.n")
