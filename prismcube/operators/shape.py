"""Column profiles, rules and drift checks (G)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERCENTILES = (5, 10, 25, 50, 75, 90, 95)
NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


@dataclass(frozen=True)
class ColumnRule:
    """What a column's values must satisfy, row by row and in sum."""

    column: str
    valid: tuple[str, ...] | None = None
    nullable: bool = True
    minimum: float | None = None
    maximum: float | None = None
    max_null_pct: float | None = None
    min_cardinality: int | None = None
    max_cardinality: int | None = None

    def invalid(self) -> Column:
        """1 where a row breaks a rule, else 0."""
        c = F.col(self.column)
        broken = [c.isNull()] * (not self.nullable)
        broken += [~c.cast("string").isin(*self.valid)] if self.valid is not None else []
        broken += [c < self.minimum] if self.minimum is not None else []
        broken += [c > self.maximum] if self.maximum is not None else []
        return F.when(reduce(lambda a, b: a | b, [F.coalesce(b, F.lit(False)) for b in broken], F.lit(False)), 1).otherwise(0)


def is_numeric(kind: str) -> bool:
    return kind in NUMERIC or kind.startswith("decimal")


def profile(df: DataFrame, by: Sequence[str] = (), analyze: Sequence[str] | None = None, exclude: Sequence[str] = (), virtual: Mapping[str, str] | None = None, rules: Sequence[ColumnRule] = (), exact: bool = False) -> DataFrame:
    """One row for each combination of ``by`` and column: counts, moments, percentiles and distinct measures.

    by, column_name, column_type, num_records, num_missing, num_invalid, mean, stddev, min, max, p5 ... p95, distinct_count,
    distinctness, entropy, unique_value_ratio. One wide aggregation gives the simple measures; distinct measures come from
    counts by value, so no value list is ever held in one buffer.
    """
    by = [*by]
    df = df.withColumns({k: F.expr(e) for k, e in (virtual or {}).items()})
    columns = [c for c in (analyze or df.columns) if c not in {*by, *exclude}]
    types, ruled = dict(df.dtypes), {r.column: r for r in rules}
    none = F.lit(None).cast("double")

    def simple(c: str) -> list[Column]:
        value, own = F.col(c), f"{c}__"
        out = [F.sum(value.isNull().cast("long")).alias(own + "missing")]
        out.append((F.sum(ruled[c].invalid()) if c in ruled else F.lit(0)).cast("long").alias(own + "invalid"))
        if is_numeric(types[c]):
            v = value.cast("double")
            shares = F.array(*(F.lit(p / 100) for p in PERCENTILES))
            out += [F.avg(v).alias(own + "mean"), F.stddev_pop(v).alias(own + "stddev"), F.min(v).alias(own + "min"), F.max(v).alias(own + "max")]
            out.append((F.percentile(v, shares) if exact else F.percentile_approx(v, shares, 5000)).alias(own + "pcts"))
        return out

    wide = df.groupBy(*by).agg(F.count("*").alias("_n"), *(x for c in columns for x in simple(c)))

    def record(c: str) -> Column:
        have = is_numeric(types[c])
        col = lambda k: F.col(f"{c}__{k}") if have else none
        pcts = [(F.get(F.col(f"{c}__pcts"), F.lit(i)) if have else none).cast("double").alias(f"p{p}") for i, p in enumerate(PERCENTILES)]
        return F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("column_type"), F.col("_n").alias("num_records"), F.col(f"{c}__missing").alias("num_missing"), F.col(f"{c}__invalid").alias("num_invalid"), *(col(k).alias(k) for k in ("mean", "stddev", "min", "max")), *pcts)

    tall = wide.select(*by, F.explode(F.array(*(record(c) for c in columns))).alias("r")).select(*by, "r.*")
    values = df.select(*by, F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.trim(F.col(c).cast("string")).alias("v")) for c in columns))).alias("r")).select(*by, "r.*").filter("v is not null")
    measures = value_measures(values, [*by, "column_name"], "v")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in [*by, "column_name"]])
    joined = tall.join(measures.withColumnsRenamed({c: f"_g_{c}" for c in [*by, "column_name"]}), same, "left").drop(*(f"_g_{c}" for c in [*by, "column_name"]))
    return joined.withColumn("distinct_count", F.coalesce("distinct_count", F.lit(0)))


def value_measures(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """by, distinct_count, distinctness, entropy (natural logarithm), unique_value_ratio of a column, by counts of values."""
    counts = rows.groupBy(*by, value).agg(F.count("*").alias("_c"))
    total = counts.groupBy(*by).agg(F.sum("_c").alias("_t"), F.count("*").alias("distinct_count"), F.count_if(F.col("_c") == 1).alias("_once"), F.sum(F.col("_c") * F.log(F.col("_c").cast("double"))).alias("_s"))
    t = F.col("_t")
    return total.select(*by, "distinct_count", (F.col("distinct_count") / t).alias("distinctness"), (F.log(t.cast("double")) - F.col("_s") / t).alias("entropy"), (F.col("_once") / F.col("distinct_count")).alias("unique_value_ratio"))


def normalise_period(df: DataFrame) -> DataFrame:
    """Month columns are renamed yyyymm, quarter columns qtr."""
    names = {c: "yyyymm" if c.lower() in ("yyyymm", "mnth_cd", "month", "yr_mnth") else "qtr" if c.lower() in ("qtr", "qtr_cd", "quarter") else c for c in df.columns}
    return df.withColumnsRenamed(names)


def with_pct(profiled: DataFrame) -> DataFrame:
    """pct_missing and pct_valid (100 x (1 - invalid share))."""
    n = F.col("num_records")
    return profiled.withColumns({"pct_missing": F.try_divide(100.0 * F.col("num_missing"), n), "pct_valid": 100 * (1 - F.try_divide(F.col("num_invalid").cast("double"), n))})


def check_rules(profiled: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """profiled and ``status``: FAIL where an aggregate rule is broken, WARN where everything is missing, else PASS."""
    failed = F.lit(False)
    for r in rules:
        own = F.col("column_name") == r.column
        broken = [F.col("num_invalid") > 0]
        broken += [100.0 * F.col("num_missing") > r.max_null_pct * F.col("num_records")] if r.max_null_pct is not None else []
        broken += [F.col("distinct_count") < r.min_cardinality] if r.min_cardinality is not None else []
        broken += [F.col("distinct_count") > r.max_cardinality] if r.max_cardinality is not None else []
        failed = failed | (own & reduce(lambda a, b: a | b, broken))
    return profiled.withColumn("status", F.when(failed, "FAIL").when(F.col("num_missing") == F.col("num_records"), "WARN").otherwise("PASS"))


def latest_exists(profiled: DataFrame, partition: str, expected: str) -> DataFrame:
    """One row: the latest partition, and PASS if it is the expected one, else FAIL."""
    return profiled.agg(F.max(partition).alias("latest")).withColumn("status", F.when(F.col("latest") == expected, "PASS").otherwise("FAIL"))


def unique_check(df: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """by, n_duplicated (keys that stand more than once), status."""
    n = df.groupBy(*by, *keys).agg(F.count("*").alias("_n"))
    return n.groupBy(*by).agg(F.count_if(F.col("_n") > 1).alias("n_duplicated")).withColumn("status", F.when(F.col("n_duplicated") > 0, "FAIL").otherwise("PASS"))


def dixon_check(series: DataFrame, order: str, value: str, by: Sequence[str] = (), size: int = 7, passes: float = 0.507, warns: float = 0.568) -> DataFrame:
    """series, dixon_q and ``status`` of each period: Dixon's Q of the latest of the last ``size`` changes.

    Fewer than size + 1 periods give WARN. Q is the gap of the latest change to its nearest neighbour over their range; a
    range of 0 gives 0.
    """
    w = Window.partitionBy(*by).orderBy(order)
    moved = series.withColumn("_d", F.col(value).cast("double") - F.lag(F.col(value).cast("double")).over(w))
    last = F.collect_list("_d").over(w.rowsBetween(-(size - 1), 0))
    moved = moved.withColumn("_last", last).withColumn("_now", F.element_at("_last", -1))
    others = F.slice("_last", 1, F.size("_last") - 1)
    gap = F.array_min(F.transform(others, lambda x: F.abs(x - F.col("_now"))))
    spread = F.array_max("_last") - F.array_min("_last")
    q = F.when(F.size("_last") == size, F.when(spread == 0, 0.0).otherwise(gap / spread))
    out = moved.withColumn("dixon_q", F.when(F.col("_d").isNotNull(), q))
    status = F.when(F.col("dixon_q").isNull(), "WARN").when(F.col("dixon_q") <= passes, "PASS").when(F.col("dixon_q") <= warns, "WARN").otherwise("FAIL")
    return out.withColumn("status", status).drop("_d", "_last", "_now")


def seasonality_check(series: DataFrame, order: str, value: str, by: Sequence[str] = (), period: int = 12, back: int = 50, least: int = 37, passes: float = 2, warns: float = 3) -> DataFrame:
    """series, ``seasonal`` (change of value over its like a year before) and status: within ``passes`` deviations of the
    mean of up to ``back`` rows before PASS, within ``warns`` WARN, else FAIL; ERROR while there are too few periods or a gap (G12).

    order holds the period's number, so a gap is a step other than one.
    """
    w = Window.partitionBy(*by).orderBy(order)
    v = F.col(value).cast("double")
    s = series.withColumn("_r", F.try_divide(v, F.lag(v, period).over(w))).withColumn("seasonal", F.col("_r") - F.lag("_r").over(w))
    before = w.rowsBetween(-back, -1)
    s = s.withColumns({"_m": F.avg("seasonal").over(before), "_s": F.stddev_samp("seasonal").over(before), "_n": F.row_number().over(w), "_gap": F.coalesce(F.col(order) - F.lag(order).over(w), F.lit(1))})
    s = s.withColumn("_gap", F.max("_gap").over(w))
    off = F.abs(F.col("seasonal") - F.col("_m"))
    status = F.when((F.col("_n") <= least) | (F.col("_gap") != 1) | F.col("seasonal").isNull(), "ERROR").when(off <= passes * F.col("_s"), "PASS").when(off <= warns * F.col("_s"), "WARN").otherwise("FAIL")
    return s.withColumn("status", status).drop("_r", "_m", "_s", "_n", "_gap")


def new_partitions(df: DataFrame, stats: DataFrame, partition: Sequence[str]) -> DataFrame:
    """The rows of partitions that the statistics lack."""
    return df.join(stats.select(*partition).distinct(), [*partition], "left_anti")


def table_counts(tables: Mapping[str, DataFrame], filters: Mapping[str, str]) -> DataFrame:
    """table_name, n: rows of each table under the filters whose column it has."""
    def one(name: str, df: DataFrame) -> DataFrame:
        for column, condition in filters.items():
            df = df.filter(condition) if column in df.columns else df
        return df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")

    return reduce(DataFrame.unionByName, (one(k, v) for k, v in tables.items()))


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], tolerance: float = 0.1) -> DataFrame:
    """keys, n_in, n_out, status: PASS where less than ``tolerance`` of the input's rows are missing from the output."""
    both = a.select(*keys, F.lit(1).alias("i"), F.lit(0).alias("o")).unionByName(b.select(*keys, F.lit(0).alias("i"), F.lit(1).alias("o")))
    n = both.groupBy(*keys).agg(F.sum("i").alias("n_in"), F.sum("o").alias("n_out"))
    return n.withColumn("status", F.when(F.try_divide(F.col("n_in") - F.col("n_out"), F.col("n_in")) < tolerance, "PASS").otherwise("FAIL"))
