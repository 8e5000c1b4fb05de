"""Cube queries (A) over the star of line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismcube.operators.cube import binned_percentile, build_cube, calendar_rollup, distribute, scan_dimensions, with_calendar_days
from prismcube.plans.cube_spec import CubeSpec, Derived, Fact
from prismcube.queries.registry import query, read, rounded, sql_sets


def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order, customer, nation and region; dimensions reach the scans as column lists."""
    items = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate", "o_orderpriority")
    customers = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    nations = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    regions = read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    wide = items.join(orders, "l_orderkey").join(customers, "o_custkey").join(nations, "c_nationkey").join(regions, "n_regionkey")
    d = F.col("o_orderdate")
    year = F.year(d).cast("string")
    return wide.select("r_name", "n_name", "c_mktsegment", "o_orderpriority", "l_returnflag", "o_custkey", "l_quantity", "revenue", year.alias("yr_cd"), F.concat(year, F.lit("Q"), F.quarter(d).cast("string")).alias("qtr_cd"), F.date_format(d, "yyyyMM").alias("mnth_cd"))


STAR = """star AS (SELECT r_name, n_name, c_mktsegment, o_orderpriority, l_returnflag, o_custkey, l_quantity,
  l_extendedprice * (1 - l_discount) AS revenue, CAST(year(o_orderdate) AS VARCHAR) AS yr_cd,
  CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS qtr_cd, strftime(o_orderdate, '%Y%m') AS mnth_cd
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def depth_sql(columns: tuple[str, ...]) -> str:
    return "CAST(" + " + ".join(f"({c} IS NOT NULL)::INT" for c in columns) + " AS INTEGER) AS aggregation_depth"


FLAG_DIMS = ["r_name", "n_name", "yr_cd", "qtr_cd", "mnth_cd", "c_mktsegment", "o_orderpriority"]
FLAGSHIP = CubeSpec(
    dims=("c_mktsegment", "o_orderpriority"),
    hierarchies=(("r_name", "n_name"), ("yr_cd", "qtr_cd", "mnth_cd")),
    xor_groups={"kind": ("c_mktsegment", "o_orderpriority")},
    mandatory=("r_name",),
    max_depth=3,
    facts=(Fact("revenue"), Fact("items", "count", column="l_quantity"), Fact("avg_quantity", "avg", column="l_quantity"), Fact("max_quantity", "max", column="l_quantity"), Fact("min_quantity", "min", column="l_quantity")),
)


def flagship_sets(s: set[str]) -> bool:
    nested = ("n_name" not in s or "r_name" in s) and ("qtr_cd" not in s or "yr_cd" in s) and ("mnth_cd" not in s or "qtr_cd" in s)
    return nested and "r_name" in s and len(s & {"c_mktsegment", "o_orderpriority"}) <= 1 and len(s & {"r_name", "yr_cd", "c_mktsegment", "o_orderpriority"}) <= 3


@query(f"""WITH {STAR} SELECT {', '.join(FLAG_DIMS)}, round(sum(revenue), 4) AS revenue, count(l_quantity) AS items, round(avg(l_quantity), 4) AS avg_quantity,
  max(l_quantity) AS max_quantity, min(l_quantity) AS min_quantity, {depth_sql(('c_mktsegment', 'o_orderpriority', 'r_name', 'yr_cd'))}
  FROM star GROUP BY {sql_sets(FLAG_DIMS, flagship_sets)}""")
def cube_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two hierarchies, a group of exclusive dimensions, a mandatory one."""
    out = build_cube(star(spark, sf_dir), FLAGSHIP)
    return out.withColumns({"revenue": F.round("revenue", 4), "avg_quantity": F.round("avg_quantity", 4)})


@query(f"""WITH {STAR}, nulled AS (SELECT CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_returnflag END AS flag, c_mktsegment, revenue, l_quantity FROM star)
  SELECT flag, c_mktsegment, round(sum(revenue), 4) AS revenue, count(l_quantity) AS n, {depth_sql(('flag', 'c_mktsegment'))} FROM nulled
  GROUP BY GROUPING SETS ((flag), (flag, c_mktsegment), (c_mktsegment), ()) HAVING NOT (grouping(flag) = 0 AND flag IS NULL)""")
def cube_null_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: null values are told from rolled-up ones, and their cells dropped."""
    df = star(spark, sf_dir).withColumn("flag", F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")))
    out = build_cube(df, CubeSpec(dims=("flag", "c_mktsegment"), facts=(Fact("revenue"), Fact("n", "count", column="l_quantity"))))
    return out.withColumn("revenue", F.round("revenue", 4))


@query(f"""WITH {STAR}, nulled AS (SELECT CASE WHEN l_returnflag = 'A' THEN '__NULL__' ELSE l_returnflag END AS flag, c_mktsegment, l_quantity FROM star)
  SELECT flag, c_mktsegment, count(l_quantity) AS n, {depth_sql(('flag', 'c_mktsegment'))} FROM nulled GROUP BY CUBE (flag, c_mktsegment)""")
def cube_keep_null_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 with the cells of null values kept."""
    df = star(spark, sf_dir).withColumn("flag", F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")))
    return build_cube(df, CubeSpec(dims=("flag", "c_mktsegment"), facts=(Fact("n", "count", column="l_quantity"),), ignore_null_groupings=False))


@query(f"""WITH {STAR} SELECT r_name, c_mktsegment, l_returnflag, round(sum(revenue), 4) AS revenue, {depth_sql(('r_name', 'c_mktsegment', 'l_returnflag'))}
  FROM star GROUP BY GROUPING SETS ((r_name), (r_name, c_mktsegment), (c_mktsegment, l_returnflag))""")
def cube_explicit_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given grouping sets."""
    out = build_cube(star(spark, sf_dir), CubeSpec(grouping_sets=(("r_name",), ("r_name", "c_mktsegment"), ("c_mktsegment", "l_returnflag")), facts=(Fact("revenue"),)))
    return out.withColumn("revenue", F.round("revenue", 4))


LIMITED = ["r_name", "c_mktsegment", "o_orderpriority", "l_returnflag"]


@query(f"""WITH {STAR} SELECT {', '.join(LIMITED)}, count(*) AS n, {depth_sql(tuple(LIMITED))} FROM star
  GROUP BY {sql_sets(LIMITED, lambda s: 1 <= len(s) <= 3 and ('o_orderpriority' not in s or len(s) <= 2))}""")
def cube_depth_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth of all cells, and of those with one dimension."""
    return build_cube(star(spark, sf_dir), CubeSpec(dims=tuple(LIMITED), min_depth=1, max_depth=3, max_depth_by_dim={"o_orderpriority": 2}, facts=(Fact("n", "count", expr="1"),)))


@query(f"""WITH {STAR} SELECT r_name, count(DISTINCT o_custkey) AS customers, count(DISTINCT (o_custkey, c_mktsegment)) AS pairs,
  round(stddev_pop(l_quantity), 4) AS sd, round(avg(CASE WHEN regexp_matches(o_orderpriority, '^[12]-') THEN 100.0 ELSE 0 END), 4) AS urgent,
  round(avg(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 4) AS returned, round(sum(CASE WHEN l_quantity BETWEEN 5 AND 40 THEN l_quantity END), 4) AS mid,
  count(nullif(l_quantity % 5, 0)) AS odd, round(sum(coalesce(CASE WHEN l_quantity > 25 THEN l_quantity END, 1)), 4) AS filled,
  CAST(sum(CASE WHEN l_quantity <= 25 THEN 1 END) AS BIGINT) AS missing, count(CASE WHEN l_quantity > 25 THEN 1 END) AS present,
  {depth_sql(('r_name',))} FROM star GROUP BY CUBE (r_name)""")
def cube_fact_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregates, inputs and cleaning."""
    facts = (
        Fact("customers", "count_distinct", column="o_custkey"),
        Fact("pairs", "count_distinct", column="o_custkey", args=("c_mktsegment",)),
        Fact("sd", "stddev", column="l_quantity"),
        Fact("urgent", "percent", column="o_orderpriority", matches="^[12]-"),
        Fact("returned", "avg", column="l_quantity", when="l_returnflag = 'R'"),
        Fact("mid", "sum", column="l_quantity", between=(5, 40)),
        Fact("odd", "count", expr="l_quantity % 5", exclude_zeros=True),
        Fact("filled", "sum", expr="CASE WHEN l_quantity > 25 THEN l_quantity END", default=1),
        Fact("missing", "num_missing", expr="CASE WHEN l_quantity > 25 THEN 1 END"),
        Fact("present", "num_non_missing", expr="CASE WHEN l_quantity > 25 THEN 1 END"),
        Fact("hidden", "sum", column="l_quantity", exclude=True),
    )
    return rounded(build_cube(star(spark, sf_dir), CubeSpec(dims=("r_name",), facts=facts)))


@query(f"""WITH {STAR} SELECT c_mktsegment, round(quantile_cont(revenue, 0.25), 4) AS revenue_25th_percentile, round(quantile_cont(revenue, 0.5), 4) AS revenue_50th_percentile,
  round(quantile_cont(revenue, 0.9), 4) AS revenue_90th_percentile, {depth_sql(('c_mktsegment',))} FROM star GROUP BY CUBE (c_mktsegment)""")
def cube_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact percentiles, one column each."""
    return rounded(build_cube(star(spark, sf_dir), CubeSpec(dims=("c_mktsegment",), facts=(Fact("revenue", "percentile", pcts=(25, 50, 90), exact=True),))))


@query()
def cube_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate distinct counts, percentiles and histogram quantiles, sets."""
    facts = (
        Fact("customers", "approx_count_distinct", column="o_custkey"),
        Fact("revenue", "percentile", pcts=(30, 70), round_first=0),
        Fact("quantity", "hist_percentile", column="l_quantity", pcts=(25, 50, 75), bins=100),
        Fact("segments", "collect_set", column="c_mktsegment"),
    )
    return build_cube(star(spark, sf_dir), CubeSpec(dims=("r_name", "l_returnflag"), facts=facts))


def hist_sql(name: str, value: str, pcts: tuple[int, ...]) -> str:
    """Exact quantiles on the line between neighbouring values, for each cell: what a histogram with room for all values gives."""
    at = ", ".join(f"round(min_by(coalesce(prev + (v - prev) * (total * {p / 100} - (seen - n)) / n, v), v) FILTER (seen >= total * {p / 100}), 4) AS {name}_{p}th_percentile" for p in pcts)
    return f"""{name}_c AS (SELECT r_name, l_returnflag, {value} AS v, count(*) AS n FROM star GROUP BY GROUPING SETS ((v), (r_name, v), (l_returnflag, v), (r_name, l_returnflag, v))),
  {name}_s AS (SELECT *, sum(n) OVER w AS seen, sum(n) OVER (PARTITION BY r_name, l_returnflag) AS total, lag(v) OVER w AS prev FROM {name}_c WINDOW w AS (PARTITION BY r_name, l_returnflag ORDER BY v)),
  {name} AS (SELECT r_name, l_returnflag, {at} FROM {name}_s GROUP BY 1, 2)"""


@query(f"""WITH {STAR}, {hist_sql('quantity', 'l_quantity', (25, 50, 75))}, {hist_sql('income', 'floor(revenue / 2000 + 0.5) * 2000', (10, 90))}, {hist_sql('tens', 'round(l_quantity, -1)', (50,))}
  SELECT a.*, b.* EXCLUDE (r_name, l_returnflag), c.* EXCLUDE (r_name, l_returnflag), {depth_sql(('a.r_name', 'a.l_returnflag'))} FROM quantity a JOIN income b ON a.r_name IS NOT DISTINCT FROM b.r_name AND a.l_returnflag IS NOT DISTINCT FROM b.l_returnflag
  JOIN tens c ON a.r_name IS NOT DISTINCT FROM c.r_name AND a.l_returnflag IS NOT DISTINCT FROM c.l_returnflag""")
def cube_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles from histograms that hold all values, of values as they are, of multiples of a step, and of rounded ones."""
    facts = (
        Fact("quantity", "hist_percentile", column="l_quantity", pcts=(25, 50, 75), bins=100),
        Fact("income", "hist_percentile", column="revenue", pcts=(10, 90), bins=200, error=2000),
        Fact("tens", "hist_percentile", column="l_quantity", pcts=(50,), bins=50, round_first=-1),
    )
    return rounded(build_cube(star(spark, sf_dir), CubeSpec(dims=("r_name", "l_returnflag"), facts=facts)))


@query(f"WITH {STAR} SELECT r_name, l_returnflag, true AS distinct_fits, true AS percentiles_fit FROM star GROUP BY CUBE (r_name, l_returnflag)")
def cube_approximate_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate facts against exact ones: distinct counts within three deviations, percentiles within 1 % of the range."""
    facts = (Fact("near", "approx_count_distinct", column="o_custkey"), Fact("customers", "count_distinct", column="o_custkey"), Fact("a", "percentile", column="revenue", pcts=(30, 70)), Fact("b", "percentile", column="revenue", pcts=(30, 70), exact=True), Fact("low", "min", column="revenue"), Fact("high", "max", column="revenue"))
    out = build_cube(star(spark, sf_dir), CubeSpec(dims=("r_name", "l_returnflag"), facts=facts))
    fits = [F.abs(F.col(f"a_{p}th_percentile") - F.col(f"b_{p}th_percentile")) <= 0.01 * (F.col("high") - F.col("low")) for p in (30, 70)]
    return out.select("r_name", "l_returnflag", (F.abs(F.col("near") - F.col("customers")) <= 1 + 3 * 0.03 * F.col("customers")).alias("distinct_fits"), (fits[0] & fits[1]).alias("percentiles_fit"))


@query(f"WITH {STAR} SELECT r_name, c_mktsegment, true AS fits FROM star GROUP BY CUBE (r_name, c_mktsegment)")
def cube_partitioned_distinct_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sums of yearly approximate distinct counts are within three deviations of the exact sums."""
    df, dims = star(spark, sf_dir), ["r_name", "c_mktsegment"]
    near = build_cube(df, CubeSpec(dims=tuple(dims), partition_by=("yr_cd",), facts=(Fact("customers", "count_distinct_partitioned", column="o_custkey"),)))
    exact = build_cube(df, CubeSpec(dims=(*dims, "yr_cd"), mandatory=("yr_cd",), facts=(Fact("n", "count_distinct", column="o_custkey"),))).groupBy(*dims).agg(F.sum("n").alias("n"))
    same = F.col("a.r_name").eqNullSafe(F.col("b.r_name")) & F.col("a.c_mktsegment").eqNullSafe(F.col("b.c_mktsegment"))
    return near.alias("a").join(exact.alias("b"), same).select("a.r_name", "a.c_mktsegment", (F.abs(F.col("customers") - F.col("n")) <= 1 + 3 * 0.03 * F.col("n")).alias("fits"))


@query(f"""WITH {STAR}, one AS (SELECT l_returnflag, c_mktsegment, yr_cd, avg(CASE WHEN regexp_matches(o_orderpriority, '^1-') THEN 100.0 ELSE 0 END) AS p
  FROM star GROUP BY GROUPING SETS ((yr_cd), (l_returnflag, yr_cd), (c_mktsegment, yr_cd), (l_returnflag, c_mktsegment, yr_cd)))
  SELECT l_returnflag, c_mktsegment, round(quantile_cont(p, 0.3), 4) AS urgent_30th_percentile, round(quantile_cont(p, 0.7), 4) AS urgent_70th_percentile,
  {depth_sql(('l_returnflag', 'c_mktsegment'))} FROM one GROUP BY l_returnflag, c_mktsegment""")
def cube_two_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles over yearly percentages."""
    spec = CubeSpec(dims=("l_returnflag", "c_mktsegment"), partition_by=("yr_cd",), facts=(Fact("urgent", "percentile_of_percentages", column="o_orderpriority", matches="^1-", pcts=(30, 70), exact=True),))
    return rounded(build_cube(star(spark, sf_dir), spec))


@query()
def cube_partitioned_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of yearly approximate distinct counts."""
    return build_cube(star(spark, sf_dir), CubeSpec(dims=("r_name", "c_mktsegment"), partition_by=("yr_cd",), facts=(Fact("customers", "count_distinct_partitioned", column="o_custkey"),)))


@query(f"""WITH {STAR}, cells AS (SELECT r_name, l_returnflag, sum(revenue) AS revenue, sum(l_quantity) AS quantity FROM star WHERE yr_cd >= '1996' GROUP BY CUBE (r_name, l_returnflag)),
  more AS (SELECT *, revenue / quantity AS price FROM cells)
  SELECT r_name, l_returnflag, round(revenue, 4) AS revenue, round(quantity, 2) AS quantity, round(CASE WHEN price >= 1000 THEN price END, 4) AS price, {depth_sql(('r_name', 'l_returnflag'))}
  FROM more WHERE quantity > 100""")
def cube_post_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived columns with a range, filters before and after."""
    spec = CubeSpec(dims=("r_name", "l_returnflag"), facts=(Fact("revenue"), Fact("quantity", column="l_quantity")), filters=("yr_cd >= '1996'",), post=(Derived("price", "revenue / quantity", (1000, None)),), post_filters=("quantity > 100",))
    return build_cube(star(spark, sf_dir), spec).withColumns({"revenue": F.round("revenue", 4), "quantity": F.round("quantity", 2), "price": F.round("price", 4)})


CALENDAR = """days AS (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY))::DATE AS d),
  coded AS (SELECT CAST(year(d) AS VARCHAR) AS yr_cd, CAST(year(d) AS VARCHAR) || 'Q' || CAST(quarter(d) AS VARCHAR) AS qtr_cd, strftime(d, '%Y%m') AS mnth_cd,
    CAST(isoyear(d) AS VARCHAR) || 'W' || lpad(CAST(weekofyear(d) AS VARCHAR), 2, '0') AS wk_cd FROM days),
  calendar AS (SELECT yr_cd, qtr_cd, mnth_cd, wk_cd, count(*) AS days FROM coded GROUP BY GROUPING SETS ((yr_cd), (yr_cd, qtr_cd), (yr_cd, qtr_cd, mnth_cd), (wk_cd)))"""


@query(f"WITH {CALENDAR}, {STAR}, cells AS (SELECT yr_cd, qtr_cd, mnth_cd, sum(l_quantity) AS quantity FROM star GROUP BY GROUPING SETS ((yr_cd), (yr_cd, qtr_cd), (yr_cd, qtr_cd, mnth_cd))) SELECT a.yr_cd, a.qtr_cd, a.mnth_cd, round(a.quantity, 2) AS quantity, b.days AS sys_calendar_days, round(a.quantity / b.days, 4) AS per_day FROM cells a JOIN calendar b ON a.yr_cd = b.yr_cd AND a.qtr_cd IS NOT DISTINCT FROM b.qtr_cd AND a.mnth_cd IS NOT DISTINCT FROM b.mnth_cd")
def cube_calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar days of each cell's period."""
    spec = CubeSpec(hierarchies=(("yr_cd", "qtr_cd", "mnth_cd"),), mandatory=("yr_cd",), facts=(Fact("quantity", column="l_quantity"),))
    cells = with_calendar_days(build_cube(star(spark, sf_dir), spec), calendar_rollup(spark, "1995-01-01", "2001-12-31"))
    return cells.select("yr_cd", "qtr_cd", "mnth_cd", F.round("quantity", 2).alias("quantity"), "sys_calendar_days", F.round(F.col("quantity") / F.col("sys_calendar_days"), 4).alias("per_day"))


@query(f"""WITH {CALENDAR}, n AS (SELECT strftime(o_orderdate, '%Y%m') AS m, count(*) AS orders FROM orders GROUP BY 1)
  SELECT yr_cd, qtr_cd, mnth_cd, days, coalesce(orders, 0) AS orders FROM calendar LEFT JOIN n ON m = mnth_cd WHERE mnth_cd IS NOT NULL""")
def calendar_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar's months with their orders."""
    n = read(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyyMM").alias("mnth_cd")).agg(F.count("*").alias("orders"))
    months = calendar_rollup(spark, "1995-01-01", "2001-12-31").filter("mnth_cd is not null")
    return months.join(n, "mnth_cd", "left").select("yr_cd", "qtr_cd", "mnth_cd", "days", F.coalesce("orders", F.lit(0)).alias("orders"))


@query(f"""WITH {STAR}, n AS (SELECT count(DISTINCT c_mktsegment) AS a, count(DISTINCT o_orderpriority) AS b, count(DISTINCT (r_name, n_name)) AS c, count(DISTINCT (yr_cd, qtr_cd, mnth_cd)) AS d FROM star)
  SELECT 'c_mktsegment' AS dimension, CAST(a AS DOUBLE) AS cardinality, CAST(NULL AS VARCHAR) AS warning FROM n UNION ALL SELECT 'o_orderpriority', b, NULL FROM n UNION ALL
  SELECT 'r_name > n_name', c, NULL FROM n UNION ALL SELECT 'yr_cd > qtr_cd > mnth_cd', d, NULL FROM n UNION ALL SELECT '(cells)', CAST((a + 1) * (b + 1) * (c + 1) * (d + 1) AS DOUBLE), NULL FROM n""")
def cube_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts and the potential size."""
    return scan_dimensions(star(spark, sf_dir), FLAGSHIP)


@query("""WITH v AS (SELECT l_returnflag, floor(greatest(5, least(45, l_quantity)) / 2.5) * 2.5 AS b FROM lineitem), n AS (SELECT l_returnflag, b, count(*) AS c FROM v GROUP BY ALL),
  s AS (SELECT *, sum(c) OVER (PARTITION BY l_returnflag ORDER BY b) AS seen, sum(c) OVER (PARTITION BY l_returnflag) AS whole FROM n)
  SELECT l_returnflag, min(CASE WHEN seen * 100 >= whole * 25 THEN b END) AS p25, min(CASE WHEN seen * 100 >= whole * 50 THEN b END) AS p50, min(CASE WHEN seen * 100 >= whole * 90 THEN b END) AS p90 FROM s GROUP BY 1""")
def cube_binned_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles by bins of fixed width."""
    return binned_percentile(read(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity", 2.5, 5, 45, (25, 50, 90))


@query(f"WITH {STAR} SELECT r_name, count(*) AS n, {depth_sql(('r_name',))} FROM star GROUP BY CUBE (r_name)")
def cube_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input dealt by given columns."""
    spec = CubeSpec(dims=("r_name",), facts=(Fact("n", "count", expr="1"),))
    return build_cube(distribute(star(spark, sf_dir), spec, ("o_custkey",)), spec)
