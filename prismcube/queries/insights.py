"""Insight and correlation queries (B, C) over monthly cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismcube.operators.cube import build_cube
from prismcube.operators.insight import Dim, InsightSpec, add_diffs, compare_cells, correlate_facts, insights, lead_facts, log_normalise, rank_cells, unpivot_correlations, zscore
from prismcube.plans.cube_spec import CubeSpec, Fact
from prismcube.queries.cubes import STAR, star
from prismcube.queries.registry import query, read, rounded
from prismcube.sources.checkpoints import cut


def cells(spark: SparkSession, sf_dir: str, events: bool = False) -> DataFrame:
    """Cells by region, flag and quarter number; the quarter is always set. Written once, as every comparison reads them again.

    With events also the number of lines that the quantity rests on.
    """
    df = star(spark, sf_dir).withColumn("seq", (F.col("yr_cd").cast("int") * 4 + F.substring("qtr_cd", 6, 1).cast("int")).cast("string"))
    spec = CubeSpec(dims=("r_name", "l_returnflag", "seq"), mandatory=("seq",), facts=(Fact("revenue"), Fact("quantity", "avg", column="l_quantity"), *([Fact("quantity_events", "count", column="l_quantity")] if events else [])))
    cube = build_cube(df, spec).withColumn("seq", F.col("seq").cast("int")).drop("aggregation_depth")
    return cut(cube.withColumns({"revenue": F.round("revenue", 4), "quantity": F.round("quantity", 6)}), "cells")


CELLS = f"""{STAR}, cells AS MATERIALIZED (SELECT r_name, l_returnflag, CAST(yr_cd AS INT) * 4 + CAST(substr(qtr_cd, 6, 1) AS INT) AS seq, round(sum(revenue), 4) AS revenue, round(avg(l_quantity), 6) AS quantity
  FROM star GROUP BY GROUPING SETS ((yr_cd, qtr_cd), (yr_cd, qtr_cd, r_name), (yr_cd, qtr_cd, l_returnflag), (yr_cd, qtr_cd, r_name, l_returnflag)))"""
SPEC = InsightSpec(dims=(Dim("r_name", "variant", percentile=True), Dim("l_returnflag", "nullvariant", percentile=True), Dim("seq", "ephemeral", (1, 4))), facts=("revenue", "quantity"), rates=("quantity",), group=("seq",))
RIGHT = "b.r_name AS r_name_r, b.l_returnflag AS l_returnflag_r, b.seq AS seq_r, b.revenue AS revenue_r, b.quantity AS quantity_r"
PAIRS = f"""{CELLS}, pairs AS MATERIALIZED (
  SELECT a.*, {RIGHT}, 'r_name' AS varying FROM cells a JOIN cells b ON a.seq = b.seq AND a.l_returnflag IS NOT DISTINCT FROM b.l_returnflag WHERE a.r_name > b.r_name
  UNION ALL SELECT a.*, {RIGHT}, 'l_returnflag' FROM cells a JOIN cells b ON a.seq = b.seq AND a.r_name IS NOT DISTINCT FROM b.r_name WHERE a.l_returnflag IS NOT NULL AND b.l_returnflag IS NULL
  UNION ALL SELECT a.*, {RIGHT}, 'seq' FROM cells a JOIN cells b ON a.seq - 1 = b.seq AND a.r_name IS NOT DISTINCT FROM b.r_name AND a.l_returnflag IS NOT DISTINCT FROM b.l_returnflag
  UNION ALL SELECT a.*, {RIGHT}, 'seq' FROM cells a JOIN cells b ON a.seq - 4 = b.seq AND a.r_name IS NOT DISTINCT FROM b.r_name AND a.l_returnflag IS NOT DISTINCT FROM b.l_returnflag)"""
DIFFS = f"""{PAIRS}, diffs AS (SELECT *, CASE WHEN varying = 'seq' AND revenue <> 0 AND revenue_r <> 0 THEN revenue - revenue_r END AS diff_revenue,
  CASE WHEN varying = 'seq' AND revenue <> 0 AND revenue_r <> 0 THEN 100.0 * (revenue - revenue_r) / abs(revenue_r) END AS pctg_diff_revenue,
  CASE WHEN quantity <> 0 AND quantity_r <> 0 THEN quantity - quantity_r END AS diff_quantity,
  CASE WHEN quantity <> 0 AND quantity_r <> 0 THEN 100.0 * (quantity - quantity_r) / abs(quantity_r) END AS pctg_diff_quantity FROM pairs)"""


@query(f"WITH {PAIRS} SELECT * FROM pairs")
def insight_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1, B2: pairs of cells that differ in one dimension."""
    own = cells(spark, sf_dir)
    return compare_cells(own, own, SPEC)


HIER = InsightSpec(dims=(Dim("r_name", "nullvariant", below=("l_returnflag",)), Dim("l_returnflag", "nullvariant", above=("r_name",)), Dim("seq")), facts=("revenue",))


@query(f"""WITH {CELLS} SELECT a.r_name, a.l_returnflag, a.seq, a.revenue, b.r_name AS r_name_r, b.l_returnflag AS l_returnflag_r, b.seq AS seq_r, b.revenue AS revenue_r,
  'r_name' AS varying FROM cells a JOIN cells b ON a.seq = b.seq WHERE a.r_name IS NOT NULL AND b.r_name IS NULL AND a.l_returnflag IS NULL AND b.l_returnflag IS NULL
  UNION ALL SELECT a.r_name, a.l_returnflag, a.seq, a.revenue, b.r_name, b.l_returnflag, b.seq, b.revenue, 'l_returnflag' FROM cells a JOIN cells b ON a.seq = b.seq AND a.r_name = b.r_name WHERE a.l_returnflag IS NOT NULL AND b.l_returnflag IS NULL""")
def insight_hierarchy_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells against their parents in a hierarchy."""
    own = cells(spark, sf_dir)
    return compare_cells(own, own, HIER)


@query(f"WITH {DIFFS} SELECT r_name, l_returnflag, seq, r_name_r, l_returnflag_r, seq_r, varying, round(diff_revenue, 4) AS diff_revenue, round(pctg_diff_revenue, 4) AS pctg_diff_revenue, round(diff_quantity, 4) AS diff_quantity, round(pctg_diff_quantity, 4) AS pctg_diff_quantity FROM diffs")
def insight_diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences and percentage differences."""
    own = cells(spark, sf_dir)
    out = add_diffs(compare_cells(own, own, SPEC), SPEC)
    keys = [c for d in SPEC.dims for c in (d.name, f"{d.name}_r")]
    return out.select(*keys, "varying", F.round("diff_revenue", 4).alias("diff_revenue"), *(F.round(c, 4).alias(c) for c in ("pctg_diff_revenue", "diff_quantity", "pctg_diff_quantity")))


@query(f"""WITH {CELLS}, n AS (SELECT *, CASE WHEN quantity - 25.5 > 0 THEN ln(quantity - 25.5) END AS norm_d FROM cells)
  SELECT r_name, l_returnflag, seq, round(norm_d, 4) AS norm_d,
  round(CASE WHEN stddev_pop(revenue) OVER w <> 0 AND revenue <> 0 THEN (revenue - avg(revenue) OVER w) / stddev_pop(revenue) OVER w END, 4) AS zscore_revenue,
  round(CASE WHEN stddev_pop(norm_d) OVER w <> 0 AND norm_d <> 0 THEN (norm_d - avg(norm_d) OVER w) / stddev_pop(norm_d) OVER w END, 4) AS zscore_norm_d
  FROM n WINDOW w AS (PARTITION BY r_name, l_returnflag)""")
def insight_zscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logarithms and group z-scores."""
    own = log_normalise(cells(spark, sf_dir).withColumn("d", F.col("quantity") - 25.5), ["d"])
    return rounded(zscore(own, ["revenue", "norm_d"], ["r_name", "l_returnflag"]).select("r_name", "l_returnflag", "seq", "norm_d", "zscore_revenue", "zscore_norm_d"))


@query(f"""WITH {CELLS}, s AS (SELECT *, CASE WHEN r_name IS NULL THEN 'f' ELSE 'r' END AS p FROM cells WHERE (r_name IS NULL) <> (l_returnflag IS NULL))
  SELECT r_name, l_returnflag, seq, round(100 * percent_rank() OVER (PARTITION BY seq, p ORDER BY revenue), 4) AS percentile_revenue, min(revenue) OVER w AS min_revenue, max(revenue) OVER w AS max_revenue,
  round(CASE WHEN stddev_pop(revenue) OVER w <> 0 AND revenue <> 0 THEN (revenue - avg(revenue) OVER w) / stddev_pop(revenue) OVER w END, 4) AS zscore_revenue FROM s WINDOW w AS (PARTITION BY seq, p)""")
def insight_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slice for ranking, ranks and z-scores."""
    out = rank_cells(cells(spark, sf_dir), SPEC)
    return out.select("r_name", "l_returnflag", "seq", F.round("percentile_revenue", 4).alias("percentile_revenue"), "min_revenue", "max_revenue", F.round("zscore_revenue", 4).alias("zscore_revenue"))


@query(f"""WITH {DIFFS}, n AS (SELECT *, CASE WHEN diff_quantity > 0 THEN ln(diff_quantity) END AS nd, CASE WHEN pctg_diff_quantity > 0 THEN ln(pctg_diff_quantity) END AS np FROM diffs),
  z AS (SELECT *, CASE WHEN stddev_pop(diff_quantity) OVER w <> 0 AND diff_quantity <> 0 THEN (diff_quantity - avg(diff_quantity) OVER w) / stddev_pop(diff_quantity) OVER w END AS zd,
    CASE WHEN stddev_pop(pctg_diff_quantity) OVER w <> 0 AND pctg_diff_quantity <> 0 THEN (pctg_diff_quantity - avg(pctg_diff_quantity) OVER w) / stddev_pop(pctg_diff_quantity) OVER w END AS zp,
    CASE WHEN stddev_pop(nd) OVER w <> 0 AND nd <> 0 THEN (nd - avg(nd) OVER w) / stddev_pop(nd) OVER w END AS znd,
    CASE WHEN stddev_pop(np) OVER w <> 0 AND np <> 0 THEN (np - avg(np) OVER w) / stddev_pop(np) OVER w END AS znp FROM n WINDOW w AS (PARTITION BY seq, varying)),
  g AS (SELECT *, greatest(abs(zd) / 3, abs(zp), abs(znd), abs(znp)) AS top FROM z)
  SELECT r_name, l_returnflag, seq, r_name_r, l_returnflag_r, seq_r, varying, CAST((r_name IS NOT NULL)::INT + (l_returnflag IS NOT NULL)::INT + 1 AS INT) AS num_dimensions,
  CASE WHEN abs(zd) / 3 = top THEN 'ABS_DIFF' WHEN abs(zp) = top THEN 'PCTG_DIFF' WHEN abs(znd) = top THEN 'NORM_ABS_DIFF' ELSE 'NORM_PCTG_DIFF' END AS reason_quantity,
  round(abs(zd + coalesce(zp, 0)) * coalesce(abs(pctg_diff_quantity), 1), 2) AS score_quantity FROM g WHERE top IS NOT NULL
  UNION ALL SELECT r_name, l_returnflag, seq, NULL, NULL, NULL, NULL, CAST((r_name IS NOT NULL)::INT + (l_returnflag IS NOT NULL)::INT + 1 AS INT), 'PERCENTILE_RANKING', NULL FROM cells WHERE (r_name IS NULL) <> (l_returnflag IS NULL)""")
def insight_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked and compared rows with reasons and scores."""
    own = cells(spark, sf_dir)
    spec = InsightSpec(dims=SPEC.dims, facts=("quantity",), rates=("quantity",), group=("seq",))
    return insights(own, own, spec).drop("metrics_quantity")


def z_sql(column: str, by: str) -> str:
    return f"CASE WHEN stddev_pop({column}) OVER ({by}) <> 0 AND {column} <> 0 THEN ({column} - avg({column}) OVER ({by})) / stddev_pop({column}) OVER ({by}) END"


def metrics_sql(fact: str) -> str:
    """A row for each of the 29 metrics of a fact: of the compared pairs, then of the ranked cells."""
    pair, rank = "PARTITION BY seq, varying", "PARTITION BY seq, p"
    named = [f"diff_{fact}", f"pctg_diff_{fact}", "nd", "np"]
    dims = "r_name, l_returnflag, seq"
    two = lambda *xs: ", ".join(f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 16)), 2) AS DOUBLE)" for x in xs)
    stats = lambda c, by: (f"avg({c}) OVER ({by})", f"stddev_pop({c}) OVER ({by})")
    none = lambda n: ", ".join(["NULL"] * n)
    events = ("quantity_events", "quantity_events_r") if fact == "quantity" else ("NULL", "NULL")
    compared = ", ".join([two(fact, f"{fact}_r"), *events, two(*named, *(z_sql(c, pair) for c in named)), none(5), two(*(x for c in named for x in stats(c, pair))), none(4)])
    ranked = ", ".join([two(fact), "NULL", events[0], none(9), f"100 * percent_rank() OVER ({rank} ORDER BY {fact})", two(f"min({fact}) OVER ({rank})", f"max({fact}) OVER ({rank})"), z_sql(fact, rank), z_sql("lf", rank), none(8), two(*stats(fact, rank), *stats("lf", rank))])
    return f"""SELECT {dims}, r_name_r, l_returnflag_r, seq_r, varying, '{fact}' AS fact, unnest(x) AS value, unnest(range(29)) AS i, score FROM (
  SELECT *, [{compared}] AS x, round(abs(pctg_diff_{fact}), 2) AS score
  FROM (SELECT *, CASE WHEN diff_{fact} > 0 THEN ln(diff_{fact}) END AS nd, CASE WHEN pctg_diff_{fact} > 0 THEN ln(pctg_diff_{fact}) END AS np FROM diffs WHERE abs(pctg_diff_quantity) > 0.5))
  UNION ALL SELECT {dims}, NULL, NULL, NULL, NULL, '{fact}', unnest(x), unnest(range(29)), NULL FROM (SELECT *, [{ranked}] AS x
  FROM (SELECT *, r_name IS NULL AS p, CASE WHEN {fact} > 0 THEN ln({fact}) END AS lf FROM cells WHERE (r_name IS NULL) <> (l_returnflag IS NULL)))"""


QUANTITY = "round(avg(l_quantity), 6) AS quantity"
#: The SQL of differences over cells that have events.
WITH_EVENTS = DIFFS.replace(QUANTITY, f"{QUANTITY}, count(l_quantity) AS quantity_events").replace(RIGHT, f"{RIGHT}, b.quantity_events AS quantity_events_r")


@query(f"WITH {WITH_EVENTS}, m AS ({metrics_sql('revenue')} UNION ALL {metrics_sql('quantity')}) SELECT r_name, l_returnflag, seq, r_name_r, l_returnflag_r, seq_r, varying, fact, 'BY_' || fact AS reason, score, CAST(i AS INT) AS i, round(value, 4) + 0.0 AS value FROM m")
def insight_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics array of each fact and row, one row for each metric; reasons and scores from templates."""
    own = cells(spark, sf_dir, events=True)
    out = insights(own, own, InsightSpec(dims=SPEC.dims, facts=("revenue", "quantity"), rates=("quantity",), group=("seq",), reason="'BY_[fact]'", score="abs(pctg_diff_[fact])", prefilter="abs(pctg_diff_quantity) > 0.5"))
    dims = [c for d in SPEC.dims for c in (d.name, f"{d.name}_r")]
    each = lambda f: F.struct(F.lit(f).alias("fact"), F.col(f"reason_{f}").alias("reason"), F.col(f"score_{f}").alias("score"), F.col(f"metrics_{f}").alias("m"))
    rows = out.select(*dims, "varying", F.explode(F.array(each("revenue"), each("quantity"))).alias("f"))
    return rows.select(*dims, "varying", "f.fact", "f.reason", "f.score", F.posexplode("f.m").alias("i", "value")).withColumn("value", F.round("value", 4))


MONTHS = """months AS (SELECT n_regionkey, strftime(o_orderdate, '%Y%m') AS mnth, count(*) AS orders, round(sum(o_totalprice), 2) AS total, count(DISTINCT o_custkey) AS customers
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)"""


def months(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", F.date_format("o_orderdate", "yyyyMM").alias("mnth"))
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return orders.join(c, "o_custkey").join(n, "n_nationkey").groupBy("n_regionkey", "mnth").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.count_distinct("o_custkey").alias("customers"))


@query(f"WITH {MONTHS} SELECT *, lead(orders, 1, 0) OVER w AS orders_lead_1, lead(orders, 3, 0) OVER w AS orders_lead_3 FROM months WINDOW w AS (PARTITION BY n_regionkey ORDER BY mnth)")
def correlation_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later values of a series."""
    return lead_facts(months(spark, sf_dir), ["orders"], ["n_regionkey"], ["mnth"], [1, 3])


@query(f"""WITH {MONTHS}, led AS (SELECT *, lead(orders, 1, 0) OVER w AS o1, lead(total, 1, 0) OVER w AS t1, lead(customers, 1, 0) OVER w AS c1 FROM months WINDOW w AS (PARTITION BY n_regionkey ORDER BY mnth)),
  c AS (SELECT n_regionkey, 'orders' AS fact, 'total' AS other, 0 AS lag, corr(orders, total) AS r, count(*) AS n FROM led GROUP BY 1 UNION ALL SELECT n_regionkey, 'orders', 'total', 1, corr(orders, t1), count(*) FROM led GROUP BY 1
  UNION ALL SELECT n_regionkey, 'orders', 'customers', 0, corr(orders, customers), count(*) FROM led GROUP BY 1 UNION ALL SELECT n_regionkey, 'orders', 'customers', 1, corr(orders, c1), count(*) FROM led GROUP BY 1
  UNION ALL SELECT n_regionkey, 'total', 'customers', 0, corr(total, customers), count(*) FROM led GROUP BY 1 UNION ALL SELECT n_regionkey, 'total', 'customers', 1, corr(total, c1), count(*) FROM led GROUP BY 1)
  SELECT n_regionkey, fact, other, CAST(lag AS INT) AS lag, round(r, 4) AS corr, n FROM c""")
def correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlations by lag, as rows."""
    facts = ["orders", "total", "customers"]
    own = cut(months(spark, sf_dir), "months")  # read for the means, then for the sums
    return unpivot_correlations(correlate_facts(own, facts, ["n_regionkey"], order=["mnth"], leads=[1]), facts, ["n_regionkey"])
