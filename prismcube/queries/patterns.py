"""Pattern queries (M)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prismcube.operators import patterns as m
from prismcube.operators.intervals import join_contained, join_point_by_key, join_point_in_disjoint, join_point_in_interval
from prismcube.queries.registry import query, read, rounded
from prismcube.sources.checkpoints import new_path
from prismcube.sources.tables import archive_snapshot


@query("SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, max(o_orderdate) AS o_orderdate FROM orders GROUP BY 1")
def pattern_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: the latest order of each customer."""
    return m.latest_by(read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


SPANS = """spans AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS TIMESTAMP) AS s, lead(CAST(o_orderdate AS TIMESTAMP)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS e FROM orders)"""


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's time until the customer's next order."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("start"), F.lead(F.col("o_orderdate").cast("timestamp")).over(w).alias("end"))


@query(f"WITH {SPANS}, years AS (SELECT o_custkey, date_trunc('year', min(s)) AS s, date_trunc('year', min(s)) + INTERVAL 2 YEAR AS e FROM spans GROUP BY 1) SELECT a.o_orderkey, b.s AS start_b FROM spans a JOIN years b ON a.o_custkey = b.o_custkey AND a.s >= b.s AND a.e <= b.e")
def pattern_contained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: spans inside the customer's first two years."""
    own = spans(spark, sf_dir)
    first = F.date_trunc("year", F.min("start"))
    years = own.groupBy("o_custkey").agg(first.alias("start"), (first + F.expr("interval 2 years")).alias("end"))
    return join_contained(own, years, ["o_custkey"]).select("o_orderkey", "start_b")


@query(f"WITH {SPANS}, p AS (SELECT l_orderkey, l_linenumber, l_shipdate, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey) SELECT l_orderkey, l_linenumber, o_orderkey FROM p JOIN spans USING (o_custkey) WHERE l_shipdate BETWEEN s AND e")
def pattern_point_in_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: ship dates in the spans of the same customer, of whom each has few."""
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    p = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate").join(o, "l_orderkey")
    return join_point_by_key(p, spans(spark, sf_dir), ["o_custkey"], "l_shipdate").select("l_orderkey", "l_linenumber", "o_orderkey")


#: Half of all orders under one key.
HOT = "hot AS (SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_custkey END AS k, CAST(o_orderdate AS TIMESTAMP) AS d FROM orders)"


def hot_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", F.when(F.col("o_orderstatus") == "F", 0).otherwise(F.col("o_custkey")).alias("k"), F.col("o_orderdate").cast("timestamp").alias("d"))


@query(f"""WITH {HOT}, i AS (SELECT k, d AS s, lead(d) OVER (PARTITION BY k ORDER BY d) AS e FROM (SELECT DISTINCT k, d FROM hot)),
  p AS (SELECT k, l_orderkey, l_linenumber, l_shipdate FROM lineitem JOIN hot ON l_orderkey = o_orderkey) SELECT k, l_orderkey, l_linenumber, s AS start FROM p JOIN i USING (k) WHERE l_shipdate BETWEEN s AND e""")
def interval_hot_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: ship dates between the order days of a key that holds much of all rows."""
    o = hot_orders(spark, sf_dir)
    w = Window.partitionBy("k").orderBy("d")
    spans = o.select("k", "d").distinct().select("k", F.col("d").alias("start"), F.lead("d").over(w).alias("end"))
    p = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate").join(o.select(F.col("o_orderkey").alias("l_orderkey"), "k"), "l_orderkey")
    return join_point_in_disjoint(p, spans, ["k"], "l_shipdate").select("k", "l_orderkey", "l_linenumber", "start")


LINES = "l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_suppkey END AS k, CAST(l_shipdate AS TIMESTAMP) AS s, CAST(l_shipdate AS TIMESTAMP) + to_days(CAST(l_quantity AS INT)) AS e FROM lineitem)"
TERMS = "b AS (SELECT DISTINCT CASE WHEN p_size < 25 THEN 0 ELSE p_partkey % 100 END AS k, TIMESTAMP '1995-01-01' + to_days(CAST(p_partkey AS INT)) AS s, TIMESTAMP '1995-01-01' + to_days(CAST(p_partkey + p_size AS INT)) AS e FROM part)"


def lines_and_terms(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ship = F.col("l_shipdate").cast("timestamp")
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "R", 0).otherwise(F.col("l_suppkey")).alias("k"), ship.alias("start"), (ship + F.make_dt_interval(F.col("l_quantity").cast("int"))).alias("end"))
    day = lambda n: F.lit("1995-01-01").cast("timestamp") + F.make_dt_interval(n.cast("int"))
    part = read(spark, sf_dir, "part")
    terms = part.select(F.when(F.col("p_size") < 25, 0).otherwise(F.col("p_partkey") % 100).alias("k"), day(F.col("p_partkey")).alias("start"), day(F.col("p_partkey") + F.col("p_size")).alias("end")).distinct()
    return lines, terms


@query(f"WITH {LINES}, {TERMS} SELECT b.k, b.s AS start_b, b.e AS end_b, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS orders FROM l JOIN b ON l.k = b.k AND l.s >= b.s AND l.e <= b.e GROUP BY ALL")
def interval_hot_contained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: the lines whose time lies inside a term, where one key holds much of both sides."""
    found = join_contained(*lines_and_terms(spark, sf_dir), ["k"])
    return found.groupBy("k", "start_b", "end_b").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("orders"))


@query(f"WITH {LINES}, {TERMS} SELECT b.k, b.s AS start, b.e AS \"end\", count(*) AS n FROM l JOIN b ON l.k = b.k AND l.s BETWEEN b.s AND b.e GROUP BY ALL")
def interval_overlapping_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: the lines shipped during terms that overlap each other."""
    lines, terms = lines_and_terms(spark, sf_dir)
    found = join_point_in_interval(lines.select("l_orderkey", "k", F.col("start").alias("at")), terms, ["k"], "at")
    return found.groupBy("k", "start", "end").agg(F.count("*").alias("n"))


@query(f"""WITH {SPANS}, c AS (SELECT o_custkey, min(s) AS s, CASE WHEN max(s) < TIMESTAMP '2001-06-01' THEN max(s) END AS e, min(c_mktsegment) AS seg FROM spans JOIN customer ON o_custkey = c_custkey GROUP BY 1),
  p AS (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-07-01', INTERVAL 3 MONTH)) AS period_start), a AS (SELECT *, e IS NULL OR e >= period_start + INTERVAL 3 MONTH - INTERVAL 1 DAY AS kept FROM c JOIN p ON s <= period_start AND (e IS NULL OR e >= period_start))
  SELECT 'quarter' AS period, period_start, seg, count(DISTINCT o_custkey) AS active, count(DISTINCT CASE WHEN kept THEN o_custkey END) AS retained, round(100.0 * count(DISTINCT CASE WHEN kept THEN o_custkey END) / count(DISTINCT o_custkey), 4) AS retention FROM a GROUP BY GROUPING SETS ((period_start), (period_start, seg))""")
def pattern_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: customers active at a quarter's start and still at its end."""
    last = F.max("start")
    c = spans(spark, sf_dir).groupBy("o_custkey").agg(F.min("start").alias("s"), F.when(last < F.lit("2001-06-01").cast("timestamp"), last).alias("e"))
    c = c.join(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("seg")), "o_custkey")
    return rounded(m.retention(c, "o_custkey", "s", "e", ["seg"], {"quarter": "quarter"}, "1995-01-01", "2001-07-31"))


@query("SELECT c_custkey, 'c_acctbal' AS metric, c_acctbal AS value FROM customer UNION ALL SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS DOUBLE) FROM customer")
def pattern_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: metrics as rows."""
    return m.unpivot_metrics(read(spark, sf_dir, "customer"), ["c_custkey"], ["c_acctbal", "c_nationkey"])


@query("SELECT c_custkey, md5(concat_ws('|', CAST(c_custkey AS VARCHAR), coalesce(CASE WHEN c_nationkey > 5 THEN c_name END, '-'))) AS row_id FROM customer")
def pattern_hash_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: row ids."""
    c = read(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_nationkey") > 5, F.col("c_name")).alias("n"))
    return m.hash_id(c, ["c_custkey", "n"]).select("c_custkey", "row_id")


@query("""WITH g AS (SELECT l_orderkey, l_linenumber, l_quantity AS q, min(l_quantity) OVER w AS lo, max(l_quantity) OVER w AS hi, l_linenumber % 2 AS a, l_orderkey % 2 AS b, l_discount AS mw, CASE WHEN l_returnflag = 'R' THEN 0.5 ELSE 1 END AS w1, CASE WHEN l_linestatus = 'O' THEN 1.25 ELSE 1 END AS w2 FROM lineitem WINDOW w AS (PARTITION BY l_orderkey))
  SELECT l_orderkey, l_linenumber, CASE WHEN q = lo THEN 'MIN_' WHEN q = hi THEN 'MAX_' ELSE '' END || 'DIFF' || CASE WHEN a <> b THEN '_TIME' ELSE '' END AS reason, round(q * mw * w1 * w2, 6) AS weighted_score FROM g""")
def pattern_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7, M8: refined reasons and weighted scores."""
    w, o, n = Window.partitionBy("l_orderkey"), F.col("l_orderkey"), F.col("l_linenumber")
    g = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("q"), F.min("l_quantity").over(w).alias("lo"), F.max("l_quantity").over(w).alias("hi"), (n % 2).alias("a"), (o % 2).alias("b"), F.col("l_discount").alias("mw"), F.when(F.col("l_returnflag") == "R", "R").alias("d1"), F.lit(0.5).alias("w1"), F.when(F.col("l_linestatus") == "O", "O").alias("d2"), F.lit(1.25).alias("w2"), F.lit("DIFF").alias("reason"))
    out = m.weight_score(m.refine_reason(g, "reason", "q", "lo", "hi", "a", "b"), "q", "mw", {"d1": "w1", "d2": "w2"})
    return rounded(out.select("l_orderkey", "l_linenumber", "reason", "weighted_score"), 6)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, user_id FROM events")
def pattern_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: metrics into JSON, and paths read from it."""
    e = read(spark, sf_dir, "events").select("event_id", "user_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    j = m.metrics_json(e, ["k", "user_id"])
    return j.select("event_id", F.get_json_object("metrics_json", "$.k").cast("int").alias("k"), F.get_json_object("metrics_json", "$.user_id").cast("long").alias("user_id"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_partkey, l_suppkey) = 1")
def pattern_drop_duplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ids that stand twice go."""
    return m.drop_duplicated_ids(read(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber")


CELLS = """cells AS (SELECT o_custkey AS k, strftime(o_orderdate, '%Y%m') AS mnth, CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END AS st, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS pr, o_orderkey AS id, o_orderkey % 5 AS size FROM orders)"""


def pruned_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.date_format("o_orderdate", "yyyyMM").alias("mnth"), F.when(k % 4 == 0, F.col("o_orderstatus")).alias("st"), F.when(k % 3 == 0, F.col("o_orderpriority")).alias("pr"), k.alias("id"), (k % 5).alias("size"))


@query(f"WITH {CELLS}, l AS (SELECT k, max(mnth) AS last FROM cells WHERE st IS NULL AND pr IS NULL GROUP BY 1) SELECT id FROM cells LEFT JOIN l USING (k) WHERE st IS NOT NULL OR pr IS NOT NULL OR mnth = last")
def pattern_prune_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the latest month of coarse rows."""
    return m.prune_time(pruned_cells(spark, sf_dir), ["k"], "mnth", ["st", "pr"]).select("id")


@query(f"WITH {CELLS} SELECT id FROM cells QUALIFY dense_rank() OVER (PARTITION BY k, size ORDER BY (st IS NOT NULL)::INT * 2 + (pr IS NOT NULL)::INT DESC) = 1")
def pattern_prune_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most specific cells of equal size."""
    return m.prune_dims(pruned_cells(spark, sf_dir), ["k"], "size", ["st", "pr"]).select("id")


@query("""WITH b AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 40 = 0 THEN l_partkey ELSE l_suppkey * 100000 + l_partkey % 4 END AS g, l_quantity AS v FROM lineitem), s AS (SELECT g, count(v) AS n, avg(v) AS a, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3, avg(ln(v)) AS lm, stddev_pop(ln(v)) AS ls FROM b GROUP BY 1)
  SELECT l_orderkey, l_linenumber, n AS group_size, round(CASE WHEN n <= 2 THEN 40 WHEN n <= 4 THEN a WHEN n <= 20 AND q3 > q1 THEN q3 + 1.25 * (q3 - q1) WHEN ls > 0 THEN exp(lm + 1.5 * ls) END, 4) AS threshold,
  coalesce(CASE WHEN n <= 2 THEN v > 40 WHEN n <= 4 THEN v > a WHEN n <= 20 AND q3 > q1 THEN v >= q3 + 1.25 * (q3 - q1) WHEN ls > 0 THEN (ln(v) - lm) / ls > 1.5 END, false) AS is_outlier FROM b JOIN s USING (g)""")
def pattern_outlier_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outliers by the size of the group."""
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    b = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(p % 40 == 0, p).otherwise(s * 100000 + p % 4).alias("g"), F.col("l_quantity").alias("v"))
    return rounded(m.outlier_ladder(b, ["g"], "v", 40, exact=True).select("l_orderkey", "l_linenumber", "group_size", "threshold", "is_outlier"))


@query("WITH t AS (SELECT c_nationkey, c_name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_name) AS k FROM customer) SELECT c_nationkey, string_agg(c_name, ', ' ORDER BY k) AS top_list FROM t WHERE k <= 3 GROUP BY 1")
def pattern_top_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best as text."""
    return m.top_n_list(read(spark, sf_dir, "customer"), ["c_nationkey"], "c_name", "c_acctbal", 3)


@query("""WITH b AS (SELECT n_nationkey AS id, n_regionkey AS k, 1.0 * n_nationkey AS v FROM nation WHERE n_nationkey < 10), c AS (SELECT n_nationkey AS child, n_nationkey // 3 AS parent FROM nation), x AS (SELECT child AS id, k, v FROM b JOIN c ON b.id = c.parent)
  SELECT id, k, CAST(v AS DOUBLE) AS v FROM b UNION ALL SELECT id, k, CAST(v AS DOUBLE) FROM x WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.id = x.id AND b.k = x.k)""")
def pattern_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """parents' benchmarks for children without."""
    n = read(spark, sf_dir, "nation")
    b = n.filter("n_nationkey < 10").select(F.col("n_nationkey").alias("id"), F.col("n_regionkey").alias("k"), F.col("n_nationkey").cast("double").alias("v"))
    c = n.select(F.floor(F.col("n_nationkey") / 3).cast("int").alias("parent"), F.col("n_nationkey").alias("id"))
    return m.backfill_benchmark(b, c, "parent", "id", ["k"], ["v"])


PEERS = "p AS (SELECT s_suppkey, s_nationkey, s_nationkey % 5 AS grp, s_acctbal + 1000 AS v FROM supplier)"


def peers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", (F.col("s_nationkey") % 5).alias("grp"), (F.col("s_acctbal") + 1000).alias("v"))


ZS = """z AS (SELECT *, CASE WHEN stddev_pop(v) OVER (PARTITION BY grp) > 0 THEN (v - avg(v) OVER (PARTITION BY grp)) / stddev_pop(v) OVER (PARTITION BY grp) END AS z1, CASE WHEN stddev_pop(v) OVER () > 0 THEN (v - avg(v) OVER ()) / stddev_pop(v) OVER () END AS z2,
  CASE WHEN stddev_pop(l) OVER (PARTITION BY grp) > 0 THEN (l - avg(l) OVER (PARTITION BY grp)) / stddev_pop(l) OVER (PARTITION BY grp) END AS lz1, CASE WHEN stddev_pop(l) OVER () > 0 THEN (l - avg(l) OVER ()) / stddev_pop(l) OVER () END AS lz2,
  v - avg(v) OVER (PARTITION BY grp) AS d1, v - avg(v) OVER () AS d2 FROM (SELECT *, CASE WHEN v > 0 THEN ln(v) END AS l FROM p))"""


@query(f"WITH {PEERS}, {ZS} SELECT s_suppkey, round(z1, 4) AS zscore_group, round(lz1, 4) AS log_zscore_group, round(z2, 4) AS zscore_all, round(lz2, 4) AS log_zscore_all FROM z")
def pattern_level_zscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Z-scores at two levels."""
    out = m.multi_level_zscore(peers(spark, sf_dir), "v", {"group": ["grp"], "all": []})
    return rounded(out.select("s_suppkey", "zscore_group", "log_zscore_group", "zscore_all", "log_zscore_all"))


@query(f"WITH {PEERS}, {ZS}, e AS (SELECT *, avg(CASE WHEN d1 > 0 THEN d1 END) OVER (PARTITION BY grp) AS a1, avg(CASE WHEN d2 > 0 THEN d2 END) OVER () AS a2 FROM z) SELECT s_suppkey, coalesce(d1 >= a1 AND greatest(z1, lz1) > 1, false) AND coalesce(d2 >= a2 AND greatest(z2, lz2) > 1, false) AS exceeds FROM e")
def pattern_exceeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean exceedance at two levels."""
    return m.exceeds_peers(peers(spark, sf_dir), "v", {"group": ["grp"], "all": []}).select("s_suppkey", "exceeds")


@query("WITH a AS (SELECT o_custkey, sum(o_totalprice) AS a, date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) AS d FROM orders GROUP BY 1) SELECT o_custkey, CAST(d AS INT) AS observed_days, round(CASE WHEN d >= 30 THEN a * 365 / d END, 2) AS annual_amount FROM a")
def pattern_annualise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly amounts."""
    return m.annualise(read(spark, sf_dir, "orders"), ["o_custkey"], "o_totalprice", "o_orderdate", "o_orderdate").withColumn("annual_amount", F.round("annual_amount", 2))


@query(f"WITH {CELLS} SELECT CASE WHEN st IS NULL AND pr IS NULL THEN 'all' ELSE concat_ws('+', CASE WHEN st IS NOT NULL THEN 'st' END, CASE WHEN pr IS NOT NULL THEN 'pr' END) END AS grain, count(*) AS n, min(mnth) AS first FROM cells GROUP BY 1")
def pattern_grains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by which dimensions are set."""
    return m.grain_summary(pruned_cells(spark, sf_dir), ["st", "pr"], [F.count("*").alias("n"), F.min("mnth").alias("first")])


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS n_insights, count(DISTINCT o_custkey) AS n_o_custkey FROM orders GROUP BY 1, 2 HAVING count(*) >= 900")
def pattern_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts of large groups."""
    return m.insight_report(read(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"], ["o_custkey"], 900)


@query("WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS m FROM orders) SELECT o_orderkey, CASE m WHEN '200012' THEN 'last' WHEN '200011' THEN 'previous' ELSE 'year_ago' END AS period_kind FROM o WHERE m IN ('200012', '200011', '199912')")
def pattern_recent_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last month, the one before, a year ago."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("m"))
    return m.recent_periods(o, "m", "2001-01-15").select("o_orderkey", "period_kind")


@query("WITH f AS (SELECT n_nationkey, n_nationkey % 12 + 1 AS first_month, DATE '2024-02-10' - to_months(n_nationkey % 12) AS d FROM nation) SELECT n_nationkey, CAST(year(d) AS INT) AS fiscal_year, CAST(quarter(d) AS INT) AS fiscal_quarter, CAST(month(d) AS INT) AS fiscal_month FROM f")
def pattern_fiscal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fiscal position of a day."""
    n = read(spark, sf_dir, "nation").select("n_nationkey", (F.col("n_nationkey") % 12 + 1).alias("first_month"))
    return m.fiscal_today(n, "2024-02-10", "first_month").drop("first_month")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def pattern_latest_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the latest date."""
    return m.latest_partition(read(spark, sf_dir, "orders"), "o_orderdate").select("o_orderkey")


@query(f"""WITH {SPANS}, w AS (SELECT unnest(generate_series(DATE '1994-12-26', DATE '2001-12-31', INTERVAL 7 DAY))::DATE AS ws), x AS (SELECT o_orderkey, CAST(s AS DATE) AS s, CAST(e AS DATE) AS e FROM spans WHERE e IS NOT NULL)
  SELECT o_orderkey, strftime(ws, '%Y%m%d') AS wk_start, CAST(date_diff('day', greatest(s, ws), least(e, ws + 6)) + 1 AS INT) AS overlap_days FROM x JOIN w ON s <= ws + 6 AND e >= ws""")
def pattern_overlap_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlap of spans with calendar weeks."""
    weeks = spark.range(1).select(F.explode(F.sequence(F.lit("1994-12-26").cast("date"), F.lit("2001-12-31").cast("date"), F.expr("interval 7 days"))).alias("wk_start")).withColumn("wk_end", F.date_add("wk_start", 6))
    x = spans(spark, sf_dir).filter("end is not null")
    return m.join_overlap(x, weeks, "start", "end").select("o_orderkey", F.date_format("wk_start", "yyyyMMdd").alias("wk_start"), "overlap_days")


@query("SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def pattern_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with nation and region."""
    c = read(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    dims = [(read(spark, sf_dir, "nation"), ["n_nationkey"]), (read(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey"), ["n_regionkey"])]
    return m.enrich(c, dims).select("c_custkey", "n_name", "r_name")


@query("""WITH l AS (SELECT user_id AS k, strftime(ts, '%Y%m%d') AS wk, event_type AS t FROM events), x AS (SELECT k, max(wk) AS latest_week FROM l GROUP BY 1), u AS (SELECT c_custkey AS k FROM customer)
  SELECT u.k, latest_week, count(*) FILTER (t = 'click') AS n_click, count(*) FILTER (t = 'error') AS n_error FROM u LEFT JOIN x USING (k) LEFT JOIN l ON l.k = u.k AND l.wk = latest_week GROUP BY 1, 2""")
def pattern_load_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest load of each tenant; tenants are customers, of whom some have no events."""
    loads = read(spark, sf_dir, "events").select(F.col("user_id").alias("k"), F.date_format("ts", "yyyyMMdd").alias("wk"), F.col("event_type").alias("t"))
    return m.load_status(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), loads, "k", "wk", "t", ["click", "error"])


@query("SELECT '202401' AS wk_cd, count(*) AS n FROM supplier UNION ALL SELECT '202402', count(*) FROM supplier WHERE s_nationkey < 5")
def pattern_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots by week; a second one of a week replaces the first."""
    at, s = new_path(spark, "archive"), read(spark, sf_dir, "supplier")
    for week, rows in (("202401", s.limit(3)), ("202402", s.filter("s_nationkey < 5")), ("202401", s)):
        archive_snapshot(rows, at, week)
    return spark.read.parquet(at).groupBy(F.col("wk_cd").cast("string").alias("wk_cd")).agg(F.count("*").alias("n"))


@query("""WITH a AS (SELECT o_orderstatus AS st, o_orderpriority AS pr, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY CUBE (1, 2)), b AS (SELECT o_orderstatus AS st, o_orderpriority AS pr, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY CUBE (1, 2))
  SELECT a.st, a.pr, n, round(total / n, 4) AS per_line, round(n / (SELECT max(n) FROM b WHERE st IS NULL AND pr IS NULL), 4) AS n_share FROM a JOIN b ON a.st IS NOT DISTINCT FROM b.st AND a.pr IS NOT DISTINCT FROM b.pr""")
def pattern_drill_across(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cube of orders and one of their lines side by side, ratios and shares."""
    o = read(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("st"), F.col("o_orderpriority").alias("pr"), "o_totalprice", "o_orderkey")
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    a = o.cube("st", "pr").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    b = o.join(lines, "o_orderkey").cube("st", "pr").agg(F.count("*").alias("n"))
    return rounded(m.drill_across([a, b], ["st", "pr"], {"per_line": ("total", "n")}, "n").drop("total"))


@query("SELECT s_suppkey, s_nationkey, 'own' AS src FROM supplier WHERE s_suppkey % 3 = 0 UNION ALL SELECT s_suppkey, s_nationkey + 1, 'hand' FROM supplier WHERE s_suppkey % 3 <> 0")
def pattern_union_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows for keys that the first source lacks."""
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return m.union_missing(s.filter("s_suppkey % 3 = 0").withColumn("src", F.lit("own")), s.withColumn("s_nationkey", F.col("s_nationkey") + 1).withColumn("src", F.lit("hand")), ["s_suppkey"])


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN s_nationkey + 50 ELSE nullif(s_nationkey, 0) END AS n1, CASE WHEN s_suppkey % 5 = 0 AND s_suppkey % 2 = 0 THEN s_name WHEN s_suppkey % 5 = 0 THEN 'UNKNOWN' ELSE s_name END AS n2 FROM supplier WHERE s_nationkey > 0""")
def pattern_fill_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing values from an earlier snapshot."""
    s, k = read(spark, sf_dir, "supplier").filter("s_nationkey > 0"), F.col("s_suppkey")
    now = s.select(k, F.when(k % 4 > 0, F.col("s_nationkey")).otherwise(0).alias("n1"), F.when(k % 5 > 0, F.col("s_name")).otherwise("UNKNOWN").alias("n2"))
    old = s.select(k, (F.col("s_nationkey") + 50).alias("n1"), F.when(k % 2 == 0, F.col("s_name")).alias("n2"))
    return m.fill_from(now, old, ["s_suppkey"], ["n1", "n2"])


@query("""SELECT o_orderkey, CASE WHEN o_totalprice < 1000 THEN '<1000' WHEN o_totalprice < 50000 THEN '1000-50000' WHEN o_totalprice < 100000 THEN '50000-100000' ELSE '>=100000' END AS band FROM orders""")
def pattern_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size bands."""
    return read(spark, sf_dir, "orders").select("o_orderkey", m.band("o_totalprice", [1000, 50000, 100000]).alias("band"))


@query("""WITH f AS (SELECT o_custkey, min(o_orderdate) AS f FROM orders GROUP BY 1), m AS (SELECT *, (2001 - year(f)) * 12 + 12 - month(f) AS whole, CAST(last_day(CAST(f AS DATE)) AS DATE) = CAST(f AS DATE) OR day(f) = 31 AS even FROM f)
  SELECT o_custkey, round(round(whole + CASE WHEN even THEN 0 ELSE (86400.0 * (31 - day(f)) - date_diff('second', date_trunc('day', f), f)) / (31 * 86400) END, 8) / 12, 2) AS tenure FROM m""")
def pattern_tenure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years since the first order at a period's end."""
    first = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"))
    return first.select("o_custkey", m.tenure_years("first", F.lit("2001-12-31").cast("date")).alias("tenure"))
