"""Profile, rule and drift queries (G)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismcube.operators import shape, sketches
from prismcube.queries.registry import query, read, rounded
from prismcube.sources.checkpoints import new_path


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, d = read(spark, sf_dir, "orders"), F.col("o_orderdate")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", F.when(F.col("o_orderkey") % 11 > 0, F.col("o_totalprice")).alias("o_totalprice"), F.date_format(d, "yyyyMM").alias("mnth"), (F.year(d) * 12 + F.month(d)).alias("seq"), F.year(d).cast("string").alias("yr"))


ORDERS = "o AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 11 > 0 THEN o_totalprice END AS o_totalprice, strftime(o_orderdate, '%Y%m') AS mnth, year(o_orderdate) * 12 + month(o_orderdate) AS seq, CAST(year(o_orderdate) AS VARCHAR) AS yr FROM orders)"
RULES = (shape.ColumnRule("o_totalprice", nullable=False, minimum=1000, max_null_pct=5), shape.ColumnRule("o_orderstatus", valid=("F", "O"), min_cardinality=1, max_cardinality=3))


@query(f"""WITH {ORDERS} SELECT yr, 'o_totalprice' AS column_name, 'double' AS column_type, count(*) AS num_records, CAST(sum((o_totalprice IS NULL)::INT) AS BIGINT) AS num_missing,
  CAST(sum((o_totalprice IS NULL OR o_totalprice < 1000)::INT) AS BIGINT) AS num_invalid, round(avg(o_totalprice), 4) AS mean, round(stddev_pop(o_totalprice), 4) AS stddev, min(o_totalprice) AS min, max(o_totalprice) AS max,
  round(quantile_cont(o_totalprice, 0.05), 4) AS p5, round(quantile_cont(o_totalprice, 0.5), 4) AS p50, round(quantile_cont(o_totalprice, 0.95), 4) AS p95 FROM o GROUP BY 1
  UNION ALL SELECT yr, 'o_orderstatus', 'string', count(*), CAST(sum((o_orderstatus IS NULL)::INT) AS BIGINT), CAST(sum((o_orderstatus NOT IN ('F', 'O'))::INT) AS BIGINT), NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM o GROUP BY 1""")
def shape_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile by year."""
    out = shape.profile(orders(spark, sf_dir), ["yr"], analyze=["o_totalprice", "o_orderstatus"], rules=RULES, exact=True)
    return rounded(out.select("yr", "column_name", "column_type", "num_records", "num_missing", "num_invalid", "mean", "stddev", "min", "max", "p5", "p50", "p95"))


@query(f"""WITH {ORDERS}, v AS (SELECT yr, 'o_orderstatus' AS column_name, o_orderstatus AS v FROM o UNION ALL SELECT yr, 'o_custkey', CAST(o_custkey AS VARCHAR) FROM o), c AS (SELECT yr, column_name, v, count(*) AS n FROM v WHERE v IS NOT NULL GROUP BY ALL),
  t AS (SELECT yr, column_name, sum(n) AS t FROM c GROUP BY 1, 2) SELECT yr, column_name, count(*) AS distinct_count, round(count(*) / max(t), 4) AS distinctness, round(-sum(n / t * ln(n / t)), 4) AS entropy, round(count(*) FILTER (n = 1) / count(*), 4) AS unique_value_ratio FROM c JOIN t USING (yr, column_name) GROUP BY 1, 2""")
def shape_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinctness, entropy and unique values."""
    out = shape.profile(orders(spark, sf_dir), ["yr"], analyze=["o_orderstatus", "o_custkey"])
    return rounded(out.select("yr", "column_name", "distinct_count", "distinctness", "entropy", "unique_value_ratio"))


@query(f"""WITH {ORDERS}, a AS (SELECT yr, 'o_totalprice' AS column_name, count(*) AS n, sum((o_totalprice IS NULL)::INT) AS m, sum((o_totalprice IS NULL OR o_totalprice < 1000)::INT) AS i FROM o GROUP BY 1
  UNION ALL SELECT yr, 'o_orderstatus', count(*), 0, sum((o_orderstatus NOT IN ('F', 'O'))::INT) FROM o GROUP BY 1)
  SELECT yr, column_name, round(100.0 * m / n, 4) AS pct_missing, round(100 * (1 - i / n), 4) AS pct_valid, CASE WHEN i > 0 OR (column_name = 'o_totalprice' AND 100.0 * m > 5 * n) THEN 'FAIL' ELSE 'PASS' END AS status FROM a""")
def shape_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule results and shares."""
    out = shape.profile(orders(spark, sf_dir), ["yr"], analyze=["o_totalprice", "o_orderstatus"], rules=RULES)
    return rounded(shape.check_rules(shape.with_pct(out), RULES).select("yr", "column_name", "pct_missing", "pct_valid", "status"))


@query("SELECT max(strftime(o_orderdate, '%Y%m')) AS latest, CASE WHEN max(strftime(o_orderdate, '%Y%m')) = '200108' THEN 'PASS' ELSE 'FAIL' END AS status FROM orders")
def shape_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest partition must exist."""
    monthly = shape.normalise_period(orders(spark, sf_dir).groupBy(F.col("mnth").alias("mnth_cd")).agg(F.count("*").alias("n")))
    return shape.latest_exists(monthly, "yyyymm", "200108")


@query(f"WITH {ORDERS}, k AS (SELECT yr, o_custkey, count(*) AS n FROM o GROUP BY 1, 2) SELECT yr, count(*) FILTER (n > 1) AS n_duplicated, CASE WHEN count(*) FILTER (n > 1) > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM k GROUP BY 1")
def shape_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that stand more than once."""
    return shape.unique_check(orders(spark, sf_dir), ["o_custkey"], ["yr"])


MONTHLY = f"{ORDERS}, m AS (SELECT mnth, seq, count(*) AS n FROM o GROUP BY 1, 2)"


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).groupBy("mnth", "seq").agg(F.count("*").alias("n"))


@query(f"""WITH {MONTHLY}, d AS (SELECT *, n - lag(n) OVER (ORDER BY mnth) AS d FROM m), l AS (SELECT *, list(d) OVER (ORDER BY mnth ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS x FROM d),
  q AS (SELECT mnth, n, list_filter(x, lambda y: y IS NOT NULL) AS x, d FROM l), r AS (SELECT mnth, n, CASE WHEN len(x) = 7 THEN CASE WHEN list_max(x) = list_min(x) THEN 0.0 ELSE list_min(list_transform(x[1:6], lambda y: abs(y - d))) / (list_max(x) - list_min(x)) END END AS q FROM q)
  SELECT mnth, n, round(q, 4) AS dixon_q, CASE WHEN q IS NULL THEN 'WARN' WHEN q <= 0.507 THEN 'PASS' WHEN q <= 0.568 THEN 'WARN' ELSE 'FAIL' END AS status FROM r""")
def shape_dixon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dixon's test on monthly counts."""
    return rounded(shape.dixon_check(monthly(spark, sf_dir), "mnth", "n").select("mnth", "n", "dixon_q", "status"))


@query(f"""WITH {MONTHLY}, r AS (SELECT *, n / lag(n, 12) OVER w AS r, row_number() OVER w AS k, seq - lag(seq) OVER w AS step FROM m WINDOW w AS (ORDER BY seq)), s AS (SELECT *, r - lag(r) OVER (ORDER BY seq) AS s FROM r),
  t AS (SELECT *, avg(s) OVER b AS a, stddev_samp(s) OVER b AS d, max(coalesce(step, 1)) OVER (ORDER BY seq) AS gap FROM s WINDOW b AS (ORDER BY seq ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING))
  SELECT mnth, n, round(s, 4) AS seasonal, CASE WHEN k <= 37 OR gap <> 1 OR s IS NULL THEN 'ERROR' WHEN abs(s - a) <= 2 * d THEN 'PASS' WHEN abs(s - a) <= 3 * d THEN 'WARN' ELSE 'FAIL' END AS status FROM t""")
def shape_seasonality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seasonal check on monthly counts."""
    return rounded(shape.seasonality_check(monthly(spark, sf_dir), "seq", "n").select("mnth", "n", "seasonal", "status"))


@query(f"WITH {ORDERS} SELECT mnth, count(*) AS n FROM o WHERE mnth NOT LIKE '1995%' GROUP BY 1")
def shape_new_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only partitions without statistics are profiled."""
    o = orders(spark, sf_dir)
    known = o.filter("yr = '1995'").select("mnth").distinct()
    return shape.new_partitions(o, known, ["mnth"]).groupBy("mnth").agg(F.count("*").alias("n"))


def kept_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of all months, stored in three runs: one month, the years to 1998, then what is left."""
    o, store = orders(spark, sf_dir).drop("seq", "yr"), new_path(spark, "profiles")
    what = {"analyze": ["o_totalprice", "o_custkey", "o_orderstatus"], "rules": RULES}
    sketches.collect_profiles(o, store, ["mnth"], only="199703", **what)
    for rows in (o.filter("mnth < '199901'"), o):
        sketches.collect_profiles(rows, store, ["mnth"], **what)
    return sketches.stored(spark, store, ["mnth"])


@query(f"""WITH {ORDERS}, v AS (SELECT yr, unnest(['o_totalprice', 'o_custkey', 'o_orderstatus']) AS column_name, unnest(['double', 'bigint', 'string']) AS column_type, unnest([o_totalprice, CAST(o_custkey AS DOUBLE), NULL]) AS x,
    unnest([CAST(o_totalprice AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus]) AS t, unnest([o_totalprice IS NULL OR o_totalprice < 1000, false, o_orderstatus NOT IN ('F', 'O')]) AS bad FROM o)
  SELECT yr, column_name, column_type, count(*) AS num_records, count(*) - count(t) AS num_missing, CAST(sum(bad::INT) AS BIGINT) AS num_invalid, round(avg(x), 4) AS mean, round(stddev_pop(x), 4) AS stddev, min(x) AS min, max(x) AS max, true AS distinct_fits, CASE WHEN column_name <> 'o_orderstatus' THEN true END AS percentiles_fit
  FROM v GROUP BY 1, 2, 3""")
def shape_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored monthly profiles merged by year; counts and moments equal, percentiles and distinct counts within their bounds."""
    o = orders(spark, sf_dir)
    year = sketches.merged(kept_profiles(spark, sf_dir), {"yr": F.substring("mnth", 1, 4)})
    errors = sketches.quantile_errors(o, year, ["o_totalprice", "o_custkey"], ["yr"]).groupBy("yr", "column_name").agg((F.max("error") <= sketches.RANK_ERROR).alias("percentiles_fit"))
    exact = shape.profile(o, ["yr"], analyze=["o_totalprice", "o_custkey", "o_orderstatus"]).select("yr", "column_name", F.col("distinct_count").alias("d"))
    out = year.join(exact, ["yr", "column_name"]).join(errors, ["yr", "column_name"], "left")
    out = out.withColumn("distinct_fits", F.abs(F.col("distinct_count") - F.col("d")) <= F.greatest(F.lit(1.0), sketches.DISTINCT_ERROR * F.col("d")))
    return rounded(out.select("yr", "column_name", "column_type", "num_records", "num_missing", "num_invalid", "mean", "stddev", "min", "max", "distinct_fits", "percentiles_fit"))


@query("""WITH m AS (SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS mnth FROM orders) SELECT run, CAST(n AS BIGINT) AS n FROM (SELECT 'first' AS run, count(*) FILTER (mnth < '199901') AS n FROM m UNION ALL SELECT 'again', 0 UNION ALL SELECT 'more', count(*) FILTER (mnth >= '199901') FROM m
  UNION ALL SELECT 'one', count(*) FILTER (mnth = '199901') FROM m UNION ALL SELECT 'known', 0 UNION ALL SELECT 'rerun', count(*) FROM m)""")
def shape_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many partitions each run profiles: new ones, none twice, one on request, all in a rerun."""
    o, store = orders(spark, sf_dir), new_path(spark, "profiles")
    run = lambda rows, **how: sketches.collect_profiles(rows, store, ["mnth"], analyze=["o_totalprice"], **how)
    early = o.filter("mnth < '199901'")
    done = [("first", run(early)), ("again", run(early)), ("more", run(o)), ("one", run(o, rerun=True, only="199901")), ("known", run(o, only="199901")), ("rerun", run(o, rerun=True))]
    return spark.createDataFrame(done, "run string, n long")


@query("SELECT 'supplier' AS table_name, count(*) AS n FROM supplier WHERE s_nationkey < 10 UNION ALL SELECT 'customer', count(*) FROM customer WHERE c_nationkey < 5 UNION ALL SELECT 'region', count(*) FROM region")
def shape_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts under shared filters."""
    tables = {t: read(spark, sf_dir, t) for t in ("supplier", "customer", "region")}
    return shape.table_counts(tables, {"s_nationkey": "s_nationkey < 10", "c_nationkey": "c_nationkey < 5"})


@query("""WITH a AS (SELECT o_orderstatus, count(*) AS n_in, count(*) FILTER (o_orderkey % 10 <> 0 OR o_orderstatus = 'F') AS n_out FROM orders WHERE true GROUP BY 1) SELECT o_orderstatus, n_in, n_out, CASE WHEN (n_in - n_out) / n_in < 0.1 THEN 'PASS' ELSE 'FAIL' END AS status FROM a""")
def shape_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input against output."""
    o = read(spark, sf_dir, "orders")
    return shape.reconcile(o, o.filter("o_orderkey % 10 <> 0 or o_orderstatus = 'F'"), ["o_orderstatus"])
