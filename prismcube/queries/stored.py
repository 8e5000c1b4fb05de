"""Queries over tables kept in versions, buckets and keyed parts, and over extraction from many targets."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismcube.queries.registry import query, read
from prismcube.sources.checkpoints import new_path
from prismcube.sources.delta import delta
from prismcube.sources.extract import failed_targets
from prismcube.sources.keyed import KeyedTable, Layout, buckets_for, save_bucketed
from prismcube.sources.targets import Template, extract_targets, pair_log
from prismcube.sources.versions import SubsetError, VersionedTable


def three_versions(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Orders by status, under two changes of the schema: a column more, then one less and another type. Runs write some
    partitions each; the others are carried over."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    t = VersionedTable(spark, new_path(spark, "versions"), ["o_orderstatus"])
    t.write(o.drop("o_orderpriority"))
    t.write(o.drop("o_orderpriority").filter("o_orderstatus = 'P'").withColumn("o_totalprice", -F.col("o_totalprice")))  # the same version
    t.write(o.filter("o_orderstatus = 'O'"))
    t.write(o.filter("o_orderstatus = 'F'").select("o_orderkey", F.concat(F.lit("c"), "o_custkey").alias("o_custkey"), "o_orderpriority", "o_orderstatus"))
    return t


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'c' ELSE '' END || CAST(o_custkey AS VARCHAR) AS o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority, o_orderstatus FROM orders""")
def version_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current version after two changes of the schema; partitions that weren't written again have nulls for new columns."""
    return three_versions(spark, sf_dir).read().select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")


@query("""WITH v AS (SELECT 1 AS version, *, NULL AS p FROM orders UNION ALL SELECT 2, *, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END FROM orders) SELECT CAST(version AS INT) AS version, o_orderstatus, count(*) AS n, round(sum(CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END), 2) AS total, count(p) AS n_priorities FROM v GROUP BY 1, 2""")
def version_older(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versions before stay as they were."""
    t = three_versions(spark, sf_dir)
    both = t.read(1).withColumn("version", F.lit(1)).unionByName(t.read(2).withColumn("version", F.lit(2)), allowMissingColumns=True)
    return both.groupBy("version", "o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.count("o_orderpriority").alias("n_priorities"))


@query("""WITH l AS (SELECT unnest([{'version': 1, 'base': NULL, 'kind': 'written', 'live': false}, {'version': 2, 'base': 1, 'kind': 'written', 'live': true}, {'version': 3, 'base': 2, 'kind': 'written', 'live': true}, {'version': 1, 'base': NULL, 'kind': 'dropped', 'live': false}]) AS x),
  n AS (SELECT count(*) AS n FROM orders) SELECT x.version::INT AS version, x.base::INT AS base, x.kind AS kind, CASE WHEN x.live THEN n END AS n FROM l, n""")
def version_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log after a clean-up, which drops the oldest version once the next one has all its partitions, with the rows of what is left."""
    t = three_versions(spark, sf_dir)
    t.clean_up()
    left = [t.read(v).agg(F.count("*").alias("n")).select(F.lit(v).alias("version"), F.lit("written").alias("kind"), "n") for v in t.live()]
    return t.log().select("version", "base", "kind").join(left[0].unionByName(left[1]), ["version", "kind"], "left")


@query("SELECT o_orderstatus, count(*) AS n, CAST(1 AS INT) AS version FROM orders GROUP BY 1")
def version_interrupted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that ends after writing its data and before its entry changes nothing for readers."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    t = VersionedTable(spark, new_path(spark, "versions"), ["o_orderstatus"])
    t.write(o)
    t.stage(o.filter("o_orderstatus = 'O'").withColumn("more", F.lit(1)))  # the run is lost here
    return t.read().groupBy("o_orderstatus").agg(F.count("*").alias("n")).withColumn("version", F.lit(t.current()))


@query("""WITH p AS (SELECT count(DISTINCT o_orderstatus) AS all_, count(DISTINCT o_orderstatus) FILTER (o_orderstatus <> 'P') AS kept FROM orders) SELECT all_ = kept AS first_in_second, true AS second_in_third, all_ <> kept AS refused, CAST(CASE WHEN all_ = kept THEN 2 ELSE 3 END AS INT) AS n_live, (SELECT count(*) FROM orders) AS n_repaired FROM p""")
def version_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A version that lacks a partition stops the clean-up; repair brings the partition back."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    t = VersionedTable(spark, new_path(spark, "versions"), ["o_orderstatus"])
    t.write(o)
    for n in (1, 2):
        t.commit(t.stage(o.filter("o_orderstatus <> 'P'").withColumns({f"more_{i}": F.lit(i) for i in range(n)})))
    first, second, refused = t.subset(1, 2), t.subset(2, 3), False
    try:
        t.clean_up()
    except SubsetError:
        refused = True
    live = len(t.live())
    t.repair()
    return t.read().agg(F.count("*").alias("n_repaired")).select(F.lit(first).alias("first_in_second"), F.lit(second).alias("second_in_third"), F.lit(refused).alias("refused"), F.lit(live).alias("n_live"), "n_repaired")


def ask(target: Mapping[str, str], sql: str) -> Iterator[tuple]:
    """A target's database: a connection of its own, rows a thousand at a time."""
    import duckdb

    with duckdb.connect() as con:
        found = con.execute(sql)
        while some := found.fetchmany(1000):
            yield from some


def targets(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Orders by priority from five targets, of which one can't be reached, in three strides; and their counts."""
    o = read(spark, sf_dir, "orders")
    top = o.agg(F.max("o_orderkey")).first()[0]
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    places = [{"TARGET_KEY": str(i), "NAME": x, "FILE": f"{sf_dir}/orders.parquet" if i != 3 else "/nowhere/orders.parquet"} for i, x in enumerate(names, 1)]
    cuts = (f"o_orderkey < {top // 3}", f"o_orderkey >= {top // 3} AND o_orderkey < {2 * top // 3}", f"o_orderkey >= {2 * top // 3}")
    return extract_targets(spark, ask, places, {
        "orders": Template("SELECT o_orderkey, o_totalprice FROM '[FILE]' WHERE o_orderpriority = '[NAME]' AND [STRIDE]", "o_orderkey long, o_totalprice double", cuts),
        "counts": Template("SELECT o_orderstatus, count(*) FROM '[FILE]' WHERE o_orderpriority = '[NAME]' GROUP BY 1", "o_orderstatus string, n long"),
    })


@query("SELECT o_orderkey, o_totalprice, left(o_orderpriority, 1) AS target_key FROM orders WHERE o_orderpriority <> '3-MEDIUM'")
def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1, K2: the rows of all targets that answered."""
    return targets(spark, sf_dir)[0]["orders"]


@query("""WITH t AS (SELECT unnest(range(1, 6)) AS k) SELECT 'orders' AS sql_name, CAST(k AS VARCHAR) AS target_key, k = 3 AS is_error, CASE WHEN k = 3 THEN 0 ELSE (SELECT count(*) FROM orders WHERE CAST(left(o_orderpriority, 1) AS INT) = k) END AS row_count FROM t
  UNION ALL SELECT 'counts', CAST(k AS VARCHAR), k = 3, CASE WHEN k = 3 THEN 0 ELSE (SELECT count(DISTINCT o_orderstatus) FROM orders WHERE CAST(left(o_orderpriority, 1) AS INT) = k) END FROM t""")
def source_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the log by target and template."""
    return pair_log(targets(spark, sf_dir)[1]).select("sql_name", "target_key", "is_error", "row_count")


@query("SELECT sql_name, '3' AS target_key FROM (SELECT DISTINCT unnest(['orders', 'counts']) AS sql_name FROM orders)")
def source_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: the pairs to run again are those of the target that could not be reached."""
    log = pair_log(targets(spark, sf_dir)[1])
    return failed_targets(log, log.select("target_key").distinct()).select("sql_name", "target_key")


def changed_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders before and after: of the last months some were changed and one kind deleted; what is older stays."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", F.unix_date(F.to_date("o_orderdate")).cast("long").alias("day"))
    late = F.col("day") >= F.unix_date(F.lit("2001-01-01").cast("date"))
    new = o.filter(~(late & (F.col("o_orderstatus") == "F"))).withColumn("o_totalprice", F.when(late & (F.col("o_orderstatus") == "O"), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return o, new


@query("SELECT o_orderkey, round(o_totalprice + CASE WHEN o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderstatus = 'O' THEN 1 ELSE 0 END, 2) AS o_totalprice, o_orderstatus FROM orders WHERE NOT (o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderstatus = 'F')")
def keyed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: a delta merged into a stored table by ranges of its key gives the new version."""
    old, new = changed_orders(spark, sf_dir)
    t = KeyedTable.create(old, new_path(spark, "keyed"), Layout(("day", "o_orderkey"), 24, 9131, 11549))
    t.merge(*delta(new, t.read(), ["day", "o_orderkey"]))
    return t.read().select("o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"), "o_orderstatus")


@query("""WITH b AS (SELECT least(23, greatest(0, CAST(floor((date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) - 9131) * (24 / (11549 - 9131))) AS INT))) AS bucket, o_orderdate, o_orderstatus FROM orders)
  SELECT CAST(bucket AS INT) AS bucket, NOT bool_or(o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderstatus IN ('F', 'O')) AS same_files FROM b GROUP BY 1""")
def keyed_untouched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: only buckets with changed keys get new files."""
    old, new = changed_orders(spark, sf_dir)
    t = KeyedTable.create(old, new_path(spark, "keyed"), Layout(("day", "o_orderkey"), 24, 9131, 11549))
    files = lambda: t.stored().select(F.col("_bucket").alias("bucket"), F.col("_metadata.file_name").alias("f")).groupBy("bucket").agg(F.array_sort(F.collect_set("f")).alias("f"))
    before = spark.createDataFrame(files().collect(), "bucket int, f array<string>")  # the files of 24 buckets, as they are now
    t.merge(*delta(new, t.read(), ["day", "o_orderkey"]))
    after = files().withColumnRenamed("f", "g")
    return before.join(after, "bucket", "left").select("bucket", F.coalesce(F.col("f") == F.col("g"), F.lit(False)).alias("same_files"))


@query("SELECT o_orderkey, o_orderstatus, count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2")
def bucket_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4: orders and their lines, kept in equal buckets of the order, as many as their rows need, joined and summed up where they lie."""
    at = new_path(spark, "bucketed")
    name = at.rpartition("-")[2]
    orders, lines = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), read(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice")
    n = buckets_for(max(orders.count(), lines.count()))
    o = save_bucketed(orders, f"orders_{name}", n, ["o_orderkey"], path=f"{at}/orders")
    l_ = save_bucketed(lines, f"lines_{name}", n, ["l_orderkey"], path=f"{at}/lines")
    joined = o.join(l_, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderkey", "o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"))
