"""Table, extract, privacy and delta queries (I, J, K, L, P) over tables written and read again."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prismcube.queries.registry import query, read, rounded
from prismcube.sources import delta, extract, tables
from prismcube.sources.checkpoints import new_path


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer")


@query("SELECT c_custkey, c_acctbal + CASE WHEN c_nationkey = 3 THEN 1000 ELSE 0 END AS c_acctbal, CAST(c_nationkey AS INT) AS c_nationkey, 'a' AS zone FROM customer")
def table_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A static and a dynamic partition; one partition is overwritten, the others stay."""
    at, c = new_path(spark, "table"), customers(spark, sf_dir).select("c_custkey", "c_acctbal", "c_nationkey")
    tables.write_table(c, at, ["zone=a", "c_nationkey"])
    tables.write_table(c.filter("c_nationkey = 3").withColumn("c_acctbal", F.col("c_acctbal") + 1000), at, ["c_nationkey", "zone=a"][::-1])
    return spark.read.parquet(at).select("c_custkey", "c_acctbal", "c_nationkey", "zone")


@query("SELECT c_mktsegment, count(*) AS n, count(DISTINCT c_custkey) AS keys FROM customer GROUP BY 1")
def table_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4: buckets inside partitions, each key in one."""
    b = tables.bucketize(customers(spark, sf_dir), ["c_mktsegment"], 4, ["c_custkey"])
    each = b.groupBy("c_mktsegment", "bucket").agg(F.count("*").alias("n"), F.count_distinct("c_custkey").alias("keys"))
    return each.groupBy("c_mktsegment").agg(F.sum("n").alias("n"), F.sum("keys").alias("keys"))


@query("SELECT event_id, CASE WHEN event_type = 'click' THEN event_type END AS first_type FROM events")
def table_empty_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty arrays become null."""
    e = read(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") == "click", F.array("event_type")).otherwise(F.array().cast("array<string>")).alias("a"))
    out = tables.empty_to_null(e)
    return out.select("event_id", F.when(F.col("a").isNotNull(), F.get("a", F.lit(0))).alias("first_type"))


@query("SELECT c_custkey, CASE WHEN c_nationkey < 10 THEN c_name END AS c_name, c_nationkey, CASE WHEN c_nationkey >= 10 THEN c_mktsegment END AS c_mktsegment FROM customer")
def table_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new schema for new partitions, old ones kept with nulls."""
    c = customers(spark, sf_dir)
    old = c.select("c_custkey", "c_name", "c_nationkey")
    new = c.filter("c_nationkey >= 10").select("c_custkey", "c_nationkey", "c_mktsegment")
    out = tables.evolve_table(old.withColumnRenamed("c_name", "n"), new.withColumn("n", F.lit(None).cast("string")), ["c_nationkey"])
    return out.select("c_custkey", F.col("n").alias("c_name"), "c_nationkey", "c_mktsegment")


@query("SELECT c_custkey, c_nationkey, CASE WHEN c_nationkey % 3 = 0 THEN 'v3' WHEN c_nationkey % 3 = 1 THEN 'v2' ELSE 'v1' END AS v FROM customer")
def table_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions that the newest version lacks come from older ones."""
    c = customers(spark, sf_dir).select("c_custkey", "c_nationkey")
    v = [c.filter("c_nationkey % 3 = 0").withColumn("v", F.lit("v3")), c.filter("c_nationkey % 3 < 2").withColumn("v", F.lit("v2")), c.withColumn("v", F.lit("v1"))]
    return tables.repair_versions(v, ["c_nationkey"])


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer")
def table_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I8, L4: columns in the target's order and types."""
    c = customers(spark, sf_dir)
    target = c.select(F.col("c_custkey").cast("string").alias("c_custkey"), F.col("c_nationkey").cast("long").alias("c_nationkey")).limit(0)
    return tables.conform(tables.align_to(c.select("c_name", F.col("c_nationkey").alias("C_NATIONKEY"), "c_custkey"), target), target)


@query("SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1")
def table_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run adds the partitions that the first lacked, the third nothing."""
    at, c = new_path(spark, "sync"), customers(spark, sf_dir)
    for rows in (c.filter("c_nationkey < 12"), c, c):
        tables.sync_table(spark, rows, at, ["c_nationkey"])
    return spark.read.parquet(at).groupBy("c_nationkey").agg(F.count("*").alias("n"))


@query("SELECT c_custkey FROM customer WHERE c_custkey % 50 = 0 OR c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")
def table_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed ids go, null ones stay."""
    c = customers(spark, sf_dir).withColumn("id", F.when(F.col("c_custkey") % 50 > 0, F.col("c_mktsegment")))
    return tables.exclude_ids(c, "id", ["BUILDING", "MACHINERY"]).select("c_custkey")


@query("SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def table_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder for each value, as JSON."""
    at = new_path(spark, "values")
    tables.write_by_value(customers(spark, sf_dir).select("c_custkey", "c_mktsegment"), at, "c_mktsegment")
    return spark.read.json(at).groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query("SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice > 1000 AND o_orderpriority <> ';' GROUP BY 1")
def sql_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A script with variables, an inline file table and a semicolon in a literal."""
    return tables.run_script(spark, "CREATE OR REPLACE TEMP VIEW big_orders AS SELECT * FROM parquet.`${dir}/orders.parquet` WHERE o_totalprice > ${hiveconf:least}; -- a comment; with one\nSELECT o_orderpriority, count(*) AS n FROM big_orders WHERE o_orderpriority <> ';' GROUP BY 1;", {"dir": sf_dir, "least": "1000"})


@query("SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def sql_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placeholders for any source."""
    return tables.sql_with_sources(spark, "SELECT n_name, count(*) AS n FROM {noSqlTable:people} JOIN {places} ON c_nationkey = n_nationkey GROUP BY 1", {"people": customers(spark, sf_dir), "places": read(spark, sf_dir, "nation")})


@query("SELECT c_nationkey, CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer WHERE c_acctbal > 0 GROUP BY 1")
def sql_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: a query's result through the writer."""
    at = new_path(spark, "insert")
    tables.insert_select(spark, f"SELECT c_nationkey, sum(c_custkey) AS keys FROM parquet.`{sf_dir}/customer.parquet` WHERE c_acctbal > 0 GROUP BY 1", at)
    return spark.read.parquet(at)


@query("SELECT c_nationkey, count(*) AS n, CAST(1 AS BIGINT) AS files, true AS sorted FROM customer GROUP BY 1")
def sql_insert_dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: a query that deals and sorts its rows: each key in one file, in order."""
    at = new_path(spark, "insert")
    tables.insert_select(spark, f"SELECT c_nationkey, c_custkey FROM (SELECT * FROM parquet.`{sf_dir}/customer.parquet` ORDER BY c_name) DISTRIBUTE BY c_nationkey SORT BY c_nationkey, c_custkey", at)
    kept = spark.read.parquet(at).select("c_nationkey", "c_custkey", F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("place"))
    w = Window.partitionBy("f").orderBy("place")
    before = F.lag(F.struct("c_nationkey", "c_custkey")).over(w)
    kept = kept.withColumn("fine", F.coalesce(before < F.struct("c_nationkey", "c_custkey"), F.lit(True)))
    return kept.groupBy("c_nationkey").agg(F.count("*").alias("n"), F.count_distinct("f").alias("files"), F.bool_and("fine").alias("sorted"))


@query("SELECT CAST(least(4, c_custkey // greatest(1, (SELECT max(c_custkey) FROM customer) // 5)) AS INT) AS part, count(*) AS n FROM customer GROUP BY 1")
def extract_strides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1, K2: an extract of five strides, each row in one."""
    c = customers(spark, sf_dir)
    top = c.agg(F.max("c_custkey")).first()[0]
    cuts = extract.stride_predicates("c_custkey", 0, max(5, top), 5)
    targets = [{"TARGET_KEY": str(i), "WHERE": p} for i, p in enumerate(cuts)]
    done = extract.extract(lambda t, sql: c.filter(sql), targets, {"all": "[WHERE]"})["all"]
    return done.groupBy(F.col("target_key").cast("int").alias("part")).agg(F.count("*").alias("n"))


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def extract_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: at most two partitions for each source."""
    o = read(spark, sf_dir, "orders").withColumn("db", F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2))
    return extract.limit_per_source(o, "db", 2, 3).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extract log from events: sources are users, queries event types, batches days."""
    e = read(spark, sf_dir, "events")
    return e.select(F.lit("prod").alias("environment"), F.col("event_type").alias("sql_name"), F.col("user_id").alias("target_key"), F.get_json_object("props", "$.k").cast("long").alias("row_count"), F.round("value").cast("long").alias("exec_time_ms"), (F.col("event_id") % 5 == 0).alias("is_error"), F.col("event_id").alias("batch_number"), F.col("ts").alias("end_at"))


LOG = "log AS (SELECT 'prod' AS environment, event_type AS sql_name, user_id AS target_key, CAST(json_extract_string(props, '$.k') AS BIGINT) AS row_count, CAST(round(value) AS BIGINT) AS exec_time_ms, event_id % 5 = 0 AS is_error, event_id AS batch_number, ts AS end_at FROM events)"


@query(f"WITH {LOG}, l AS (SELECT target_key, sql_name, arg_max(is_error, batch_number) AS bad FROM log GROUP BY 1, 2) SELECT target_key, sql_name FROM l WHERE bad")
def extract_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: failed pairs to run again."""
    own = log(spark, sf_dir)
    return extract.failed_targets(own, own.select("target_key").distinct())


@query(f"WITH {LOG} SELECT environment, sql_name, CASE WHEN sql_name = 'view' THEN TIMESTAMP '2024-01-05' ELSE arg_max(end_at, batch_number) END AS next_start FROM log WHERE NOT is_error AND row_count > 0 GROUP BY 1, 2")
def extract_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: where each query goes on."""
    return extract.next_bounds(log(spark, sf_dir), override={"view": "2024-01-05"})


@query(f"""WITH {LOG} SELECT sql_name, count(*) AS n, count(*) FILTER (is_error) AS n_errors, CAST(sum(row_count) AS BIGINT) AS total_rows, round(sum(exec_time_ms / 1000), 4) AS total_seconds, round(max(exec_time_ms / 1000), 4) AS max_seconds,
  round(quantile_cont(exec_time_ms / 1000, 0.95), 4) AS p95_seconds, round(quantile_cont(CAST(row_count AS DOUBLE), 0.9), 4) AS p90_rows FROM log GROUP BY 1""")
def extract_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: summary of a log."""
    return rounded(extract.extract_summary(log(spark, sf_dir)).select("sql_name", "n", "n_errors", "total_rows", "total_seconds", "max_seconds", "p95_seconds", "p90_rows"))


@query(f"WITH {LOG}, d AS (SELECT sql_name, count(DISTINCT target_key) AS n_done FROM log WHERE NOT is_error GROUP BY 1), x AS (SELECT sql_name, count(DISTINCT target_key) AS n_expected FROM log GROUP BY 1) SELECT sql_name, n_expected, n_done, CASE WHEN n_done = n_expected THEN 'OK' ELSE 'QUARANTINED' END AS status FROM x JOIN d USING (sql_name)")
def extract_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: queries that miss a target."""
    own = log(spark, sf_dir)
    return extract.check_counts(own, own.groupBy("sql_name").agg(F.count_distinct("target_key").alias("n_expected")))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS o_orderstatus, CASE WHEN o_orderpriority NOT IN ('5-LOW', 'F') THEN o_orderpriority END AS o_orderpriority FROM orders")
def extract_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: tokens that stand for null."""
    return extract.replace_nulls(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), ("F", "5-LOW"))


OPTOUT = "o AS (SELECT s_nationkey AS c_nationkey, CASE WHEN s_suppkey % 3 = 0 THEN NULL WHEN s_suppkey % 3 = 1 THEN 'BUILDING' ELSE 'MACHINERY' END AS c_mktsegment FROM supplier)"


def optout(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey") % 3
    return read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("c_nationkey"), F.when(k == 1, "BUILDING").when(k == 2, "MACHINERY").alias("c_mktsegment"))


@query(f"WITH {OPTOUT} SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.c_nationkey = c.c_nationkey AND o.c_mktsegment = c.c_mktsegment)")
def privacy_optout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opted-out rows go; incomplete opt-out rows name nothing."""
    return extract.apply_optout(customers(spark, sf_dir), optout(spark, sf_dir)).select("c_custkey")


@query(f"""WITH {OPTOUT}, l AS (SELECT c_custkey, sha256(c_name) AS name_stricthash, CAST(floor(c_acctbal) AS BIGINT) AS acct_hash, c_nationkey, c_mktsegment FROM customer), b AS (SELECT * FROM l c WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.c_nationkey = c.c_nationkey AND o.c_mktsegment = c.c_mktsegment))
  SELECT 'blue' AS zone, c_custkey, name_stricthash, CAST(acct_hash AS VARCHAR) AS acct_hash FROM b UNION ALL SELECT 'green', c_custkey, name_stricthash, sha256(CAST(acct_hash AS VARCHAR)) FROM b UNION ALL SELECT 'landing', c_custkey, name_stricthash, CAST(acct_hash AS VARCHAR) FROM l""")
def privacy_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: landing, blue and green."""
    c = customers(spark, sf_dir).select("c_custkey", F.col("c_name").alias("name_stricthash"), F.floor("c_acctbal").cast("string").alias("acct_hash"), "c_nationkey", "c_mktsegment")
    zones = extract.to_zones(c, optout(spark, sf_dir))
    pick = lambda z: zones[z].select(F.lit(z).alias("zone"), "c_custkey", "name_stricthash", "acct_hash")
    return pick("landing").unionByName(pick("blue")).unionByName(pick("green"))


@query(f"""WITH {OPTOUT}, b AS (SELECT c_custkey FROM customer c WHERE c_acctbal > 0 AND NOT EXISTS (SELECT 1 FROM o WHERE o.c_nationkey = c.c_nationkey AND o.c_mktsegment = c.c_mktsegment)) SELECT (SELECT count(*) FROM customer WHERE c_acctbal > 0) AS extracted, (SELECT count(*) FROM customer WHERE c_acctbal > 0) AS landing, (SELECT count(*) FROM b) AS blue, (SELECT count(*) FROM b) AS green, true AS ok""")
def privacy_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opt-out applied again to stored data, zone counts checked."""
    at, landing = new_path(spark, "zones"), customers(spark, sf_dir)
    extract.rerun_optout({"customer": landing}, optout(spark, sf_dir), at, "c_acctbal > 0", ["c_name"])
    own = landing.filter("c_acctbal > 0")
    return extract.check_zones(own, own, spark.read.parquet(f"{at}/blue/customer"), spark.read.parquet(f"{at}/green/customer"))


def versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """New and old: deletes, inserts, updates, null to value, unchanged."""
    c, k = customers(spark, sf_dir).select("c_custkey", "c_acctbal", "c_mktsegment"), F.col("c_custkey")
    old = c.filter(k % 7 > 0).withColumn("c_mktsegment", F.when(k % 5 > 0, F.col("c_mktsegment")))
    new = c.filter(k % 11 > 0).withColumn("c_acctbal", F.when(k % 3 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    return new, old


@query("SELECT 'upsert' AS kind, c_custkey FROM customer WHERE c_custkey % 11 > 0 AND (c_custkey % 7 = 0 OR c_custkey % 3 = 0 OR (c_custkey % 5 = 0)) UNION ALL SELECT 'delete', c_custkey FROM customer WHERE c_custkey % 11 = 0 AND c_custkey % 7 > 0")
def delta_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: upserts and deletes between versions."""
    up, gone = delta.delta(*versions(spark, sf_dir), ["c_custkey"])
    return up.select(F.lit("upsert").alias("kind"), "c_custkey").unionByName(gone.select(F.lit("delete").alias("kind"), "c_custkey"))


@query("SELECT c_custkey, round(c_acctbal + CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END, 4) AS c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 11 > 0")
def delta_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: the old version and the delta give the new one."""
    new, old = versions(spark, sf_dir)
    return rounded(delta.apply_delta(old, *delta.delta(new, old, ["c_custkey"]), ["c_custkey"]))


@query("SELECT count(*) AS n, true AS same, false AS other FROM customer")
def delta_sync_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3: keys in another order hash alike, other keys don't."""
    c = customers(spark, sf_dir)
    a, b, d = (delta.sync_hash(x, ["c_custkey"]) for x in (c, c.repartition(5, "c_name"), c.filter("c_custkey > 3")))
    return a.select("n", F.col("key_hash").alias("a")).join(b.select(F.col("key_hash").alias("b"))).join(d.select(F.col("key_hash").alias("d"))).select("n", (F.col("a") == F.col("b")).alias("same"), (F.col("a") == F.col("d")).alias("other"))


@query("WITH k AS (SELECT CASE WHEN l_orderkey % 13 > 0 THEN l_orderkey END AS a, l_linenumber % 3 AS b FROM lineitem), g AS (SELECT a, b, count(*) AS n FROM k WHERE a IS NOT NULL GROUP BY 1, 2) SELECT (SELECT count(*) FROM k) AS n, (SELECT count(*) FROM k WHERE a IS NULL) AS n_null, (SELECT count(*) FROM g WHERE n > 1) AS n_duplicated, false AS ok")
def delta_key_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and duplicated keys."""
    k = read(spark, sf_dir, "lineitem").select(F.when(F.col("l_orderkey") % 13 > 0, F.col("l_orderkey")).alias("a"), (F.col("l_linenumber") % 3).alias("b"))
    return delta.assert_keys(k, ["a", "b"])


JDBC_URL, JDBC_DRIVER = "spark.prismcube.jdbc.url", "spark.prismcube.jdbc.driver"


def round_trip_database(master: str, settings: Mapping[str, str | None], name: str) -> dict[str, str]:
    """Options of the database that the round trip goes through: the one that the session names, else the embedded one.

    The embedded database lives in one JVM. The driver would make the table in its own and executors would not find it, so
    other than local masters must name a server that all of them reach.
    """
    if settings.get(JDBC_URL):
        return {"url": settings[JDBC_URL], "dbtable": f"customers_{name}", **({"driver": settings[JDBC_DRIVER]} if settings.get(JDBC_DRIVER) else {})}
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"{JDBC_URL} must name a database server that driver and executors reach: the embedded one lives in a single JVM")
    return {"url": f"jdbc:derby:memory:{name};create=true", "dbtable": "customers", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@query("SELECT c_custkey, c_acctbal, c_mktsegment, CAST(1 AS INT) AS times FROM customer")
def jdbc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written over JDBC by three connections and read back in five strides, each row once.

    The database is the one that the session's settings name; with a local master the embedded one that comes with Spark will do.
    """
    c = customers(spark, sf_dir).select("c_custkey", "c_acctbal", "c_mktsegment")
    name = new_path(spark, "jdbc").rpartition("-")[2]
    options = round_trip_database(spark.conf.get("spark.master", ""), {k: spark.conf.get(k, None) for k in (JDBC_URL, JDBC_DRIVER)}, name)
    delta.export_jdbc(c.toDF(*(x.upper() for x in c.columns)), options, 3, mode="overwrite")
    top = c.agg(F.max("c_custkey")).first()[0]
    back = tables.load_jdbc(spark, options, extract.stride_predicates("C_CUSTKEY", 0, max(5, top), 5))
    return back.groupBy(*(F.col(x.upper()).alias(x) for x in c.columns)).agg(F.count("*").cast("int").alias("times"))


@query("SELECT c_custkey, CAST(NULL AS VARCHAR) AS phone, c_name FROM customer")
def delta_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: missing columns as nulls."""
    c = customers(spark, sf_dir)
    target = c.select("c_custkey", F.lit("x").alias("phone"), "c_name").limit(0)
    return tables.align_to(c.select("c_name", "c_custkey", "c_acctbal"), target, pad=True)
