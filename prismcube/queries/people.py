"""Hierarchy (E), feature and imputation (F), bias (H) and ranking (D) queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prismcube.operators import bias, features, hierarchy, ranking
from prismcube.queries.registry import query, read, rounded


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a forest of fan-out 8 in each of four groups."""
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("node"), "p_size")
    q, g = F.floor(F.col("node") / 4), F.col("node") % 4
    return p.select("node", F.when(q > 0, F.floor(q / 8) * 4 + g).alias("boss"), g.alias("grp"), "p_size")


EDGES = "edges AS (SELECT p_partkey AS node, CASE WHEN p_partkey // 4 > 0 THEN ((p_partkey // 4) // 8) * 4 + p_partkey % 4 END AS boss, p_partkey % 4 AS grp, p_size FROM part)"
TREE = f"""{EDGES}, tree AS (SELECT node, grp, p_size, 1 AS layer, CAST([] AS BIGINT[]) AS path FROM edges WHERE boss IS NULL
  UNION ALL SELECT e.node, e.grp, e.p_size, t.layer + 1, list_append(t.path, t.node) FROM edges e JOIN tree t ON e.boss = t.node AND e.grp = t.grp)"""
PAIRS = f"""{TREE}, pairs AS (SELECT node, grp, layer, p_size, unnest(path) AS ancestor, unnest(range(1, len(path) + 1)) AS ancestor_layer FROM tree)"""


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.build_hierarchy(parts(spark, sf_dir), "node", "boss", ["grp"])


@query(f"WITH RECURSIVE {TREE} SELECT node, grp, layer, path[1] AS layer_1_parent, path[2] AS layer_2_parent, path[3] AS layer_3_parent, len(path) AS n_up FROM tree")
def hierarchy_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels and paths."""
    out = hierarchy.layer_parents(tree(spark, sf_dir), 3)
    return out.select("node", "grp", "layer", "layer_1_parent", "layer_2_parent", "layer_3_parent", F.size("path").cast("long").alias("n_up"))


@query(f"WITH RECURSIVE {PAIRS} SELECT grp, node, ancestor, CAST(ancestor_layer AS INT) AS ancestor_layer, CAST(layer - ancestor_layer AS INT) AS levels_up FROM pairs")
def hierarchy_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node and ancestor pairs."""
    return hierarchy.closure(tree(spark, sf_dir), "node", ["grp"])


@query(f"WITH RECURSIVE {PAIRS} SELECT grp, ancestor, count(*) FILTER (layer - ancestor_layer = 1) AS direct, count(*) AS total, count(*) FILTER (layer - ancestor_layer > 1) AS indirect FROM pairs GROUP BY 1, 2")
def hierarchy_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of descendants."""
    return hierarchy.child_counts(hierarchy_closure(spark, sf_dir), ["grp"])


@query(f"WITH RECURSIVE {PAIRS} SELECT grp, ancestor, count(*) FILTER (layer - ancestor_layer = 1) AS span, CAST(max(layer - ancestor_layer) AS INT) AS depth FROM pairs GROUP BY 1, 2")
def hierarchy_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Span of control."""
    return hierarchy.span_of_control(hierarchy_closure(spark, sf_dir), ["grp"])


@query("""WITH a AS (SELECT s_suppkey AS k, s_nationkey AS x, CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS y FROM supplier WHERE s_suppkey % 2 = 0),
  b AS (SELECT s_suppkey AS k, s_nationkey + 100 AS x, s_name || '*' AS y FROM supplier WHERE s_suppkey % 5 > 0) SELECT coalesce(a.k, b.k) AS k, coalesce(a.x, b.x) AS x, coalesce(a.y, b.y) AS y FROM a FULL JOIN b ON a.k = b.k""")
def hierarchy_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two hierarchies with precedence by column."""
    s = read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    a = s.filter(k % 2 == 0).select(k.alias("k"), F.col("s_nationkey").alias("x"), F.when(k % 3 > 0, F.col("s_name")).alias("y"))
    b = s.filter(k % 5 > 0).select(k.alias("k"), (F.col("s_nationkey") + 100).alias("x"), F.concat("s_name", F.lit("*")).alias("y"))
    return hierarchy.merge_hierarchies(a, b, ["k"], ["x", "y"])


@query(f"""WITH RECURSIVE {PAIRS} SELECT grp, ancestor, 'D' AS access, count(*) AS n FROM pairs WHERE layer - ancestor_layer = 1 GROUP BY 1, 2 UNION ALL SELECT grp, ancestor, 'DI', count(*) FROM pairs GROUP BY 1, 2""")
def hierarchy_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direct and further access."""
    return hierarchy.access_rows(hierarchy_closure(spark, sf_dir), ["grp"])


@query(f"""WITH RECURSIVE {PAIRS}, f AS (SELECT l_partkey AS node, l_partkey % 4 AS grp, sum(l_quantity) AS q, count(*) AS c FROM lineitem GROUP BY 1, 2)
  SELECT p.grp, p.ancestor, round(sum(f.q), 2) AS quantity, CAST(sum(f.c) AS BIGINT) AS items FROM pairs p JOIN f USING (node, grp) GROUP BY 1, 2""")
def hierarchy_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of all descendants by ancestor."""
    k = F.col("l_partkey")
    facts = read(spark, sf_dir, "lineitem").select(k.alias("node"), (k % 4).alias("grp"), "l_quantity")
    out = hierarchy.rollup_to_ancestors(facts, hierarchy_closure(spark, sf_dir), "node", {"quantity": "l_quantity", "items": "1"}, ["grp"])
    return out.withColumn("quantity", F.round("quantity", 2))


@query("SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def hierarchy_salt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups dealt in parts, counted part by part, then together."""
    parts_ = hierarchy.salted(read(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber"), ["l_returnflag"], 1000)
    n = parts_.groupBy("l_returnflag", "salt").agg(F.count("*").alias("n"))
    return n.groupBy("l_returnflag").agg(F.sum("n").alias("n"))


LINES = "lines AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity, l_extendedprice, l_returnflag FROM lineitem)"


@query(f"""WITH {LINES}, g AS (SELECT l_suppkey, max(l_quantity) - min(l_quantity) AS spread FROM lines GROUP BY 1),
  r AS (SELECT l_suppkey, sum(l_quantity) AS top3 FROM (SELECT *, rank() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC) AS k FROM lines) WHERE k <= 3 GROUP BY 1)
  SELECT l_orderkey, l_linenumber, l_quantity * 2 + l_linenumber AS line_weight, spread, rank() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC) AS price_rank, top3 FROM lines JOIN g USING (l_suppkey) LEFT JOIN r USING (l_suppkey)""")
def feature_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column, group and window features in order."""
    chain = [
        features.ColumnFeature("line_weight", "l_quantity * 2 + l_linenumber"),
        features.GroupFeature("spread", ("l_suppkey",), {"hi": "max(l_quantity)", "lo": "min(l_quantity)"}, "hi - lo"),
        features.WindowFeature("price_rank", ("l_suppkey",), ("l_extendedprice DESC",)),
        features.WindowFeature("top3", ("l_suppkey",), ("l_extendedprice DESC",), rank_test="<= 3", agg="sum(l_quantity)"),
    ]
    return features.run_workflow(read(spark, sf_dir, "lineitem"), [("features", lambda d: features.apply_features(d, chain, ["l_orderkey", "l_linenumber", "line_weight", "spread", "price_rank", "top3"]))]).withColumn("price_rank", F.col("price_rank").cast("long"))


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority IS NULL THEN NULL WHEN regexp_matches(o_orderpriority, '(?i)urgent|high') THEN 'fast' WHEN regexp_matches(o_orderpriority, '(?i)medium') THEN 'normal' ELSE 'slow' END AS o_orderpriority_category FROM orders""")
def feature_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """categories by pattern."""
    out = features.categorise(read(spark, sf_dir, "orders"), "o_orderpriority", {"fast": "urgent|high", "normal": "medium"}, "slow")
    return out.select("o_orderkey", "o_orderpriority_category")


GAPS = "gaps AS (SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN (l_orderkey + l_linenumber) % 7 > 0 THEN l_quantity END AS q, CASE WHEN l_partkey % 5 > 0 THEN l_partkey END AS p, CASE WHEN l_orderkey % 3 > 0 THEN l_returnflag END AS f FROM lineitem)"


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, n, p = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.when((o + n) % 7 > 0, F.col("l_quantity")).alias("q"), F.when(p % 5 > 0, p).alias("p"), F.when(o % 3 > 0, F.col("l_returnflag")).alias("f"))


@query(f"WITH {GAPS}, g AS (SELECT l_suppkey, avg(q) AS a, max(p) AS b FROM gaps GROUP BY 1) SELECT l_orderkey, l_linenumber, l_suppkey, q, p, f, round(coalesce(q, a), 4) AS q_imputed, coalesce(p, b) AS p_imputed FROM gaps JOIN g USING (l_suppkey)")
def impute_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several columns filled in one aggregation."""
    return rounded(features.impute(gaps(spark, sf_dir), ["l_suppkey"], {"q": "avg(q)", "p": "max(p)"}, inplace=False))


@query(f"""WITH {GAPS}, g AS (SELECT l_suppkey, quantile_cont(q, 0.5) AS a, CAST(round(quantile_cont(p, 0.5)) AS BIGINT) AS b, avg((q IS NULL)::INT) AS ma, avg((p IS NULL)::INT) AS mb, avg((f IS NULL)::INT) AS mf FROM gaps GROUP BY 1)
  SELECT l_orderkey, l_linenumber, l_suppkey, coalesce(q, CASE WHEN ma < 0.7 THEN a END) AS q, coalesce(p, CASE WHEN mb < 0.7 THEN b END) AS p, coalesce(f, CASE WHEN mf < 0.7 THEN 'UNKNOWN' END) AS f FROM gaps JOIN g USING (l_suppkey)""")
def impute_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """filled by type where little is missing."""
    return features.impute_generic(gaps(spark, sf_dir), ["l_suppkey"], ["q", "p", "f"], exact=True)


BIAS = """b AS (SELECT source AS g, lang AS c, CAST(quality AS DOUBLE) AS y, CAST(toxic AS DOUBLE) AS h FROM labels JOIN documents USING (doc_id)),
  s AS (SELECT g, c, count(*) AS n, sum(y) AS y, sum(h) AS h, sum(CASE WHEN y = 1 THEN h END) AS p, count(CASE WHEN y = 1 THEN 1 END) AS np, sum(CASE WHEN y <> 1 THEN h END) AS m, count(CASE WHEN y <> 1 THEN 1 END) AS nm FROM b GROUP BY 1, 2),
  t AS (SELECT g, sum(n) AS n, sum(y) AS y, sum(h) AS h, sum(p) AS p, sum(np) AS np, sum(m) AS m, sum(nm) AS nm FROM s GROUP BY 1)"""


@query(f"""WITH {BIAS} SELECT 'source' AS group_name, s.g AS group_value, 'lang' AS dim_name, c AS dim_value, s.n, round(s.y / s.n, 4) AS target_mean, round(s.y / s.n - (t.y - s.y) / nullif(t.n - s.n, 0), 4) AS target_bias,
  round(s.h / s.n, 4) AS prediction_mean, round(s.h / s.n - (t.h - s.h) / nullif(t.n - s.n, 0), 4) AS prediction_bias, round((s.y - s.h) / s.n, 4) AS residual_mean, round((s.y - s.h) / s.n - (t.y - t.h - s.y + s.h) / nullif(t.n - s.n, 0), 4) AS residual_bias,
  round(s.p / nullif(s.np, 0) - (t.p - coalesce(s.p, 0)) / nullif(t.np - s.np, 0), 4) AS equal_opportunity, round(s.m / nullif(s.nm, 0) - (t.m - coalesce(s.m, 0)) / nullif(t.nm - s.nm, 0), 4) AS mis_opportunity,
  coalesce(abs(s.h / s.n - (t.h - s.h) / nullif(t.n - s.n, 0)) > 0.1, false) AS flagged FROM s JOIN t USING (g)""")
def bias_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1, H2: bias and opportunity of each class within its group."""
    rows = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents").select("doc_id", "lang", "source"), "doc_id")
    return rounded(bias.flag_thresholds(bias.bias_metrics(rows, ["lang"], ["source"], "quality", "toxic")))


@query("""WITH b AS (SELECT lang, source, CAST(quality AS DOUBLE) AS y FROM labels JOIN documents USING (doc_id)), s AS (SELECT 'lang' AS d, lang AS v, count(*) AS n, sum(y) AS y FROM b GROUP BY lang UNION ALL SELECT 'source', source, count(*), sum(y) FROM b GROUP BY source),
  t AS (SELECT count(*) AS n, sum(y) AS y FROM b) SELECT 'all' AS group_name, d AS dim_name, v AS dim_value, s.n, round(s.y / s.n - (t.y - s.y) / nullif(t.n - s.n, 0), 4) AS target_bias, '2024Q1' AS period, 'v1' AS version FROM s, t""")
def bias_default_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3, H4: one group of all rows, several classes, stamped."""
    rows = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents").select("doc_id", "lang", "source"), "doc_id")
    out = bias.stamp_period(bias.bias_metrics(rows, ["lang", "source"], (), "quality", "toxic"), "2024-02-10", "quarterly")
    return rounded(out.select("group_name", "dim_name", "dim_value", "n", "target_bias", "period", "version"))


@query("""WITH c AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS st, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS pr, o_orderkey FROM orders)
  SELECT o_orderkey, concat_ws('_', CASE WHEN pr IS NOT NULL THEN 'pr' END, CASE WHEN st IS NOT NULL THEN 'st' END) AS dim_key, concat_ws('_', CASE WHEN pr IS NOT NULL THEN 'pr' END, CASE WHEN st IS NOT NULL THEN 'st' END, coalesce(pr, '')) AS hash_key FROM c""")
def rank_dimension_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of set dimensions, without and with values."""
    k = F.col("o_orderkey")
    c = read(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 2 == 0, F.col("o_orderstatus")).alias("st"), F.when(k % 3 == 0, F.col("o_orderpriority")).alias("pr"))
    return c.select("o_orderkey", ranking.dimension_key(["st", "pr"]).alias("dim_key"), ranking.dimension_key(["st", "pr"], ["pr"]).alias("hash_key"))


@query("""WITH n AS (SELECT event_type, row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS code FROM events GROUP BY 1) SELECT event_id, CAST(code AS INT) AS event_type_code, (event_type = 'click')::INT AS event_type_click, (event_type = 'view')::INT AS event_type_view FROM events JOIN n USING (event_type)""")
def rank_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label codes and 0/1 columns."""
    out = ranking.one_hot(ranking.label_encode(read(spark, sf_dir, "events"), "event_type"), "event_type", ["click", "view"])
    return out.select("event_id", "event_type_code", "event_type_click", "event_type_view")


def arms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(F.hour("ts").alias("arm"), F.col("ts").alias("at"), (F.col("event_type") == "click").alias("clicked"))


@query("""WITH e AS (SELECT hour(ts) AS arm, ts, event_type = 'click' AS c FROM events), w AS (SELECT arm, count(*) FILTER (c) AS c, count(*) FILTER (NOT c) AS m FROM e WHERE ts > TIMESTAMP '2024-01-08' AND ts <= TIMESTAMP '2024-01-15' GROUP BY 1),
  p AS (SELECT arm, count(*) FILTER (c) AS c, count(*) FILTER (NOT c) AS m FROM e WHERE ts > TIMESTAMP '2024-01-01' AND ts <= TIMESTAMP '2024-01-08' GROUP BY 1)
  SELECT CAST(coalesce(w.arm, p.arm) AS INT) AS arm, round(coalesce(w.c, 0) + 0.9 * coalesce(p.c, 0), 4) AS clicks, round(coalesce(w.m, 0) + 0.9 * coalesce(p.m, 0), 4) AS misses FROM w FULL JOIN p ON w.arm = p.arm""")
def rank_arm_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two weeks of arm statistics, the first decayed."""
    e = arms(spark, sf_dir)
    none = e.limit(0).select("arm", F.lit(0.0).alias("clicks"), F.lit(0.0).alias("misses"))
    first = ranking.update_arm_stats(e, none, 0.9, "2024-01-08")
    return rounded(ranking.update_arm_stats(e, first, 0.9, "2024-01-15"))


@query()
def rank_thompson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beta draws by arm."""
    e = arms(spark, sf_dir).groupBy("arm").agg(F.count_if("clicked").alias("clicks"), F.count_if(~F.col("clicked")).alias("misses"))
    return ranking.thompson_rank(e.withColumn("site", F.col("arm") % 3), ["site"], 11)


@query("""WITH b AS (SELECT s_suppkey % 10 AS g, s_suppkey AS k, s_nationkey % 7 AS m, s_acctbal AS s, (s_suppkey * 37) % 101 AS p FROM supplier), a AS (SELECT *, row_number() OVER (PARTITION BY g, m ORDER BY s DESC, k) AS own FROM b),
  h AS (SELECT *, CASE WHEN own = 1 THEN row_number() OVER (PARTITION BY g, own ORDER BY s DESC, k) END AS head FROM a), t AS (SELECT *, CASE WHEN head <= 4 THEN 0 ELSE 2 END AS part FROM h),
  q AS (SELECT *, CASE WHEN part = 2 AND row_number() OVER (PARTITION BY g, part ORDER BY p DESC, k) = 1 THEN 1 ELSE part END AS place FROM t) SELECT g, k, CAST(row_number() OVER (PARTITION BY g ORDER BY place, s DESC, k) AS INT) AS position FROM q""")
def rank_rerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of distinct metrics, the pick, the rest."""
    k = F.col("s_suppkey")
    b = read(spark, sf_dir, "supplier").select((k % 10).alias("g"), k.alias("k"), (F.col("s_nationkey") % 7).alias("m"), F.col("s_acctbal").alias("s"), ((k * 37) % 101).alias("p"))
    return ranking.rerank(b, ["g"], "s", "m", "k", "p").select("g", "k", "position")


@query("""WITH b AS (SELECT s_suppkey % 10 AS g, s_nationkey % 7 AS m FROM supplier), n AS (SELECT g, count(*) AS n, least(4, count(DISTINCT m)) AS tops FROM b GROUP BY 1) SELECT g, CAST(n > tops AS INT) AS picks, true AS largest, true AS among_top, true AS rest_by_score FROM n""")
def rank_rerank_drawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest row of the best arm, in a drawn place among the top rows; the others keep their order."""
    k = F.col("s_suppkey")
    b = read(spark, sf_dir, "supplier").select((k % 10).alias("g"), k.alias("k"), (F.col("s_nationkey") % 7).alias("m"), F.col("s_acctbal").alias("s"), ((F.col("s_nationkey") * 37) % 11).alias("arm"), ((k * 53) % 997).alias("size"))
    out = ranking.rerank(b, ["g"], "s", "m", "k", "arm", size="size", seed=5)
    plain = ranking.rerank(b, ["g"], "s", "m", "k", "arm", size="size").select("k", F.col("position").alias("p"))
    w = Window.partitionBy("g")
    both = out.join(plain, "k").withColumn("tops", F.least(F.lit(4), F.size(F.collect_set("m").over(w))))
    # without the pick, rows stand as they do where the pick comes after the top
    others = Window.partitionBy("g", "is_bandit")
    both = both.withColumn("same", F.row_number().over(others.orderBy("position")) == F.row_number().over(others.orderBy("p")))
    later = (F.col("p") > F.col("tops")).cast("int")
    best = F.max(F.when(later == 1, F.struct("arm", "size"))).over(w)
    both = both.withColumn("best", F.struct("arm", "size") == best)
    return both.groupBy("g").agg(F.count_if("is_bandit").cast("int").alias("picks"), F.coalesce(F.bool_and(F.when(F.col("is_bandit"), F.col("best"))), F.lit(True)).alias("largest"), F.coalesce(F.bool_and(F.when(F.col("is_bandit"), F.col("position") <= F.col("tops") + 1)), F.lit(True)).alias("among_top"), F.bool_and("same").alias("rest_by_score"))


@query("SELECT DISTINCT event_type AS arm, true AS mean_fits, true AS deviation_fits FROM events")
def rank_thompson_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An arm's draws at many places have the mean and deviation of its beta distribution, within five standard errors."""
    e = read(spark, sf_dir, "events")
    arms = e.groupBy(F.col("event_type").alias("arm")).agg(F.count_if(F.col("value") > 60).alias("clicks"), F.count_if(F.col("value") <= 60).alias("misses"))
    kinds = sorted(r["arm"] for r in arms.select("arm").collect())
    places = e.select(F.col("event_id").alias("site"), F.explode(F.lit(kinds)).alias("arm"))  # an arm is drawn once for each place
    draws = ranking.thompson_rank(places.join(arms, "arm"), ["site"], 11)
    n = F.col("clicks") + F.col("misses")
    scale = F.when(n > 500, 500 / n).otherwise(1.0)
    a, b = F.col("clicks") * scale + 1, F.col("misses") * scale + 1
    out = draws.groupBy("arm").agg(F.avg("draw").alias("mean"), F.stddev_pop("draw").alias("dev"), F.count("*").alias("draws"), F.first(a / (a + b)).alias("m"), F.first(F.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))).alias("d"))
    return out.select("arm", (F.abs(F.col("mean") - F.col("m")) <= 5 * F.col("d") / F.sqrt("draws")).alias("mean_fits"), (F.abs(F.col("dev") / F.col("d") - 1) <= 5 / F.sqrt(2 * F.col("draws"))).alias("deviation_fits"))


@query("SELECT unnest(['accuracy', 'auc', 'f1']) AS measure, true AS fits FROM (SELECT count(*) FROM events)")
def rank_trained_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees find a signal that is there: whether an event's value is above 60 by day or above 30 by night."""
    e = read(spark, sf_dir, "events").select("event_id", "ts", "value", F.when(F.hour("ts").between(6, 17), "day").otherwise("night").alias("part"))
    e = e.withColumn("label", (F.col("value") > F.when(F.col("part") == "day", 60).otherwise(30)).cast("int"))
    split = ranking.time_split(e, "ts", "2024-02-01", "event_id")
    _, scores = ranking.train_ranker(split.filter("fold = 'train'"), split.filter("fold = 'test'"), ["value"], ["part"], "label", rounds=5)
    return spark.createDataFrame([(k, v >= 0.95) for k, v in scores.items()], "measure string, fits boolean")


@query("""WITH l AS (SELECT user_id, max(ts) AS t FROM events GROUP BY 1) SELECT e.user_id, event_type, count(*) AS n FROM events e JOIN l ON e.user_id = l.user_id AND ts >= t - INTERVAL 14 DAY GROUP BY 1, 2""")
def rank_recent_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts near each user's latest event."""
    return ranking.recent_counts(read(spark, sf_dir, "events"), "user_id", "ts", "event_type", 14)


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'month' WHEN o_orderkey % 3 = 0 THEN 'quarter' ELSE 'year' END AS grain,
  round(CASE WHEN o_orderkey % 2 = 0 THEN 1.0 WHEN o_orderkey % 3 = 0 THEN [1.0 / 3, 1.0, 2.0 / 3][month(o_orderdate) % 3 + 1] ELSE 1.0 / month(o_orderdate) END, 4) AS grain_weight FROM orders""")
def rank_time_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grain and weight of each row."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.when(k % 3 == 0, F.quarter(d).cast("string")).alias("q"), F.when(k % 2 == 0, F.date_format(d, "yyyyMM")).alias("m"))
    return rounded(ranking.time_grain(o, "q", "m", "o_orderdate").select("o_orderkey", "grain", "grain_weight"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN s_acctbal * 2 ELSE s_acctbal END AS score FROM supplier")
def rank_coalesced_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model's score where there is one."""
    s = read(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_acctbal").alias("score"))
    return ranking.coalesce_score(s, s.filter(F.col("s_suppkey") % 4 == 0).withColumn("score", F.col("score") * 2), "s_suppkey", "score")


@query("""WITH e AS (SELECT ts > TIMESTAMP '2024-01-17' AS test FROM events WHERE ts > TIMESTAMP '2023-11-03' AND ts <= TIMESTAMP '2024-02-01') SELECT test, count(*) AS n, true AS fair FROM e GROUP BY 1""")
def rank_time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows by date; of the others a fifth, within four deviations, is for validation."""
    folds = ranking.time_split(read(spark, sf_dir, "events"), "ts", "2024-02-01", "event_id")
    n = folds.groupBy((F.col("fold") == "test").alias("test")).agg(F.count("*").alias("n"), F.count_if(F.col("fold") == "validation").alias("v"))
    share = F.abs(F.col("v") - 0.2 * F.col("n")) <= 4 * F.sqrt(0.16 * F.col("n"))
    return n.select("test", "n", F.when(F.col("test"), F.col("v") == 0).otherwise(share).alias("fair"))


@query("""SELECT event_id, CASE WHEN ts > TIMESTAMP '2024-01-17' THEN 'test' WHEN ('0x' || left(md5(CAST(event_id AS VARCHAR)), 8))::BIGINT % 1000 < 200 THEN 'validation' ELSE 'train' END AS fold FROM events WHERE ts > TIMESTAMP '2023-11-03' AND ts <= TIMESTAMP '2024-02-01'""")
def rank_time_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fold of each row."""
    return ranking.time_split(read(spark, sf_dir, "events"), "ts", "2024-02-01", "event_id").select("event_id", "fold")


@query()
def rank_trained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of boosted trees that tell purchases from other events."""
    e = read(spark, sf_dir, "events").select("event_id", "ts", "value", "user_id", F.hour("ts").alias("hour"), F.get_json_object("props", "$.k").cast("int").alias("k"), (F.col("event_type") == "purchase").cast("int").alias("label"), F.dayofweek("ts").cast("string").alias("day"))
    split = ranking.time_split(e, "ts", "2024-02-01", "event_id")
    _, scores = ranking.train_ranker(split.filter("fold = 'train'"), split.filter("fold = 'test'"), ["value", "hour", "k"], ["day"], "label", rounds=5)
    return spark.createDataFrame([(k, float(v)) for k, v in scores.items()], "measure string, value double")
