"""Text and semi-structured queries (O)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismcube.functions import text as t
from prismcube.queries.registry import query, read, rounded

ROMAN = "^M{0,3}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})$"


@query(f"""WITH w AS (SELECT p_partkey, list_filter(regexp_split_to_array(upper(p_name || ' VII ' || p_type || ' hr x'), '[^A-Z]+'), lambda w: length(w) > 1 AND NOT regexp_matches(w, '{ROMAN}')) AS w FROM part)
  SELECT p_partkey, array_to_string(list_transform(w, lambda w: CASE WHEN w = 'HR' THEN 'HUMAN RESOURCES' ELSE w END), ' ') AS title FROM w""")
def text_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: standardised titles."""
    p = read(spark, sf_dir, "part")
    return p.select("p_partkey", t.standardise_text(F.concat("p_name", F.lit(" VII "), "p_type", F.lit(" hr x")), {"hr": "human resources"}).alias("title"))


@query("""SELECT p_partkey, coalesce(CASE WHEN regexp_matches(p_type, '(?i)steel') AND NOT regexp_matches(p_type, '(?i)small') THEN 'metal' WHEN regexp_matches(p_type, '(?i)small|mini') THEN 'little' END,
  CASE WHEN regexp_matches(p_brand, '1') THEN 'first' END, 'other') AS kind FROM part""")
def text_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: ordered rules over two inputs."""
    p = read(spark, sf_dir, "part").withColumns({"a": F.col("p_type"), "b": F.col("p_brand")})
    one = t.classify_text(["a"], [("metal", "(?i)steel", "(?i)small"), ("little", "(?i)small|mini", None)])
    return p.select("p_partkey", F.coalesce(one, t.classify_text(["b"], [("first", "1", None)], "other")).alias("kind"))


@query("""SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 4) AS similarity FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id - a.vec_id % 10""")
def text_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: cosine with the first vector of each ten."""
    e = read(spark, sf_dir, "embeddings")
    b = e.select(F.col("vec_id").alias("first"), F.col("embedding").alias("other"))
    pairs = e.withColumn("first", F.col("vec_id") - F.col("vec_id") % 10).join(b, "first")
    return rounded(pairs.select("vec_id", t.cosine("embedding", "other").alias("similarity")))


@query("""WITH w AS (SELECT c_custkey, c_mktsegment AS word, c_nationkey FROM customer), v AS (SELECT c_mktsegment AS word, CAST(length(c_mktsegment) AS DOUBLE) AS x, CAST(ascii(c_mktsegment) AS DOUBLE) AS y FROM customer GROUP BY 1)
  SELECT c_nationkey, round(avg(x), 4) AS x, round(avg(y), 4) AS y FROM w JOIN v USING (word) GROUP BY 1""")
def text_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: the mean of each customer's token vectors, averaged by nation."""
    c = read(spark, sf_dir, "customer")
    words = c.select("c_custkey", F.array("c_mktsegment").alias("tokens"))
    v = c.select(F.col("c_mktsegment").alias("word")).distinct().withColumn("vector", F.array(F.length("word").cast("double"), F.ascii("word").cast("double")))
    out = t.embed_text(words, "tokens", v, "c_custkey").join(c.select("c_custkey", "c_nationkey"), "c_custkey")
    return rounded(out.groupBy("c_nationkey").agg(F.avg(F.col("embedding")[0]).alias("x"), F.avg(F.col("embedding")[1]).alias("y")))


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 > 0 THEN c_name END AS name, CASE WHEN c_custkey % 5 > 0 THEN c_nationkey END AS nation FROM customer")
def text_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested record from escaped XML; malformed rows give nulls."""
    c = read(spark, sf_dir, "customer")
    xml = F.concat(F.lit("<row><name>"), t.xml_escape("c_name"), F.lit("</name><nation>"), F.col("c_nationkey").cast("string"), F.when(F.col("c_custkey") % 5 > 0, "</nation></row>").otherwise("</nat"))
    out = t.extract_xml(c.withColumn("xml", xml), "xml", "name string, nation int")
    return out.select("c_custkey", "records.name", "records.nation")


@query("""WITH n AS (SELECT user_id, event_type, count(*) AS c FROM events WHERE event_type IN ('click', 'view', 'error') GROUP BY 1, 2) SELECT u.user_id, (SELECT event_type FROM n WHERE n.user_id = u.user_id ORDER BY c DESC, event_type LIMIT 1) AS top FROM (SELECT DISTINCT user_id FROM events) u""")
def text_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key of a map's largest allowed value."""
    n = read(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("c"))
    maps = n.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "c"))).alias("m"))
    return maps.select("user_id", t.argmax_key("m", ["click", "view", "error"]).alias("top"))


@query("SELECT doc_id, md5(text) AS digest, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&apos;') AS escaped, true AS same FROM documents")
def text_escapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests, escapes and back."""
    d = read(spark, sf_dir, "documents").select("doc_id", "text", t.md5_hex("text").alias("digest"), t.xml_escape("text").alias("escaped"))
    return d.select("doc_id", "digest", "escaped", (t.xml_unescape("escaped") == F.col("text")).alias("same"))
