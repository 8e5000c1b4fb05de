"""Ranked lexical search by a scan of the documents (operator 12).

The terms of all items, each between two guards, go into one Aho-Corasick
automaton that every task builds from a broadcast list. A document is read once:
what is no letter of a term becomes a guard, and the automaton's outputs are the
occurrences of whole terms. There is no index of the documents; a scan leaves
one row of counts for each document, from which the number of documents of each
term, the lengths and then the scores follow. Outputs map to items through the
items' lists of terms.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prismcube.llm.common import scratch, text_of, written

#: Fixed: bytes of a term (every byte of a letter beyond ASCII is one), and A-Z lower-cased.
LETTERS = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
GUARDED = bytes((b + 32 if 65 <= b <= 90 else b) if b in LETTERS else 32 for b in range(256))
#: Fixed: the term pattern for JVM functions.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
A_TO_Z, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of terms in one automaton: what is broadcast and built is bounded by this, further items take a further scan.
AUTOMATON_BYTES = 16 << 20
#: Groups that the best of one item's tasks are first reduced in, so that no one task sees those of all tasks.
SALTS = 64


@dataclass(frozen=True)
class Items:
    """The items of one automaton: ids, and for each the numbers of its terms."""

    ids: list
    terms: list[str]
    of: list[list[int]]


def item_groups(items: DataFrame, item_id: str = "item_id", text: str = "text", at_once: int = AUTOMATON_BYTES) -> Iterator[Items]:
    """Items in groups whose terms have at most some bytes (or one item), each term of an item once. Only one group is held."""
    words = F.array_distinct(F.regexp_extract_all(F.translate(text_of(text), A_TO_Z, LOWER), F.lit(TERM), F.lit(0)))
    ids, seen, of, held = [], {}, [], 0
    rows = items.select(F.col(item_id).alias("item_id"), F.explode(words).alias("term")).distinct().groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms"))
    for row in rows.orderBy("item_id").toLocalIterator():
        size = sum(len(t.encode()) for t in row["terms"])
        if ids and held + size > at_once:
            yield Items(ids, [*seen], of)
            ids, seen, of, held = [], {}, [], 0
        ids.append(row["item_id"])
        of.append([seen.setdefault(t, len(seen)) for t in row["terms"]])
        held += size
    if ids:
        yield Items(ids, [*seen], of)


@lru_cache(maxsize=1)
def automaton(terms: tuple[str, ...]) -> ahocorasick.Automaton:
    """Terms between guards; bytes are letters of one byte, so that matches never depend on an encoding."""
    made = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for at, term in enumerate(terms):
        made.add_word((b" " + term.encode() + b" ").decode("latin-1"), at)
    made.make_automaton()
    return made


def counted(docs: DataFrame, terms: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (terms of the whole text, with repeats), found and tf (which of the given terms it holds and how often)."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(terms))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = automaton(sent.value) if sent.value else None
        for rows in batches:
            sizes, found, times = [], [], []
            for x in rows["_text"]:
                plain = b" " + x.encode("utf-8", "surrogatepass").translate(GUARDED) + b" "
                blank = np.frombuffer(plain, np.uint8) == 32
                sizes.append(int(np.count_nonzero(blank[:-1] & ~blank[1:])))
                tf = Counter(at for _, at in known.iter(plain.decode("latin-1"))) if known else {}
                found.append([*tf])
                times.append([*tf.values()])
            yield pd.DataFrame({"doc_id": rows["doc_id"], "n": sizes, "found": found, "tf": times})

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("_text")).mapInPandas(each, "doc_id long, n long, found array<int>, tf array<long>")


def best_of(counts: DataFrame, items: Items, weights: list[int], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """item_id, doc_id, score: the k best documents of each item among the rows of a task; scores in 64-bit integers."""
    member = sorted((t, i) for i, own in enumerate(items.of) for t in own)
    sent = counts.sparkSession.sparkContext.broadcast((np.array([t for t, _ in member], np.int64), np.array([i for _, i in member], np.int64), np.array(weights, np.int64)))
    n_items = len(items.ids)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        term, item, weight = sent.value
        low = np.searchsorted(term, np.arange(len(weight) + 1))
        best: list[list[tuple]] = [[] for _ in range(n_items)]  # heaps of (score, -doc_id), the worst first; no id is the last one
        least = np.ones(n_items, np.int64)  # a lower score can't be among the best any more
        for rows in batches:
            for doc, n, found, tf in zip(rows["doc_id"], rows["n"], rows["found"], rows["tf"], strict=True):
                if not len(found):
                    continue
                m = 10 + 90 * n * n_docs // n_terms
                gain = weight[found] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
                held = low[found + 1] - low[found]
                places = np.repeat(low[found] - np.r_[0, np.cumsum(held)[:-1]], held) + np.arange(held.sum())
                score = np.zeros(n_items, np.int64)
                np.add.at(score, item[places], np.repeat(gain, held))
                key = -math.inf if doc is None or doc != doc else -int(doc)
                for i in np.flatnonzero(score >= least):
                    own = best[i]
                    mine = (int(score[i]), key)
                    if len(own) < k:
                        heapq.heappush(own, mine)
                    elif mine > own[0]:
                        heapq.heapreplace(own, mine)
                    if len(own) == k:
                        least[i] = own[0][0]
        out = [(i, None if key == -math.inf else -key, s) for i, own in enumerate(best) for s, key in own]
        yield pd.DataFrame({"item": pd.Series([x[0] for x in out], dtype="int32"), "doc_id": pd.Series([x[1] for x in out], dtype="Int64"), "score": pd.Series([x[2] for x in out], dtype="int64")})

    return counts.select("doc_id", "n", "found", "tf").mapInPandas(each, "item int, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", at_once: int = AUTOMATON_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item with a score above 0, equal scores by doc_id.

    Null and empty texts hold no terms; such documents count neither in N nor in a result, and such items have no rows.
    Rows of one item_id (a null one too) are one item with the terms of all of them. Each row of the documents is a document
    of its own, also where its id repeats or is null (null ids come last). Empty tables give an empty result; further columns
    are not read. Items beyond at_once bytes of terms are searched in further scans, each with an automaton of its own.
    """
    spark = docs.sparkSession
    out = None
    for group in item_groups(items, item_id, item_text, at_once):
        one = searched(spark, docs, group, k, doc_id, text)
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out.withColumn("item_id", F.col("item_id").cast(items.schema[item_id].dataType))


def searched(spark: SparkSession, docs: DataFrame, items: Items, k: int, doc_id: str, text: str) -> DataFrame:
    counts = written(counted(docs, items.terms, doc_id, text), scratch(spark, "lexical"))
    size = counts.filter("n > 0").agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).head()
    holding = dict(counts.select(F.explode("found").alias("term")).groupBy("term").count().collect())  # at most the automaton's terms
    weights = [math.floor(1000 * math.log((2 * size["docs"] + 2) / (2 * holding.get(t, 0) + 1))) for t in range(len(items.terms))]
    names = spark.createDataFrame([*enumerate(items.ids)], "item int, item_id string" if any(isinstance(x, str) for x in items.ids) else "item int, item_id long")
    best = best_of(counts, items, weights, size["docs"], max(1, size["terms"]), k)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = best.withColumn("salt", F.pmod(F.hash("doc_id"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).filter(F.col("rank") <= k)
    top = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
    return top.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


#: DuckDB SQL for ranked() over documents and benchmark.
ORACLE = rf"""
WITH doc_terms AS (
  SELECT r AS row_id, doc_id, unnest(regexp_extract_all(translate(text, '{A_TO_Z}', '{LOWER}'), '{TERM}')) AS term
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
tf AS (SELECT row_id, doc_id, term, count(*) AS tf FROM doc_terms GROUP BY ALL),
size AS (SELECT row_id, sum(tf)::BIGINT AS n FROM tf GROUP BY row_id),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM size),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{A_TO_Z}', '{LOWER}'), '{TERM}')) AS term FROM benchmark),
scored AS (
  SELECT item_id, row_id, doc_id, sum(
    floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT
    * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // terms)))))::BIGINT AS score
  FROM item_terms JOIN tf USING (term) JOIN df USING (term) JOIN size USING (row_id) CROSS JOIN whole
  GROUP BY ALL),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM numbered WHERE rank <= 10
"""
