"""Hard negatives for anchors (operator 13): bounds along spanning trees of the anchors.

Anchors of one label are cut into blocks, and each block gets a minimum spanning
tree. Walking down a tree, a row's score with a child lies within its score (or
bounds) at the parent plus or minus the length of the edge times the row's norm.
Only rows whose bounds overlap what is asked for, the best scores of the label or
a positive's window above the five best found so far, are scored again, exactly.
Blocks are handed to all rows in rounds of bounded size, so rows are never
shuffled or paired; a task returns a few rows for each anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prismcube.llm.common import saved

#: Anchors that share a tree, and bytes of anchors that are broadcast in one round (bounds on memory, not on anchors).
BLOCK, ROUND_BYTES = 1024, 16 << 20
#: Positives of an anchor, negatives of a positive, and the least share of the positive's score in hundredths.
POSITIVES, NEGATIVES, LEAST = 5, 5, 80
#: Relative room for rounding in bounds; doubles hold products exactly below this.
ROOM, EXACT = 1e-9, float(1 << 53)


def prepared(vectors: DataFrame) -> DataFrame:
    """vec_id, label, vec of the rows that take part: the label as changed, components as whole numbers.

    Rows with a null vec_id, label, vector or component, or one that is not finite, take no part.
    """
    x = F.col("embedding").cast("array<double>")
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall(x, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.filter(fine).select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.transform(x, lambda v: F.floor(v * 256)).alias("vec"))


def matrix(vecs: list[np.ndarray]) -> np.ndarray:
    """Vectors as rows; a shorter one counts as filled up with zeros."""
    wide = max(map(len, vecs), default=0)
    if all(len(v) == wide for v in vecs):
        return np.array(vecs, np.float64).reshape(len(vecs), wide)
    out = np.zeros((len(vecs), wide))
    for row, v in zip(out, vecs, strict=True):
        row[: len(v)] = v
    return out


def norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", rows, rows))


def spanning_tree(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of the rows with parents before children and the largest branch last, and in that order each row's parent
    (-1: the root) and the length of the edge to it. The tree is the minimum spanning tree (Prim)."""
    n = len(rows)
    parent, away = np.full(n, -1), np.full(n, np.inf)
    inside, at = np.zeros(n, bool), int(np.argmin(norms(rows - rows.mean(axis=0))))
    children: list[list[int]] = [[] for _ in range(n)]
    joined = []
    for _ in range(n):
        inside[at] = True
        joined.append(at)
        if parent[at] >= 0:
            children[parent[at]].append(at)
        new = norms(rows - rows[at])
        closer = ~inside & (new < away)
        away[closer], parent[closer] = new[closer], at
        at = int(np.argmin(np.where(inside, np.inf, away)))
    weight = np.ones(n, np.int64)
    for at in reversed(joined):
        if parent[at] >= 0:
            weight[parent[at]] += weight[at]
    order, stack = [], [joined[0]]
    while stack:
        at = stack.pop()
        order.append(at)
        stack += sorted(children[at], key=lambda c: -weight[c])
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    up = parent[order]
    return np.array(order), np.where(up >= 0, place[up], -1), np.where(up >= 0, away[order], 0.0)


def blocks_of(rows: DataFrame, every: int = 100, block: int = BLOCK) -> DataFrame:
    """Blocks of anchors of one label, near ones together: ids, vectors, parents and edges in the order of a tree. Repeated
    anchors (same id, label and vector) are one."""
    anchors = rows.filter(F.col("vec_id") % every == 0).distinct()
    parts = max(1, -(-anchors.count() // block))
    # anchors whose leading components have the same signs and size are near; only the choice of trees depends on it
    near = anchors.withColumn("near", F.slice("vec", 1, 8))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            for _, own in batch.groupby("label", sort=False):
                if held and (held[0]["label"].iloc[0] != own["label"].iloc[0]):
                    yield from packed(held)
                    held = []
                held.append(own)
                if sum(map(len, held)) >= block:
                    yield from packed(held)
                    held = []
        yield from packed(held)

    def packed(held: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not held:
            return
        every_one = pd.concat(held)
        for low in range(0, len(every_one), block):
            own = every_one.iloc[low : low + block]
            vecs = matrix([*own["vec"]])
            order, parent, edge = spanning_tree(vecs)
            yield pd.DataFrame({"label": [int(own["label"].iloc[0])], "ids": [own["vec_id"].to_numpy()[order]], "wide": [vecs.shape[1]], "vecs": [vecs[order].tobytes()], "parent": [parent], "edge": [edge]})

    return near.repartitionByRange(parts, "label", "near", "vec_id").sortWithinPartitions("label", "near", "vec_id").select("label", "vec_id", "vec").mapInPandas(each, "label long, ids array<long>, wide int, vecs binary, parent array<int>, edge array<double>")


@dataclass
class Block:
    """One tree of anchors; number is that of its first anchor. asked: the scores of each anchor's positives, the best first."""

    number: int
    label: int
    ids: np.ndarray
    vecs: np.ndarray
    parent: np.ndarray
    edge: np.ndarray
    asked: list[list[int]] | None = None

    def last_use(self) -> dict[int, int]:
        return {int(p): i for i, p in enumerate(self.parent)}


def rounds(blocks: DataFrame, at_once: int = ROUND_BYTES) -> Iterator[list[Block]]:
    """Blocks in groups of bounded size, always in the same order; one group is held at a time."""
    held, size, number = [], 0, 0
    for r in blocks.orderBy("label", "ids").toLocalIterator():
        bytes_ = len(r["vecs"]) + 28 * len(r["ids"])
        if held and size + bytes_ > at_once:
            yield held
            held, size = [], 0
        vecs = np.frombuffer(r["vecs"], np.float64).reshape(len(r["ids"]), r["wide"])
        held.append(Block(number, r["label"], np.array(r["ids"]), vecs, np.array(r["parent"]), np.array(r["edge"])))
        number += len(r["ids"])
        size += bytes_
    if held:
        yield held


class Found:
    """The best few (score, id) for one question, the best first: higher scores, then smaller ids."""

    def __init__(self, few: int, low: float, high: float):
        self.few, self.low, self.high, self.scores, self.ids = few, low, high, np.empty(0, np.int64), np.empty(0, np.int64)

    def least(self) -> float:
        """A lower score is of no use any more (an equal one may be, by its id)."""
        return self.low if len(self.scores) < self.few else max(self.low, float(self.scores[-1]))

    def put(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """scores, the best first."""
        start = int(np.searchsorted(-scores, -self.high, "left"))
        end = min(int(np.searchsorted(-scores, -self.least(), "right")), start + self.few)
        if start < end:
            s, i = np.r_[self.scores, scores[start:end]], np.r_[self.ids, ids[start:end]]
            best = np.lexsort((i, -s))[: self.few]
            self.scores, self.ids = s[best], i[best]


def walk(block: Block, ids: np.ndarray, rows: np.ndarray, questions: Callable[[int], list[Found]]) -> int:
    """Puts the scores of rows with each anchor of a block to the anchor's questions; how many were computed."""
    if not len(ids):
        return 0
    wide = max(rows.shape[1], block.vecs.shape[1])
    rows, vecs = (x if x.shape[1] == wide else np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (rows, block.vecs))
    reach = norms(rows)
    if (norms(vecs).max() * reach.max()) >= EXACT:
        rows, vecs = rows.astype(np.int64), vecs.astype(np.int64)  # exact below 2^63
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    last, computed = block.last_use(), 0
    for i, up in enumerate(block.parent.tolist()):
        asked = questions(i)
        if up < 0:
            low = high = rows @ vecs[i]
            chosen = np.arange(len(ids))
        else:
            above, room = bounds[up], block.edge[i] * reach * (1 + ROOM) + ROOM
            low, high = above[0] - room, above[1] + room
            if last[up] == i:
                del bounds[up]
            wanted = np.zeros(len(ids), bool)
            for q in asked:
                wanted |= (high >= q.least()) & (low <= q.high)
            chosen = np.flatnonzero(wanted)
            if len(chosen):
                exact = rows[chosen] @ vecs[i] if 2 * len(chosen) < len(ids) else (rows @ vecs[i])[chosen]
                low[chosen] = high[chosen] = exact
        computed += len(chosen)
        if i in last:
            bounds[i] = (low, high)
        if asked and len(chosen):
            scores, own = np.asarray(low[chosen]).astype(np.int64), ids[chosen]
            least = min(q.least() for q in asked)
            keep = (scores >= least) & (own != block.ids[i])
            scores, own = scores[keep], own[keep]
            order = np.lexsort((own, -scores))
            for q in asked:
                q.put(scores[order], own[order])
    return computed


def by_label(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels, ids and vectors of a batch, sorted by label."""
    batch = batch.sort_values("label", kind="stable")
    return batch["label"].to_numpy(), batch["vec_id"].to_numpy(), matrix([*batch["vec"]])


def positives(rows: DataFrame, blocks: list[Block], few: int = POSITIVES) -> DataFrame:
    """anchor (its number), positive_id, positive_score, slot: the first few other rows of each anchor's label."""
    sent = rows.sparkSession.sparkContext.broadcast(blocks)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = {b.number + i: Found(few, -np.inf, np.inf) for b in sent.value for i in range(len(b.ids))}
        for batch in batches:
            labels, ids, vecs = by_label(batch)
            for b in sent.value:
                low, high = np.searchsorted(labels, [b.label, b.label + 1])
                walk(b, ids[low:high], vecs[low:high], lambda i, b=b: [best[b.number + i]])
        out = [(a, int(i), int(s)) for a, f in best.items() for i, s in zip(f.ids, f.scores, strict=True)]
        yield pd.DataFrame(out, columns=["anchor", "positive_id", "positive_score"]).astype("int64")

    made = rows.mapInPandas(each, "anchor long, positive_id long, positive_score long")
    own = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    return made.withColumn("slot", F.row_number().over(own)).filter(F.col("slot") <= few)


def negatives_of(rows: DataFrame, blocks: list[Block], few: int = NEGATIVES, least: int = LEAST) -> DataFrame:
    """anchor, slot, rank, negative_id, negative_score: for each positive the first few rows of another label in its window."""
    sent = rows.sparkSession.sparkContext.broadcast(blocks)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = {b.number + i: [Found(few, -(-least * s // 100), s) for s in own] for b in sent.value for i, own in enumerate(b.asked or [])}
        for batch in batches:
            labels, ids, vecs = by_label(batch)
            for b in sent.value:
                other = labels != b.label
                walk(b, ids[other], vecs[other], lambda i, b=b: [q for q in best[b.number + i] if q.low <= q.high])
        out = [(a, slot, int(i), int(s)) for a, own in best.items() for slot, f in enumerate(own, 1) for i, s in zip(f.ids, f.scores, strict=True)]
        yield pd.DataFrame(out, columns=["anchor", "slot", "negative_id", "negative_score"]).astype("int64")

    made = rows.mapInPandas(each, "anchor long, slot long, negative_id long, negative_score long")
    own = Window.partitionBy("anchor", "slot").orderBy(F.desc("negative_score"), "negative_id")
    return made.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= few)


def mined(vectors: DataFrame, every: int = 100, block: int = BLOCK, at_once: int = ROUND_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of all anchors (ids divisible by ``every``).

    See prepared() for rows that take no part. Ties go by smaller ids. A row whose id repeats counts each time, but rows with
    an anchor's own id are neither its positives nor its negatives, and repeated anchors are one. Anchors without positives,
    positives with a score below 0 (their window is empty) and empty tables give no rows; further columns aren't read.
    Scores are exact below 2^63.
    """
    rows = prepared(vectors)
    blocks = saved(blocks_of(rows, every, block), "anchors")
    spark, out = vectors.sparkSession, None
    for group in rounds(blocks, at_once):
        found = saved(positives(rows, group), "positives")
        named = {b.number + i: int(v) for b in group for i, v in enumerate(b.ids)}
        kept: dict[int, list] = {}
        for r in found.orderBy("anchor", "slot").collect():  # some for each anchor of the round
            kept.setdefault(r["anchor"], []).append(r)
        for b in group:
            b.asked = [[r["positive_score"] for r in kept.get(b.number + i, [])] for i in range(len(b.ids))]
        ids = spark.createDataFrame([*named.items()], "anchor long, anchor_id long")
        one = saved(negatives_of(rows, group), "negatives").join(found.join(ids, "anchor"), ["anchor", "slot"])
        one = one.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
        out = one if out is None else out.unionByName(one)
    if out is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return out


#: DuckDB SQL for mined() over embeddings.
ORACLE = """
WITH fine AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda v: floor(256 * v::DOUBLE)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, list_inner_product(a.vec, c.vec)::BIGINT AS score
  FROM (SELECT DISTINCT * FROM fine WHERE vec_id % 100 = 0) a JOIN fine c ON c.vec_id <> a.vec_id),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""
