"""Parent and child hierarchies (E): levels, paths, closures, what follows from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prismcube.sources.checkpoints import cut

MAX_LEVELS = 16


def build_hierarchy(df: DataFrame, key: str, parent: str, by: Sequence[str] = (), roots: Column | None = None, levels: int = MAX_LEVELS) -> DataFrame:
    """df's rows, ``layer`` (1 at the roots, 0 if unreachable) and ``path`` (the ancestors, root first; null if unreachable).

    Breadth first: the frontier is joined with its children until none is left or ``levels`` are placed. Only rows that are
    not placed yet may join, so a node stands once, at its first level, and cycles end. Roots: blank or null parents unless
    a condition is given. Each level is written to the shared folder before it is used again.
    """
    by = [*by]
    edges = cut(df.select(*by, F.col(key).alias("_key"), F.col(parent).alias("_parent"), (roots if roots is not None else F.coalesce(F.trim(F.col(parent).cast("string")), F.lit("")) == "").alias("_root")).dropDuplicates([*by, "_key"]), "edges")
    front = edges.filter("_root").select(*by, "_key", F.lit(1).alias("layer"), F.array().cast(f"array<{dict(edges.dtypes)['_key']}>").alias("path"))
    placed = front = cut(front, "level")
    rest = edges.filter("not _root").select(*by, "_key", "_parent")
    for layer in range(2, levels + 1):
        up = front.select(*by, F.col("_key").alias("_parent"), F.concat("path", F.array("_key")).alias("path"))
        front = cut(rest.join(up, [*by, "_parent"]).select(*by, "_key", F.lit(layer).alias("layer"), "path").join(placed.select(*by, "_key"), [*by, "_key"], "left_anti"), "level")
        if not front.head(1):
            break
        placed = placed.unionByName(front)
    out = df.join(placed.withColumnRenamed("_key", key), [*by, key], "left")
    return out.withColumn("layer", F.coalesce("layer", F.lit(0)))


def layer_parents(df: DataFrame, levels: int = MAX_LEVELS - 1) -> DataFrame:
    """layer_<n>_parent columns from path, padded with nulls."""
    return df.withColumns({f"layer_{i + 1}_parent": F.get("path", F.lit(i)) for i in range(levels)})


def closure(tree: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """by, key, ancestor, ancestor_layer, levels_up: a row for each node and ancestor."""
    pairs = tree.filter(F.size("path") > 0).select(*by, key, "layer", F.posexplode("path").alias("_i", "ancestor"))
    return pairs.select(*by, key, "ancestor", (F.col("_i") + 1).alias("ancestor_layer"), (F.col("layer") - F.col("_i") - 1).alias("levels_up"))


def child_counts(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by, ancestor, direct, total, indirect: numbers of descendants."""
    n = pairs.groupBy(*by, "ancestor").agg(F.count_if(F.col("levels_up") == 1).alias("direct"), F.count("*").alias("total"))
    return n.withColumn("indirect", F.col("total") - F.col("direct"))


def span_of_control(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by, ancestor, span (direct reports), depth (levels below)."""
    return pairs.groupBy(*by, "ancestor").agg(F.count_if(F.col("levels_up") == 1).alias("span"), F.max("levels_up").alias("depth"))


def merge_hierarchies(first: DataFrame, second: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """keys and columns: every key of either hierarchy, each column from the first that has it."""
    b = second.select(*keys, *(F.col(c).alias(f"_{c}") for c in columns))
    return first.select(*keys, *columns).join(b, [*keys], "full").select(*keys, *(F.coalesce(c, f"_{c}").alias(c) for c in columns))


def access_rows(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by, ancestor, access, n: descendants that an ancestor reaches directly, and directly or indirectly."""
    kinds = F.when(F.col("levels_up") == 1, F.array(F.lit("D"), F.lit("DI"))).otherwise(F.array(F.lit("DI")))
    return pairs.select(*by, "ancestor", F.explode(kinds).alias("access")).groupBy(*by, "ancestor", "access").agg(F.count("*").alias("n"))


def rollup_to_ancestors(facts: DataFrame, pairs: DataFrame, key: str, sums: Mapping[str, str], by: Sequence[str] = (), at: str | None = None, valid: tuple[str, str] | None = None) -> DataFrame:
    """by, ancestor and sums (name: expression over facts) over all descendants; with ``at`` only where it lies in the pair's validity.

    Facts are summed by node first, and by time where validity is asked for, so that a node's facts cross the closure once.
    """
    time = [at] if at and valid else []
    own = facts.groupBy(*by, key, *time).agg(*(F.sum(F.expr(e)).alias(n) for n, e in sums.items()))
    joined = own.join(pairs.select(*by, key, "ancestor", *(valid or ())), [*by, key])
    if time:
        joined = joined.filter(F.col(at).between(F.col(valid[0]), F.col(valid[1])))
    return joined.groupBy(*by, "ancestor").agg(*(F.sum(n).alias(n) for n in sums))


def salted(df: DataFrame, by: Sequence[str], rows_a_bucket: int) -> DataFrame:
    """df and ``salt``: a bucket below ceil(group size / rows_a_bucket), so that groups of any size are dealt in equal parts.

    The bucket follows from the row, so a task that runs again deals alike; rows that are equal in all columns share one.
    """
    n = df.groupBy(*(F.col(c).alias(f"_g_{c}") for c in by)).agg(F.ceil(F.count("*") / rows_a_bucket).alias("_buckets"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return df.join(n, same).withColumn("salt", F.pmod(F.xxhash64(*df.columns), "_buckets").cast("int")).drop("_buckets", *(f"_g_{c}" for c in by))
