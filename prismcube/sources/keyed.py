"""Stored tables that a delta is merged into by parts (L2), and tables whose buckets joins can use (I4)."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prismcube.sources.checkpoints import cut
from prismcube.sources.delta import apply_delta
from prismcube.sources.tables import write_table

BUCKET = "_bucket"


@dataclass(frozen=True)
class Layout:
    """How keys are dealt to buckets: by hash, or with low and high in equal ranges of the first key (a number), what lies
    outside in the outer ones. Ranges keep changes of near keys together; null keys are in bucket 0."""

    keys: tuple[str, ...]
    buckets: int
    low: float | None = None
    high: float | None = None

    def __post_init__(self) -> None:
        if not self.keys or self.buckets < 1 or (self.low is None) != (self.high is None) or self.low is not None and self.low >= self.high:
            raise ValueError("keys, at least one bucket, and both or neither of low < high")

    def bucket(self) -> Column:
        if self.low is None:
            return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        at = F.floor((F.col(self.keys[0]).cast("double") - self.low) * (self.buckets / (self.high - self.low)))
        return F.coalesce(F.greatest(F.lit(0), F.least(F.lit(self.buckets - 1), at)), F.lit(0)).cast("int")


@dataclass
class KeyedTable:
    """A table under ``path`` in folders by bucket of its key; a merge reads and rewrites the folders that hold changed keys only."""

    spark: SparkSession
    path: str
    layout: Layout
    target_file_mb: int = 150

    @classmethod
    def create(cls, df: DataFrame, path: str, layout: Layout, target_file_mb: int = 150) -> KeyedTable:
        """Writes df as a new table; its layout is kept beside it."""
        spark = df.sparkSession
        write_table(df.withColumn(BUCKET, layout.bucket()), f"{path}/data", [BUCKET], target_file_mb=target_file_mb, whole=True)
        spark.createDataFrame([(json.dumps(asdict(layout)),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/layout")
        return cls(spark, path, layout, target_file_mb)

    @classmethod
    def open(cls, spark: SparkSession, path: str, target_file_mb: int = 150) -> KeyedTable:
        kept = json.loads(spark.read.text(f"{path}/layout").first()[0])
        return cls(spark, path, Layout(**{**kept, "keys": tuple(kept["keys"])}), target_file_mb)

    def stored(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/data")

    def read(self) -> DataFrame:
        return self.stored().drop(BUCKET)

    def merge(self, upserts: DataFrame, deletes: DataFrame) -> list[int]:
        """Applies a delta (delta()'s upserts and deletes) and returns the buckets that were rewritten.

        Files of the other buckets keep their names and bytes. The new rows of the touched buckets are written aside first,
        so a run that fails before the last step changes nothing, and one that fails in it can be repeated. Upserts of
        other columns replace the whole table, as apply_delta() does.
        """
        keys, old = [*self.layout.keys], self.stored()
        if {*upserts.columns} != {*old.columns} - {BUCKET}:
            self.create(cut(upserts, "merged"), self.path, self.layout, self.target_file_mb)
            return [*range(self.layout.buckets)]
        own = self.layout.bucket()
        changed = upserts.select(*keys).unionByName(deletes.select(*keys)).select(own.alias(BUCKET)).distinct()
        touched = sorted(r[0] for r in changed.collect())  # at most the number of buckets
        if not touched:
            return []
        part = old.filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
        made = cut(apply_delta(part, upserts.select(*part.columns), deletes, keys).withColumn(BUCKET, own), "merged")
        full = {r[0] for r in made.select(BUCKET).distinct().collect()}
        write_table(made, f"{self.path}/data", [BUCKET], target_file_mb=self.target_file_mb)
        for b in touched:
            if b not in full:  # nothing is left of it: an empty file takes the place of its files
                made.filter("false").drop(BUCKET).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/data/{BUCKET}={b}")
        return touched


def buckets_for(rows: int, least: int = 8, rows_each: int = 500_000) -> int:
    """A number of buckets for tables that are joined by them: enough that one of even keys holds about rows_each rows of the
    largest table, whatever that table grows to; a multiple of least. Spark allows a hundred thousand buckets."""
    return min(100_000 // least, max(1, -(-rows // (rows_each * least)))) * least


def save_bucketed(df: DataFrame, table: str, buckets: int, cluster_by: Sequence[str], partition: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """df as a catalogue table in sorted buckets of cluster_by, inside partitions if given (I4), and the table.

    The catalogue knows the buckets: joins and aggregations of such tables on these columns need no exchange where their
    numbers of buckets are equal. Rows are dealt as buckets are, so each bucket of a partition is one file.
    """
    writer = df.repartition(buckets, *cluster_by).write.mode("overwrite").bucketBy(buckets, *cluster_by).sortBy(*cluster_by)
    writer = writer.partitionBy(*partition) if partition else writer
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)
