"""Small helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps
from threading import RLock

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed: the word characters of every contract are those outside these six blanks.
BLANK = r"[ \t\n\x0B\f\r]"
#: Spark's settings while a table is written: the shuffle files behind it go when it is done, and Python gets batches of bounded size.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
WHILE_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", BATCH: str(BATCH_BYTES)}
#: Writers of one session take turns with its settings.
WRITING = RLock()


def shared_dir(spark: SparkSession) -> str:
    """The folder all machines share, ``spark.checkpoint.dir``. Only a session of one machine may leave it unset."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        at = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, at: str, mode: str = "overwrite", by: tuple[str, ...] = ()) -> DataFrame:
    """df written to a path (in folders by some columns), and what is there then; the shuffle files behind it go as soon as it is written."""
    conf = df.sparkSession.conf
    with WRITING:
        before = {k: conf.get(k) for k in WHILE_WRITING}
        for k, v in WHILE_WRITING.items():
            conf.set(k, v)
        try:
            df.write.mode(mode).partitionBy(*by).parquet(at)
        finally:
            for k, v in before.items():
                conf.set(k, v)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def in_small_batches(df: DataFrame) -> DataFrame:
    """df, whose Python stage is to get batches of bounded size from whoever writes it: a setting of its session from here on.

    A batch of ten thousand long texts would take some hundred megabytes for each task, in the JVM and again in Python.
    """
    df.sparkSession.conf.set(BATCH, str(BATCH_BYTES))
    return df


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: its lineage ends there and survives lost executors."""
    return written(df, scratch(df.sparkSession, name))


def give_back() -> None:
    """Returns this process's unused memory to the machine: collected objects, Arrow's pool, and what the C library keeps."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def tidy(each: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over a partition's batches that gives the worker's unused memory back to the machine, before them what earlier
    stages left and afterwards its own: workers stay for later stages, and would keep the largest batch's memory until then."""

    @wraps(each)
    def run(batches: Iterator) -> Iterator:
        give_back()
        try:
            yield from each(batches)
        finally:
            give_back()

    return run


class States:
    """Named intermediate tables of one job in the shared folder. Of each name the last two versions are kept, so that a
    new one can be made from the one before; clear() empties those that nothing reads any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.at, self.versions = spark, scratch(spark, name), {}

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.versions[name] = self.versions.get(name, 0) + 1
        return written(df, f"{self.at}/{name}-{self.versions[name] % 2}")

    def clear(self, *names: str) -> None:
        for name in names:
            for version in range(max(1, self.versions.get(name, 0) - 1), self.versions.pop(name, 0) + 1):
                self.spark.range(0).coalesce(1).write.mode("overwrite").parquet(f"{self.at}/{name}-{version % 2}")


def text_of(col: str | Column = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text, in order: what stands between blanks."""
    return F.array_remove(F.split(text, BLANK + "+"), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
