"""Extraction from many targets as a Spark data source (K1-K4).

Each input partition is one target, one template and a few strides, so a thousand
targets are a thousand tasks of one scan, not a thousand branches of a plan.
What goes wrong in a partition is caught there and comes back as a row of the
log; the other partitions' rows stay.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from prismcube.sources.checkpoints import cut

#: A target's rows for a query, whatever connects to it: tuples in the order of the template's schema.
Fetch = Callable[[Mapping[str, str], str], Iterable[tuple]]
LOG = "environment string, sql_name string, target_key string, stride int, batch_number long, row_count long, exec_time_ms long, is_error boolean, message string, start_at timestamp, end_at timestamp"


@dataclass(frozen=True)
class Template:
    """A query with [TOKEN]s, the columns that it returns (DDL), and the conditions that part it; each runs by itself, in place of [STRIDE]."""

    query: str
    schema: str
    strides: tuple[str, ...] = ("1 = 1",)


@dataclass
class Work(InputPartition):
    """Strides of one target's query that one task runs one after the other."""

    target: dict[str, str]
    strides: list[tuple[int, str]] = field(default_factory=list)


def fill(query: str, target: Mapping[str, str], stride: str) -> str:
    for token, value in {**target, "STRIDE": stride}.items():
        query = query.replace(f"[{token}]", str(value))
    return query


def dealt(targets: Sequence[Mapping[str, str]], template: Template, connections: int) -> list[Work]:
    """At most ``connections`` partitions for each target, so no target is asked by more tasks at a time; first those of all targets, then the second ones."""
    numbered, out = [*enumerate(template.strides)], []
    n = max(1, min(connections, len(numbered)))
    for i in range(n):
        out += [Work({k: str(v) for k, v in t.items()}, numbered[i::n]) for t in targets]
    return out


def source_of(fetch: Fetch, work: list[Work], template: Template, name: str, environment: str, batch: int) -> type[DataSource]:
    """A data source whose rows are (target_key, stride, row, log): rows of the template, and one row of the log for each stride."""

    class Reader(DataSourceReader):
        def partitions(self) -> list[Work]:
            return work

        def read(self, partition: Work) -> Iterator[tuple]:
            key = partition.target.get("TARGET_KEY")
            for number, stride in partition.strides:
                began, clock, n, error = datetime.now(timezone.utc), time.monotonic(), 0, None
                try:
                    for row in fetch(partition.target, fill(template.query, partition.target, stride)):
                        yield key, number, tuple(row), None
                        n += 1
                except Exception as e:  # noqa: BLE001  whatever a target's driver raises is told in the log
                    error = f"{type(e).__name__}: {e}"[:2000]
                yield key, number, None, (environment, name, key, number, batch, n, int(1000 * (time.monotonic() - clock)), error is not None, error, began, datetime.now(timezone.utc))

    label = f"targets_{uuid.uuid4().hex}"

    class Targets(DataSource):
        @classmethod
        def name(cls) -> str:
            return label

        def schema(self) -> str:
            return f"target_key string, stride int, row struct<{template.schema}>, log struct<{LOG}>"

        def reader(self, schema: object) -> DataSourceReader:
            return Reader()

    return Targets


def extract_targets(spark: SparkSession, fetch: Fetch, targets: Sequence[Mapping[str, str]], templates: Mapping[str, Template], batch: int = 0, connections: int = 10, environment: str = "prod", only: set[tuple[str, str]] | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """For each template the rows of all targets that answered, with target_key, and the log of all strides (LOG).

    Everything is fetched once and written. A target of which any stride failed gives no rows for that template: its pair
    (target, template) is to be run again whole; failed_targets(pair_log(log), ...) finds it, and ``only`` takes such pairs
    (target_key, sql_name). No targets give empty tables. Queries are asked as they stand: one that a task runs twice, since an
    executor was lost, counts once.
    """
    rows, logs = {}, spark.createDataFrame([], LOG)
    for name, template in templates.items():
        some = [t for t in targets if only is None or (str(t.get("TARGET_KEY")), name) in only]
        source = source_of(fetch, dealt(some, template, connections), template, name, environment, batch)
        spark.dataSource.register(source)
        # a source without partitions can't be scanned, so without targets its columns are read from nothing
        done = cut(spark.read.format(source.name()).load() if some else spark.createDataFrame([], source({}).schema()), "extract")
        log = done.filter("log IS NOT NULL").select("log.*")
        failed = log.filter("is_error").select("target_key").distinct()
        good = done.filter("log IS NULL").alias("d").join(failed.alias("f"), F.col("d.target_key").eqNullSafe(F.col("f.target_key")), "left_anti")
        rows[name], logs = good.select("row.*", "target_key"), logs.unionByName(log)
    return rows, logs


def pair_log(log: DataFrame) -> DataFrame:
    """The log by pair and batch: a pair failed if any of its strides did; rows count only where none did."""
    pairs = log.groupBy("environment", "sql_name", "target_key", "batch_number").agg(F.bool_or("is_error").alias("is_error"), F.sum("row_count").alias("_n"), F.sum("exec_time_ms").alias("exec_time_ms"), F.min("start_at").alias("start_at"), F.max("end_at").alias("end_at"), F.max("message").alias("message"))
    return pairs.withColumn("row_count", F.when(F.col("is_error"), 0).otherwise(F.col("_n"))).drop("_n")
