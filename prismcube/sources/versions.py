"""Tables in versions (I6, I7): a new schema gets a new version, a log beside the data names the current one.

Under the table's path, ``v<n>`` holds the data of a version and ``log/v<n>`` one
row about it. A version counts as soon as its log entry is written, and a reader
sees either the version before or the new one whole: data is written first, and
the entry is one file that appears at once. What an interrupted run left without
an entry is never read, and the next run writes over it. One writer at a time;
a second one that finds the number of its entry taken is refused.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from prismcube.sources.tables import align_to, evolve_table, partition_spec, repair_versions, same_columns, write_table

LOG = "version int, base int, kind string, partitions array<string>, columns string, written_at timestamp"


class SubsetError(ValueError):
    """A newer version lacks partitions of the one before it."""


@dataclass
class VersionedTable:
    """A table under ``path``; all versions are partitioned by the same columns unless a version says otherwise."""

    spark: SparkSession
    path: str
    partitions: Sequence[str] = ()
    target_file_mb: int = 150
    names: list[str] = field(init=False)

    def __post_init__(self) -> None:
        self.names = partition_spec(self.partitions)[1]

    def log(self) -> DataFrame:
        """All entries: versions as they came, and those that were dropped since. A table that was never written has none."""
        try:
            return self.spark.read.schema(LOG).option("recursiveFileLookup", "true").json(f"{self.path}/log")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LOG)

    def live(self) -> dict[int, object]:
        """Entries of the versions whose data is still there, the oldest first."""
        entries = self.log().orderBy("version").collect()  # one short row for each schema that the table ever had
        gone = {r["version"] for r in entries if r["kind"] == "dropped"}
        return {r["version"]: r for r in entries if r["kind"] == "written" and r["version"] not in gone}

    def current(self) -> int | None:
        return max(self.live(), default=None)

    def read(self, version: int | None = None) -> DataFrame:
        """The current version, or a given one that is still there."""
        live = self.live()
        at = max(live, default=None) if version is None else version
        if at not in live:
            raise ValueError(f"no version {at} under {self.path}")
        return self.spark.read.schema(StructType.fromJson(json.loads(live[at]["columns"]))).parquet(f"{self.path}/v{at}")

    def entry(self, version: int, base: int | None, kind: str, schema: StructType | None, partitions: Sequence[str]) -> None:
        row = self.spark.createDataFrame([(version, base, kind, [*partitions], schema.json() if schema else None)], "version int, base int, kind string, partitions array<string>, columns string")
        row.withColumn("written_at", F.current_timestamp()).coalesce(1).write.mode("errorifexists").json(f"{self.path}/log/v{version}{'' if kind == 'written' else '-' + kind}")

    def stage(self, df: DataFrame) -> int:
        """Writes df as the data of the next version, over what an interrupted run may have left; nothing reads it yet."""
        version = max([0, *(r["version"] for r in self.log().select("version").collect())]) + 1
        write_table(df, f"{self.path}/v{version}", self.partitions, target_file_mb=self.target_file_mb, whole=True)
        return version

    def commit(self, version: int) -> None:
        """Makes a staged version the current one."""
        self.entry(version, self.current(), "written", self.spark.read.parquet(f"{self.path}/v{version}").schema, self.names)

    def write(self, df: DataFrame) -> int:
        """Writes df's partitions and returns the version that holds them.

        With the columns of the current version they are replaced there. Otherwise a new version is made: df's partitions, and
        those that only the version before has, with nulls for what they lack. The version before stays as it is.
        """
        new = df.toDF(*(c.lower() for c in df.columns))
        new = new.withColumns({k: F.lit(v) for k, v in partition_spec(self.partitions)[0].items()})
        at = self.current()
        if at is None:
            version = self.stage(new)
            self.commit(version)
            return version
        old = self.read(at)
        if same_columns(old, new):
            write_table(align_to(new, old), f"{self.path}/v{at}", self.partitions, target_file_mb=self.target_file_mb, whole=not self.names)
            return at
        version = self.stage(evolve_table(old, new, self.names) if self.names else new)
        self.commit(version)
        return version

    def subset(self, older: int, newer: int) -> bool | None:
        """Whether the newer version has all partitions of the older one; None where the two are partitioned otherwise.

        Of versions without partitions, an empty older one and a newer one with rows don't compare as a subset.
        """
        live = self.live()
        if [*live[older]["partitions"]] != [*live[newer]["partitions"]]:
            return None
        names, a, b = live[older]["partitions"], self.read(older), self.read(newer)
        if not names:
            return bool(a.head(1)) or not b.head(1)
        return not missing_partitions(a, b, names).head(1)

    def clean_up(self) -> list[int]:
        """Drops all versions but the current one and the one before it, the oldest first, each once the next newer one is
        found to have all its partitions; raises SubsetError at the first that fails. Returns what was dropped."""
        older, dropped = [*self.live()][:-1], []
        for version, newer in zip(older[:-1], older[1:], strict=True):
            if not self.subset(version, newer):
                raise SubsetError(f"version {newer} doesn't hold all partitions of version {version}")
            self.drop(version)
            dropped.append(version)
        return dropped

    def drop(self, version: int) -> None:
        """The entry goes first, so that nobody reads a version whose data is half gone; then the data is replaced by nothing."""
        if version == self.current():
            raise ValueError("the current version stays")
        self.entry(version, None, "dropped", None, ())
        self.spark.range(0).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/v{version}")

    def repair(self) -> int:
        """Brings partitions that the current version lacks back from older ones, the newest that has them."""
        live = sorted(self.live(), reverse=True)
        rows = repair_versions([self.read(v) for v in live], self.names)
        found = missing_partitions(rows, self.read(live[0]), self.names)
        same = reduce(lambda a, b: a & b, [F.col(f"r.{c}").eqNullSafe(F.col(f"m.{c}")) for c in self.names])
        write_table(rows.alias("r").join(found.alias("m"), same, "left_semi"), f"{self.path}/v{live[0]}", self.partitions, target_file_mb=self.target_file_mb)
        return live[0]


def missing_partitions(older: DataFrame, newer: DataFrame, names: Sequence[str]) -> DataFrame:
    """The partitions of older that newer lacks; null ones count as partitions."""
    same = reduce(lambda a, b: a & b, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in names])
    return older.select(*names).distinct().alias("a").join(newer.select(*names).distinct().alias("b"), same, "left_anti")
