"""Reading, writing, versioning and replicating tables (I, J, P)."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
WRITING = Lock()


def load(spark: SparkSession, table: str | None = None, path: str | None = None, sql: str | None = None, fmt: str = "parquet") -> DataFrame:
    """A table, a path or a query."""
    if sum(x is not None for x in (table, path, sql)) != 1:
        raise ValueError("one of table, path and sql")
    return spark.table(table) if table else spark.read.format(fmt).load(path) if path else spark.sql(sql)


def load_jdbc(spark: SparkSession, options: Mapping[str, str], predicates: Sequence[str] = ()) -> DataFrame:
    """A JDBC table, one partition for each predicate (P2, K1); the driver jar is the user's."""
    if predicates:
        rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(options["url"], options["dbtable"], predicates=[*predicates], properties=rest)
    return spark.read.format("jdbc").options(**options).load()


def split_statements(script: str) -> list[str]:
    """The statements of a script; semicolons in quotes and comments don't end one."""
    parts, held = [], ""
    for token in re.findall(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/|;|[^'\"`;/-]+|.", script, re.S):
        if token == ";":
            parts.append(held)
            held = ""
        elif not token.startswith(("--", "/*")):
            held += token
    return [p.strip() for p in [*parts, held] if p.strip()]


def run_script(spark: SparkSession, script: str, params: Mapping[str, str] | None = None) -> DataFrame | None:
    """Runs the statements in order and returns the last one's result; ``${k}`` and ``${hiveconf:k}`` are replaced."""
    out = None
    for statement in split_statements(script):
        out = spark.sql(re.sub(r"\$\{(?:hiveconf:)?(\w+)\}", lambda m: str((params or {})[m[1]]), statement))
    return out


def sql_with_sources(spark: SparkSession, query: str, sources: Mapping[str, DataFrame]) -> DataFrame:
    """A query in which ``{noSqlTable:x}`` and ``{x}`` stand for DataFrames."""
    return spark.sql(re.sub(r"\{noSqlTable:(\w+)\}", r"{\1}", query), **sources)


def empty_to_null(df: DataFrame) -> DataFrame:
    """Empty arrays and maps become null."""
    nested = [c for c, t in df.dtypes if t.startswith(("array<", "map<"))]
    return df.withColumns({c: F.when(F.size(c) > 0, F.col(c)) for c in nested})


def conform(df: DataFrame, target: DataFrame) -> DataFrame:
    """Columns that target has too, cast to its types where they differ (I8)."""
    types = dict(target.dtypes)
    return df.withColumns({c: F.col(c).cast(types[c]) for c, t in df.dtypes if c in types and types[c] != t})


def align_to(df: DataFrame, target: DataFrame, pad: bool = False, lenient: bool = False) -> DataFrame:
    """df's columns that target has, in target's order and types, names in either case; with pad the others as nulls (L4).
    A value that its new type can't hold raises, or with lenient becomes null."""
    own = {c.lower(): c for c in df.columns}
    typed = lambda c, t: F.col(own[c.lower()]).try_cast(t) if lenient else F.col(own[c.lower()]).cast(t)
    cols = [typed(c, t).alias(c) if c.lower() in own else F.lit(None).cast(t).alias(c) for c, t in target.dtypes if pad or c.lower() in own]
    return df.select(*cols)


def partition_spec(partitions: Sequence[str]) -> tuple[dict[str, str], list[str]]:
    """Static values and names of all partition columns from ``c=v`` and ``c``."""
    static = dict(p.split("=", 1) for p in partitions if "=" in p)
    return {k.lower(): v for k, v in static.items()}, [p.split("=", 1)[0].lower() for p in partitions]


def write_table(df: DataFrame, path: str, partitions: Sequence[str] = (), mode: str = "overwrite", fmt: str = "parquet", target_file_mb: int = 150, options: Mapping[str, str] | None = None, whole: bool = False, rebalance: bool = True) -> None:
    """Writes df, lower-cased, under path; partitions are static (``c=v``) or dynamic (``c``), in any order.

    Overwriting replaces the partitions that df has and leaves the others, or with ``whole`` the table. Rows are rebalanced
    by partition so that files come out near the target size, whatever the skew of the partitions; without ``rebalance`` they
    are written as df deals and orders them. Spark takes that size from a setting of the session, so writers in one process
    take turns.
    """
    static, names = partition_spec(partitions)
    out = empty_to_null(df.toDF(*(c.lower() for c in df.columns)))
    out = out.withColumns({k: F.lit(v) for k, v in static.items()})
    spark = df.sparkSession
    even = out.hint("rebalance", *names) if rebalance else out
    writer = even.write.format(fmt).mode(mode).options(**(options or {}))
    if names:
        writer = writer.partitionBy(*names).option("partitionOverwriteMode", "static" if whole else "dynamic")
    with WRITING:
        before = spark.conf.get(FILE_SIZE)
        spark.conf.set(FILE_SIZE, f"{target_file_mb}m")
        try:
            writer.save(path)
        finally:
            spark.conf.set(FILE_SIZE, before)


def deals_itself(sql: str) -> bool:
    """Whether a query says at its own level, not in brackets, how its rows are dealt or ordered."""
    depth, plain = 0, ""
    for token in re.findall(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/|.", sql, re.S):
        depth += {"(": 1, ")": -1}.get(token, 0)
        plain += token if depth == 0 and len(token) == 1 else " "
    return bool(re.search(r"\b(?:distribute|cluster|sort|order)\s+by\b", plain, re.I))


def insert_select(spark: SparkSession, sql: str, path: str, **options: object) -> None:
    """The result of a query through the file-sizing writer; columns match by position where the table exists (P5).

    A query's own DISTRIBUTE, CLUSTER, SORT or ORDER BY is kept: its rows are written as it deals and orders them.
    """
    df = spark.sql(sql)
    if exists(spark, path):
        target = spark.read.parquet(path)
        df = conform(df.toDF(*target.columns), target)
    write_table(df, path, **{"rebalance": not deals_itself(sql), **options})


def write_by_value(df: DataFrame, path: str, column: str, fmt: str = "json") -> None:
    """One folder for each value of a column."""
    df.hint("rebalance", column).write.mode("overwrite").partitionBy(column).format(fmt).save(path)


def bucketize(df: DataFrame, partition: Sequence[str], n: int, cluster_by: Sequence[str]) -> DataFrame:
    """df and ``bucket`` (hash of cluster_by, below n), dealt in ranges of (partition, bucket) and sorted inside (I4)."""
    keyed = df.withColumn("bucket", F.pmod(F.xxhash64(*cluster_by), F.lit(n)).cast("int"))
    return keyed.repartitionByRange(*partition, "bucket").sortWithinPartitions(*partition, "bucket", *cluster_by)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether something is stored under path, in whichever file system the path names."""
    try:
        spark.read.format("binaryFile").load(path)  # its schema is fixed, so no file is opened
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def same_columns(a: DataFrame, b: DataFrame) -> bool:
    """Whether both have the same names in either case, string or not."""
    kinds = lambda d: {(c.lower(), t == "string") for c, t in d.dtypes}
    return kinds(a) == kinds(b)


def evolve_table(old: DataFrame, new: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """The next version of a table whose schema changed: new's partitions, and old's others with nulls for what they lack
    and for values that a column's new type can't hold (I6). Null partitions are partitions."""
    same = reduce(lambda a, b: a & b, [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in partitions])
    kept = old.alias("o").join(new.select(*partitions).distinct().alias("n"), same, "left_anti")
    return new.unionByName(align_to(kept, new, pad=True, lenient=True), allowMissingColumns=True)


def repair_versions(versions: Sequence[DataFrame], partitions: Sequence[str]) -> DataFrame:
    """The newest version (first) with partitions that it lacks from the next older one that has them."""
    out = versions[0]
    for older in versions[1:]:
        gaps = older.join(out.select(*partitions).distinct(), [*partitions], "left_anti")
        out = out.unionByName(align_to(gaps, out, pad=True))
    return out


def sync_plan(src: DataFrame, dst: DataFrame | None, partitions: Sequence[str], force: bool = False) -> DataFrame:
    """The rows to copy: all where the target is absent, empty, of another schema or forced, else those of partitions that
    it lacks; nothing for an unpartitioned target that has rows (J1)."""
    if dst is None or force or not same_columns(src, dst) or not dst.head(1):
        return src
    if not partitions:
        return src.limit(0)
    return src.join(dst.select(*partitions).distinct(), [*partitions], "left_anti")


def exclude_ids(df: DataFrame, column: str, ids: Sequence[str]) -> DataFrame:
    """df without rows of listed ids; null and blank ids stay."""
    own = F.col(column)
    return df.filter(own.isNull() | (F.trim(own.cast("string")) == "") | ~own.cast("string").isin(*ids))


def sync_table(spark: SparkSession, src: DataFrame, path: str, partitions: Sequence[str] = (), force: bool = False) -> None:
    """Brings the copy under path up to date (J1): whole, with nothing of the old copy left, or by adding the missing partitions."""
    dst = spark.read.parquet(path) if exists(spark, path) else None
    rows = sync_plan(src, dst, partitions, force)
    whole = dst is None or force or not same_columns(src, dst)
    write_table(rows, path, partitions, "overwrite" if whole else "append", whole=whole)


def archive_snapshot(df: DataFrame, path: str, week: str) -> None:
    """df into the week's partition of an archive."""
    write_table(df, path, [f"wk_cd={week}"])
