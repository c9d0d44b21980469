"""Reading catalog tables, partitioned Parquet and the snapshots of keyed tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidelake.lake import partition_folder, path_exists
from tidelake.operators.joins import broadcast_if_small
from tidelake.schemas import COMMIT_TIME
from tidelake.versions import LOG_SCHEMA, current_folders, read_folders, version_log

#: The hidden column by which an unpartitioned keyed table is laid out.
BUCKET = "_bucket"
#: Stamps that go into a filter; more are joined.
STAMPS = 1000

def catalog_scan(spark: SparkSession, name: str) -> DataFrame:
    """A registered table or view; its schema is ``.schema``."""
    return spark.table(name)


def partitioned_parquet_scan(
    spark: SparkSession, path: str, schema: StructType, **partition: str
) -> DataFrame:
    """A ``year=/month=`` table under a schema, which keeps '01' a string.

    ``partition`` picks partitions. Of a table with a log of versions only the folders of these
    are listed; of another one, too, if the columns lead the table's layout.
    """
    folders = current_folders(spark, path, partition)
    folder = partition_folder(path, partition)
    if folders is not None:
        df = read_folders(spark, path, schema, list(folders.values()))
    elif partition and path_exists(spark, folder):
        df = spark.read.schema(schema).option("basePath", path).parquet(folder)
    else:
        df = spark.read.schema(schema).parquet(path)
    for column, value in partition.items():
        df = df.filter(F.col(column) == value)
    return df


def current_snapshot(spark: SparkSession, path: str) -> tuple[str, list[str]] | None:
    """Stamp of the newest commit of a keyed table, and the folders that hold its rows."""
    log = version_log(spark, path)
    if log is None:
        return None
    newest = log.agg(F.max("stamp")).first()[0]
    return newest, sorted(current_folders(spark, path).values())


def snapshot_scan(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame:
    """The latest version of each key of a keyed table.

    Versions that are being written, or were left by a run that failed, are never read.
    """
    newest = current_snapshot(spark, path)
    if newest is None:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    return read_folders(spark, path, schema, newest[1]).drop(BUCKET)


def commits_of(spark: SparkSession, path: str) -> DataFrame:
    """The commits of a keyed table: stamp, instant, part, one row per partition touched."""
    log = version_log(spark, path)
    if log is None:
        log = spark.range(0).selectExpr(*[f"CAST(NULL AS STRING) AS {c}" for c in LOG_SCHEMA.names])
    return log.select("stamp", "instant", "part")


def scan_commits(
    spark: SparkSession, path: str, schema: StructType | None, commits: Iterable[Row],
    where: Mapping[str, str | None] | None = None,
) -> DataFrame:
    """The rows that some commits (rows of ``commits_of``) wrote and that still count.

    Only the partitions that these commits have touched are listed and read, and their stamps reach
    the Parquet scan as a filter.
    """
    commits = list(commits)  # as the log: small
    stamps = sorted({r.stamp for r in commits})
    folders = current_folders(spark, path, where, {r.part for r in commits}) or {}
    if not folders:
        return snapshot_scan(spark, path, schema).limit(0)
    rows = read_folders(spark, path, schema, sorted(folders.values())).drop(BUCKET)
    if len(stamps) <= STAMPS:
        return rows.filter(F.col(COMMIT_TIME).isin(stamps))
    between = F.col(COMMIT_TIME).between(stamps[0], stamps[-1])
    own = broadcast_if_small(spark.createDataFrame([(s,) for s in stamps], f"{COMMIT_TIME} string"))
    return rows.filter(between).join(own, COMMIT_TIME, "left_semi")


def incremental_table_scan(
    spark: SparkSession, path: str, schema: StructType | None, after: str,
    max_commits: int | None = None, where: Mapping[str, str | None] | None = None,
) -> DataFrame:
    """Rows of the commits after ``after``, at most the first ``max_commits`` of them.

    The commits come from the table's log, so no column of the table is scanned to find them.
    """
    commits = commits_of(spark, path).filter(F.col("stamp") > after)
    if max_commits is not None:
        first = commits.select("stamp").distinct().orderBy("stamp").limit(max_commits)
        commits = commits.join(first, "stamp", "left_semi")
    return scan_commits(spark, path, schema, commits.collect(), where)


def latest_table_commit(spark: SparkSession, path: str) -> str | None:
    """The stamp of the latest commit of a keyed table, from its log."""
    return commits_of(spark, path).agg(F.max("stamp")).first()[0]
