"""Versions of a table's partitions, and the log that says which of them count.

The rows of a partition lie in ``<partition>/_version=<run>``. A run writes folders of its own beside
the ones that are read, and then adds one file to the log ``<table>/_commits``, with a row for each
partition that it has touched. From that moment on, and not before, its folders are the partitions: a
run that dies earlier has changed nothing. Catalog entries follow, and the folders that were replaced
are removed last. The log is plain Parquet, which readers of the table do not see.

A table without partitions has one, whose name is empty. The columns ``partition_by`` may be hidden
ones that only lay out the files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidelake.lake import open_partitions, partition_folder, path_exists, remove_folders

VERSION = "_version"
LOG_SCHEMA = StructType(
    [
        StructField("part", StringType()),  # the partition's folder in the table
        StructField("folder", StringType()),  # that of its version; null: no longer there
        StructField("stamp", StringType()),  # _commit_time of the rows that this commit wrote
        StructField("instant", StringType()),  # the instant that was asked for
        StructField("written", StringType()),
    ]
)


@dataclass(frozen=True)
class Touched:
    """Partitions that a run wrote, with their folders, and those that it left without rows."""

    written: list[dict] = field(default_factory=list)
    emptied: list[dict] = field(default_factory=list)
    folders: list[str] = field(default_factory=list)


def now() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")


def part_name(partition: Mapping[str, str | None]) -> str:
    return partition_folder("", partition)[1:]


def partition_of(part: str) -> dict[str, str | None]:
    """The partition of a name; the default folder stands for null."""
    pairs = (segment.split("=", 1) for segment in part.split("/") if segment)
    return {
        unquote(c): None if v == "__HIVE_DEFAULT_PARTITION__" else unquote(v) for c, v in pairs
    }


def version_log(spark: SparkSession, path: str) -> DataFrame | None:
    """The log of a table, or None if the table has none."""
    if not path_exists(spark, f"{path}/_commits"):
        return None
    return spark.read.schema(LOG_SCHEMA).parquet(f"{path}/_commits")


def current_folders(
    spark: SparkSession, path: str, where: Mapping[str, str | None] | None = None,
    parts: Iterable[str] | None = None,
) -> dict[str, str] | None:
    """Name and folder of each partition; None if the table has no log.

    ``where`` picks partitions by some of their columns, ``parts`` by name.
    """
    log = version_log(spark, path)
    if log is None:
        return None
    for column, value in (where or {}).items():
        segment = f"/{part_name({column: value})}/"
        log = log.filter(F.concat(F.lit("/"), "part", F.lit("/")).contains(segment))
    # A log is small: one task reads it, without a shuffle.
    newest = log.coalesce(1).groupBy("part").agg(F.max(F.struct("written", "folder")).alias("last"))
    rows = newest.filter("last.folder IS NOT NULL").select("part", "last.folder").collect()
    wanted = None if parts is None else set(parts)
    return {
        r.part: f"{path}/{r.folder}" for r in rows if wanted is None or r.part in wanted
    }


def read_folders(
    spark: SparkSession, path: str, schema: StructType | None, folders: Sequence[str]
) -> DataFrame:
    """The rows of some versions; no other folder is listed.

    Without a schema it is merged from these folders' files.
    """
    reader = spark.read.option("basePath", path)
    if schema is None:
        return reader.option("mergeSchema", True).parquet(*folders).drop(VERSION)
    if not folders:
        return spark.createDataFrame([], schema)
    return reader.schema(schema).parquet(*folders).select(*[f"`{c}`" for c in schema.names])


def _write(
    df: DataFrame, path: str, partition_by: Sequence[str], rebalance: bool
) -> tuple[list[dict], list[str]]:
    """Write a version of every partition in ``df``: the partitions and their folders' names."""
    run = f"v{now()}-{uuid.uuid4().hex[:8]}"
    if not partition_by:
        df.write.parquet(f"{path}/{VERSION}={run}")
        return [{}], [f"{VERSION}={run}"]
    laid = df.hint("rebalance", *[F.col(c) for c in partition_by]) if rebalance else df
    # The partitions are noted while they are written: one small row for each.
    seen = Observation()
    values = F.struct(*[F.col(c).cast("string").alias(c) for c in partition_by])
    with open_partitions(df.sparkSession):
        (
            laid.observe(seen, F.collect_set(values).alias("parts"))
            .withColumn(VERSION, F.lit(run))
            .write.mode("append").partitionBy(*partition_by, VERSION).parquet(path)
        )
    found = {part_name(row.asDict()): row.asDict() for row in seen.get["parts"] or []}
    return list(found.values()), [f"{part}/{VERSION}={run}" for part in found]


def publish(
    spark: SparkSession, path: str, entries: Sequence[tuple[str, str | None]], stamp: str = "",
    instant: str = "",
) -> None:
    """Add a commit to the log, as one file, so that all its partitions count at once."""
    written = now()
    rows = [(part, folder, stamp, instant, written) for part, folder in entries]
    append_log(spark, f"{path}/_commits", LOG_SCHEMA, rows)


def append_log(
    spark: SparkSession, path: str, schema: StructType, rows: Sequence[tuple]
) -> None:
    """Add rows to a log in one file."""
    columns = {f.name: [row[i] for row in rows] for i, f in enumerate(schema)}
    local = spark.createDataFrame(pa.table(columns), schema)
    local.coalesce(1).write.mode("append").parquet(path)


def merge_log(spark: SparkSession, folder: str) -> int:
    """Make one file of a log's many, and return how many there were.

    Every row stays, since what a log says of old commits goes on to matter: which stamps are used,
    and which commits have been taken in. The merged file is there before the others are removed, and
    readers of a log count equal rows once, so a run that dies in between has changed nothing. No
    other run may write to or read the table's log meanwhile.
    """
    log = spark.read.parquet(folder)
    files = log.inputFiles()
    if len(files) > 1:
        log.distinct().coalesce(1).write.mode("append").parquet(folder)
        remove_folders(spark, files)
    return len(files)


def replace_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
    stamp: str = "",
    instant: str = "",
    touched: Sequence[Mapping[str, str | None]] = (),
    then: Callable[[Touched], None] | None = None,
    keep_old: bool = False,
) -> Touched:
    """Replace the partitions present in ``df`` in one step; others stay untouched.

    Partitions ``touched`` that are not present any more lose their rows. ``then`` is called when
    the new partitions count and before the old folders are removed: there catalog entries are
    moved. ``keep_old`` leaves old folders to readers that still have them.
    """
    spark, df = df.sparkSession, df.drop(VERSION)
    before = current_folders(spark, path) or {}
    written, folders = _write(df, path, partition_by, rebalance)
    names = [part_name(p) for p in written]
    there = set(names)
    emptied = [dict(p) for p in touched if part_name(p) not in there]
    gone = [part_name(p) for p in emptied]
    if names or gone:
        entries = [*zip(names, folders, strict=True), *((part, None) for part in gone)]
        publish(spark, path, entries, stamp, instant)
    done = Touched(written, emptied, [f"{path}/{folder}" for folder in folders])
    if then:
        then(done)
    if not keep_old:
        remove_folders(spark, [before[part] for part in [*names, *gone] if part in before])
    return done


def remove_unpublished(spark: SparkSession, path: str, folders: Iterable[str]) -> list[str]:
    """Remove those of the version folders that the log does not hold as current; they are returned.

    ``folders`` comes from a listing of the storage, at a time when no run is writing.
    """
    counting = set((current_folders(spark, path) or {}).values())
    left = [f for f in folders if f not in counting and f"/{VERSION}=" in f]
    remove_folders(spark, left)
    return left
