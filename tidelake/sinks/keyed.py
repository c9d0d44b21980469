"""Upserts into keyed tables.

A keyed table is made of versions of its partitions (``tidelake.versions``). One without partitions
is laid out in buckets of its keys, so that a commit rewrites only the buckets that it touches; the
others stay where they are, and the log goes on naming them.

A commit is known by its stamp, which its rows carry: the instant, or, where an instant has been
used before and comes with other rows, the next free millisecond after it. So a file that comes late
under an old instant is a commit of its own. Whatever the order in which commits are written, a row
of a later stamp is never replaced by one of an earlier stamp.

A keyed table may have a log ``<path>/_consumed``: for each of its instants the commits of its source
that it has taken in, by their stamps.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidelake.lake import path_exists, stage
from tidelake.operators.joins import broadcast_if_small
from tidelake.operators.keyed import merge_rows, precombine, rows_that_change, stamp_commit
from tidelake.sources.tables import BUCKET, commits_of
from tidelake.versions import (
    Touched, append_log, current_folders, now, part_name, partition_of, read_folders, replace_partitions,
)

CONSUMED_LOG = StructType(
    [
        StructField("instant", StringType()),
        StructField("consumed", StringType()),
        StructField("written", StringType()),
    ]
)


def commits_to_take(
    spark: SparkSession, source: str, target: str, instant: str, after: str | None = None,
    max_commits: int | None = None,
) -> list[Row]:
    """The commits of the table at ``source`` that the one at ``target`` takes in at ``instant``.

    Those are the commits that its log does not name yet, whatever their instants. A rerun of an
    instant takes the ones that it took before, and then new ones. ``max_commits`` leaves later ones
    for the next run; ``after`` takes all commits with a later stamp instead.
    """
    commits = commits_of(spark, source)
    if after is not None:
        chosen = commits.filter(F.col("stamp") > after).select("stamp", F.lit(0).alias("order"))
    else:
        named = spark.createDataFrame([], CONSUMED_LOG)
        if path_exists(spark, f"{target}/_consumed"):
            named = spark.read.schema(CONSUMED_LOG).parquet(f"{target}/_consumed")
        by = named.groupBy("consumed").agg(F.bool_or(F.col("instant") == instant).alias("own"))
        chosen = (
            commits.select("stamp").distinct()
            .join(by, F.col("stamp") == F.col("consumed"), "left")
            .filter("consumed IS NULL OR own")
            .select("stamp", F.when(F.col("own"), 0).otherwise(1).alias("order"))
        )
    chosen = chosen.distinct()
    if max_commits is not None:
        chosen = chosen.orderBy("order", "stamp").limit(max_commits)
    return commits.join(chosen.select("stamp"), "stamp", "left_semi").collect()


def note_consumed(spark: SparkSession, path: str, instant: str, commits: Sequence[Row]) -> None:
    """Log the source's commits that the commits of ``instant`` have taken in."""
    rows = [(instant, stamp, now()) for stamp in sorted({r.stamp for r in commits})]
    if rows:
        append_log(spark, f"{path}/_consumed", CONSUMED_LOG, rows)


def free_stamp(instant: str, taken: Sequence[str]) -> str:
    """The instant, or if it is taken the first free millisecond after all that are."""
    if instant not in taken:
        return instant
    number = max(int(t[len(instant):] or 0) for t in taken if t.startswith(instant))
    if number >= 999:
        raise ValueError(f"instant {instant} has been used 1000 times")
    return f"{instant}{number + 1:03d}"


def _full_schema(
    batch: DataFrame, stored: DataFrame | None, schema: StructType | None
) -> StructType:
    """The given schema, or the batch's columns and those only the stored rows have."""
    if schema is not None:
        missing = set(batch.columns) - set(schema.names) - {BUCKET}
        if missing:
            raise ValueError(f"columns {sorted(missing)} are not in the table's schema")
        return schema
    have = set(batch.columns)
    more = [f for f in stored.schema if f.name not in have] if stored is not None else []
    return StructType(list(batch.schema) + more)


def _partitions(df: DataFrame, partition_by: Sequence[str]) -> dict[str, dict]:
    """The partitions that occur, by name: one small row for each, of which a batch has few."""
    text = [F.col(c).cast("string").alias(c) for c in partition_by]
    rows: list[Row] = df.select(*text).distinct().collect()
    return {part_name(row.asDict()): row.asDict() for row in rows}


def _upsert(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    precombine_field: str,
    partition_by: Sequence[str],
    instant: str,
    schema: StructType | None,
    global_key: bool,
    keep_newer: bool,
    then: Callable[[Touched], None] | None,
    keep_old: bool,
) -> Touched:
    spark = batch.sparkSession
    scope = () if global_key else partition_by
    log = commits_of(spark, path).coalesce(1).select("stamp", "instant").distinct().collect()
    taken = [r.stamp for r in log if r.instant == instant]
    stamp = free_stamp(instant, taken)
    later = any(r.stamp > stamp for r in log)
    batch = stage(precombine(batch, keys, precombine_field, scope))
    _full_schema(batch, None, schema)
    folders = current_folders(spark, path) or {}
    touched = _partitions(batch, partition_by)
    if global_key and folders:
        names = StructType(
            [f for f in (schema or batch.schema) if f.name in {*keys, *partition_by}]
        )
        batch_keys = broadcast_if_small(batch.select(*keys))
        everything = read_folders(spark, path, names, sorted(folders.values()))
        holding = everything.join(batch_keys, list(keys), "left_semi")
        touched |= _partitions(holding, partition_by)
    there = sorted(folders[part] for part in touched if part in folders)
    merged = stamp_commit(batch, stamp)
    if there:
        stored = read_folders(spark, path, _stored_schema(batch, path, there, schema, partition_by), there)
        if taken or later:
            # A rerun leaves equal rows alone, and a late commit the rows of later ones.
            batch = stage(
                rows_that_change(batch, stored, [*scope, *keys], stamp, bool(taken))
            )
            own = _partitions(batch, partition_by)
            if not own:
                return Touched()
            if not global_key:
                touched = own
                there = sorted(folders[part] for part in touched if part in folders)
                stored = read_folders(spark, path, stored.schema, there)
        batch = stamp_commit(batch, stamp)
        columns = [c for c in _full_schema(batch, stored, schema).names if c != BUCKET]
        newer = precombine_field if keep_newer else None
        merged = merge_rows(stored, batch, keys, scope, newer).select(
            *columns, *(c for c in partition_by if c not in columns)
        )
    return replace_partitions(
        merged, path, partition_by, rebalance=True, stamp=stamp, instant=instant,
        touched=list(touched.values()) if global_key else (), then=then, keep_old=keep_old,
    )


def _stored_schema(
    batch: DataFrame, path: str, folders: Sequence[str], schema: StructType | None,
    partition_by: Sequence[str],
) -> StructType:
    """The table's schema, or else that of the files, with the batch's types of the partitions."""
    names = set(partition_by)
    if schema is None:
        schema = read_folders(batch.sparkSession, path, None, folders).schema
    kept = [batch.schema[f.name] if f.name in names else f for f in schema]
    return StructType(kept + [batch.schema[c] for c in partition_by if c not in schema.names])


def upsert_partitioned(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    precombine_field: str,
    partition_by: Sequence[str],
    instant: str,
    schema: StructType | None = None,
    global_key: bool = False,
    keep_newer: bool = False,
    then: Callable[[Touched], None] | None = None,
) -> Touched:
    """Upsert by (partition, key); only the partitions the batch touches are rewritten.

    Of the table only those partitions' folders are listed and read, however many they are, and
    all of them are switched to their new versions in one step. A key is unique within a partition
    only, unless ``global_key``, which also removes the batch's keys from other partitions; to find
    them the whole table's keys are read. ``keep_newer`` keeps a stored row whose precombine value
    is larger. ``schema`` names all columns; without it they come from the touched files.

    A rerun of an instant replaces the rows that differ; the same batch changes nothing. ``then``
    is called when the new rows count and before the old files are removed.
    """
    return _upsert(
        batch, path, keys, precombine_field, partition_by, instant, schema, global_key,
        keep_newer, then, keep_old=False,
    )


def bucket(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key: ``3-of-16``. Keys are taken as text, so their type may widen."""
    number = F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in keys]), F.lit(buckets))
    return F.concat(number.cast("string"), F.lit(f"-of-{buckets}"))


def upsert_unpartitioned(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    precombine_field: str,
    instant: str,
    schema: StructType | None = None,
    keep_newer: bool = False,
    buckets: int = 1,
    keep_old: bool = True,
    then: Callable[[Touched], None] | None = None,
) -> Touched:
    """Upsert by key into a table without partitions; only the keys' buckets are rewritten.

    The first commit fixes the number of buckets. One is right for a small dimension; a bucket of
    a large table should be what one task can write. Replaced versions stay for readers that have
    them open, unless ``keep_old`` is false.
    """
    known = commits_of(batch.sparkSession, path).select("part").first()
    if known:
        buckets = int(partition_of(known.part)[BUCKET].split("-")[-1])
    return _upsert(
        batch.withColumn(BUCKET, bucket(keys, buckets)), path, keys, precombine_field, [BUCKET],
        instant, schema, False, keep_newer, then, keep_old,
    )
