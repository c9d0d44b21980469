"""Rows of keyed tables: precombine, commit stamps and incremental reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from tidelake.lake import stage
from tidelake.operators.joins import broadcast_if_small, rows_without
from tidelake.schemas import COMMIT_TIME


def _required(df: DataFrame, key: str) -> Column:
    error = F.raise_error(F.lit(f"record key {key} is NULL")).cast(df.schema[key].dataType)
    return F.coalesce(F.col(key), error).alias(key)


def _ordered(kind: DataType) -> bool:
    """Whether values of a type can be compared."""
    if isinstance(kind, StructType):
        return all(_ordered(f.dataType) for f in kind)
    if isinstance(kind, ArrayType):
        return _ordered(kind.elementType)
    return not isinstance(kind, (MapType, VariantType))


def comparable(df: DataFrame, column: str) -> Column:
    """The column, or its JSON text if its type cannot be compared."""
    if _ordered(df.schema[column].dataType):
        return F.col(f"`{column}`")
    return F.to_json(F.struct(f"`{column}`"), {"ignoreNullFields": "false"})


def precombine(
    batch: DataFrame,
    keys: Sequence[str],
    precombine_field: str,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """One row per partition and key: the one with the largest precombine value.

    Ties are broken by the remaining columns in their order, largest first; columns that cannot be
    compared, such as maps, count by their JSON text. A NULL key is an error. The maximum is taken
    before the shuffle too, so many copies of one key cost no more than one row per task.
    """
    group = [c for c in dict.fromkeys([*partition_by, *keys])]
    rest = [c for c in batch.columns if c not in group and c != precombine_field]
    ranked = [precombine_field, *rest] if precombine_field not in group else rest
    checked = batch.select(
        *[_required(batch, c) if c in keys else F.col(c) for c in batch.columns]
    )
    if all(_ordered(batch.schema[c].dataType) for c in ranked):
        newest = F.max(F.struct(*ranked))
    else:
        order = F.struct(*[comparable(batch, c).alias(f"_{i}") for i, c in enumerate(ranked)])
        newest = F.max_by(F.struct(*ranked), order)
    found = checked.groupBy(*group).agg(newest.alias("_newest"))
    return found.select(*group, "_newest.*").select(*batch.columns)


def stamp_commit(batch: DataFrame, instant: str) -> DataFrame:
    """Mark rows as written by the commit ``instant`` (yyyyMMddHHmmss)."""
    return batch.withColumn(COMMIT_TIME, F.lit(instant))


def older_than_stored(
    batch: DataFrame, stored: DataFrame, keys: Sequence[str], field: str,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """The keys of the batch rows whose ``field`` is below that of the stored row."""
    names = [*partition_by, *keys]
    right = broadcast_if_small(
        batch.select(*[F.col(c).alias(f"_batch_{c}") for c in [*names, field]])
    )
    on = F.col(field) > F.col(f"_batch_{field}")
    for c in partition_by:
        on &= F.col(c).eqNullSafe(F.col(f"_batch_{c}"))
    for c in keys:
        on &= F.col(c) == F.col(f"_batch_{c}")
    return stored.select(*names, field).join(right, on, "left_semi").select(*names)


def rows_that_change(
    batch: DataFrame, stored: DataFrame, names: Sequence[str], stamp: str, rerun: bool
) -> DataFrame:
    """The batch without rows whose stored row has a later stamp or, in a rerun, equals them.

    ``names`` identify a row; partitions among them may be NULL.
    """
    rest = [c for c in batch.columns if c not in names and c in stored.columns]
    right = stored.select(
        *[F.col(f"`{c}`").alias(f"_stored_{i}") for i, c in enumerate(names)],
        F.col(COMMIT_TIME).alias("_stored_time"),
        *[comparable(stored, c).alias(f"_stored_value_{i}") for i, c in enumerate(rest)],
    )
    on = F.lit(True)
    for i, c in enumerate(names):
        on &= F.col(f"`{c}`").eqNullSafe(F.col(f"_stored_{i}"))
    same = F.lit(rerun and len(rest) + len(names) == len(batch.columns))
    for i, c in enumerate(rest):
        same &= comparable(batch, c).eqNullSafe(F.col(f"_stored_value_{i}"))
    superseded = F.col("_stored_time").isNotNull() & ((F.col("_stored_time") > stamp) | same)
    joined = batch.join(right, on, "left")
    return joined.filter(~F.coalesce(superseded, F.lit(False))).select(
        *[f"`{c}`" for c in batch.columns]
    )


def merge_rows(
    stored: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    newer_than: str | None = None,
) -> DataFrame:
    """Stored rows the batch does not replace, and the batch.

    The batch wins over the stored row; with ``newer_than`` only if its value in that column
    is not smaller.
    """
    if newer_than:
        losers = stage(older_than_stored(batch, stored, keys, newer_than, partition_by))
        batch = rows_without(batch, losers, keys, partition_by)
    kept = rows_without(stored, batch, keys, partition_by)
    return kept.unionByName(batch, allowMissingColumns=True)


def latest_commit(df: DataFrame) -> str | None:
    return df.agg(F.max(COMMIT_TIME)).first()[0]


def incremental_scan(
    df: DataFrame, after: str, max_commits: int | None = None, where: Column | None = None
) -> DataFrame:
    """Rows written by the commits after ``after``, at most the first ``max_commits`` of them.

    ``where``, a condition on partition columns, restricts the scan to some partitions. The
    commits found become one upper bound, so both bounds reach the Parquet scan as filters.
    """
    rows = df if where is None else df.filter(where)
    rows = rows.filter(F.col(COMMIT_TIME) > after)
    if max_commits is None:
        return rows
    commits = rows.select(COMMIT_TIME).distinct().orderBy(COMMIT_TIME).limit(max_commits)
    last = commits.agg(F.max(COMMIT_TIME)).first()[0]
    return rows.filter(F.col(COMMIT_TIME) <= last) if last is not None else rows.limit(0)


def scan_since_latest_commit(df: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Rows of commits after the latest one of ``known`` (by default of ``df`` itself).

    The latest commit is excluded, so a table without further commits gives no rows.
    """
    latest = latest_commit(df if known is None else known)
    return incremental_scan(df, latest) if latest is not None else df
