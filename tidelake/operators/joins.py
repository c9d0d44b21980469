"""Equi-joins of facts with dimensions, safe for large dimensions and hot keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType, VariantType

from tidelake.lake import stage

#: A side is broadcast only if the exact size of its columns stays under this.
BROADCAST_BYTES = 64 * 1024 * 1024
#: A key is joined apart from the others if the fact has at least this many rows of it.
HOT_ROWS = 1_000_000
#: Rows of a hot key that are expected in the sample that looks for hot keys.
SAMPLED_ROWS = 1_000
#: Parts into which the rows of hot keys are dealt if the dimension's rows for them are large.
SALTS = 64


def _value_bytes(df: DataFrame, name: str) -> Column:
    """Bytes of a value: text and binary by their length, nested values as text, others 16."""
    column, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(kind, (ArrayType, MapType, StructType, VariantType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + 16
    return F.lit(16)


def size_in_bytes(df: DataFrame) -> int:
    """Size of all values plus a fixed cost per value, in one aggregation."""
    per_row = F.lit(0).cast("bigint")
    for name in df.columns:
        per_row += _value_bytes(df, name)
    return df.agg(F.sum(per_row)).first()[0] or 0


def fits(df: DataFrame, limit: int | None = None) -> bool:
    return size_in_bytes(df) <= (BROADCAST_BYTES if limit is None else limit)


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Hint a broadcast if the frame is small; else leave the join to the optimizer."""
    return F.broadcast(df) if fits(df, limit) else df


@dataclass(frozen=True)
class Dimension:
    """A dimension that was measured once, to be joined in several roles."""

    rows: DataFrame
    key: str
    small: bool
    repeated: bool


def measured(df: DataFrame, key: str, limit: int | None = None) -> Dimension:
    """Measure a dimension in one aggregation: whether it is small, and whether a key repeats."""
    per_row = F.lit(0).cast("bigint")
    for name in df.columns:
        per_row += _value_bytes(df, name)
    per_key = df.groupBy(F.col(key).alias("_key")).agg(
        F.sum(per_row).alias("_bytes"), F.count("*").alias("_rows")
    )
    size, most = per_key.agg(
        F.sum("_bytes"), F.max(F.when(F.col("_key").isNotNull(), F.col("_rows")))
    ).first()
    return Dimension(
        df, key, (size or 0) <= (BROADCAST_BYTES if limit is None else limit), (most or 0) > 1
    )


def hot_keys(df: DataFrame, key: str, at_least: int) -> DataFrame:
    """Keys with at least so many rows, as ``_hot_key`` with ``_rows``, written once.

    Candidates come from a sample in which such a key has ``SAMPLED_ROWS`` rows or so (all rows
    are looked at if the bound is small); only candidates are counted exactly. A key that the
    sample misses, which is very unlikely, is joined like the others. There are at most
    ``rows / at_least`` such keys.
    """
    known = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("_hot_key"))
    part = min(1.0, SAMPLED_ROWS / at_least)
    if part < 1:
        seen = known.sample(fraction=part, seed=1).groupBy("_hot_key").count()
        likely = stage(seen.filter(F.col("count") >= SAMPLED_ROWS // 2).select("_hot_key"))
        known = known.join(broadcast_if_small(likely), "_hot_key", "left_semi")
    counts = known.groupBy("_hot_key").agg(F.count("*").alias("_rows"))
    return stage(counts.filter(F.col("_rows") >= at_least))


def join_dimension(
    fact: DataFrame,
    dim: DataFrame | Dimension,
    key: Column,
    dim_key: str,
    take: Mapping[str, str],
    how: str = "inner",
    fact_is_table: bool = False,
    broadcast_bytes: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Join ``fact`` with the columns ``take`` (name in ``dim`` -> new name) of ``dim``.

    ``key`` may be computed from the fact's columns. Joining a dimension twice under different
    names makes it play two roles; one that was ``measured`` is not measured again. ``how`` is
    ``inner`` or ``left``.

    A small dimension is broadcast, so the fact is not shuffled. For a larger one the fact's
    hot keys (and, in a left join, its NULL keys) are joined by broadcasting only the
    dimension's rows for them, or, if these are large too, with a shuffle that deals each hot key
    to many tasks. The rest is joined with a shuffle, in which no key is hot. The fact is then read
    several times, so it is written once unless ``fact_is_table`` says that it is a plain scan.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how}")
    rows = dim.rows if isinstance(dim, Dimension) else dim
    right = rows.select(
        F.col(dim_key).alias("_dim_key"), *[F.col(c).alias(n) for c, n in take.items()]
    )
    left = fact.withColumn("_fact_key", key)
    on = F.col("_fact_key") == F.col("_dim_key")
    helpers = ("_fact_key", "_dim_key", "_hot_key", "_salt", "_dim_salt")

    def joined(a: DataFrame, b: DataFrame, on: Column = on) -> DataFrame:
        return a.join(b, on, how).drop(*helpers)

    if dim.small if isinstance(dim, Dimension) else fits(right, broadcast_bytes):
        return joined(left, F.broadcast(right))
    if how == "inner":
        left = left.filter(F.col("_fact_key").isNotNull())
    if not fact_is_table:
        left = stage(left)
    hot = hot_keys(left, "_fact_key", HOT_ROWS if hot_rows is None else hot_rows).select("_hot_key")
    if how == "inner" and hot.isEmpty():
        return joined(left, right)
    of_hot = right.join(
        broadcast_if_small(hot), F.col("_dim_key") == F.col("_hot_key"), "left_semi"
    )
    marked = left.join(broadcast_if_small(hot), F.col("_fact_key") == F.col("_hot_key"), "left")
    is_hot = F.col("_hot_key").isNotNull()
    if how == "left":
        is_hot |= F.col("_fact_key").isNull()
    if fits(of_hot):
        beside = joined(marked.filter(is_hot), F.broadcast(of_hot))
    else:
        # A row's place is the same whenever its task runs again.
        salted = marked.filter(is_hot).withColumn(
            "_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
        )
        every = of_hot.withColumn("_dim_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        beside = joined(salted, every, on & (F.col("_salt") == F.col("_dim_salt")))
    return beside.unionAll(joined(marked.filter(~is_hot), right))


def rows_without(
    stored: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    null_safe: Sequence[str] = (),
) -> DataFrame:
    """The rows of ``stored`` whose keys are not in ``batch`` (a left anti join).

    The keys of a small batch are broadcast. A larger batch is joined with a shuffle; the
    keys of a keyed table are unique, so none of them can be hot.
    """
    names = [*null_safe, *keys]
    right = broadcast_if_small(batch.select(*[F.col(c).alias(f"_batch_{c}") for c in names]))
    on = F.lit(True)
    for c in null_safe:
        on &= F.col(c).eqNullSafe(F.col(f"_batch_{c}"))
    for c in keys:
        on &= F.col(c) == F.col(f"_batch_{c}")
    return stored.join(right, on, "left_anti")
