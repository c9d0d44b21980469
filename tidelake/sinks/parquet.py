"""Parquet and CSV writes: partition overwrite, full overwrite, append and landing."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tidelake.lake import Lake, path_exists
from tidelake.schemas import TABLES
from tidelake.versions import Touched, current_folders, partition_of, replace_partitions


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], rebalance: bool = True,
    then: Callable[[Touched], None] | None = None,
) -> Touched:
    """Replace the partitions present in ``df``; others stay untouched.

    Readers find either all of the old partitions or all of the new ones, also when the driver dies.
    ``rebalance`` gathers each partition's rows so that it gets few files: adaptive execution splits
    a partition that is too large for one task and merges small ones. ``rebalance=False`` skips that
    shuffle where every task holds few partitions anyway, as in the load of one month. ``then`` is
    called when the new partitions count and before the old files are removed.
    """
    return replace_partitions(df, path, partition_by, rebalance, then=then)


def append_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), rebalance: bool = False
) -> None:
    """Add rows to plain folders; a rerun adds them again. Not for a table with versions."""
    if path_exists(df.sparkSession, f"{path}/_commits"):
        raise ValueError(f"the rows of {path} are in versions, which are replaced and not added to")
    laid = df.hint("rebalance", *[F.col(c) for c in partition_by]) if rebalance else df
    writer = laid.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def overwrite_table(
    df: DataFrame, path: str, then: Callable[[Touched], None] | None = None
) -> Touched:
    """Replace a whole unpartitioned dimension in one step.

    The result is first written aside, so ``df`` may read the table it replaces, and a query or a
    driver that fails leaves the table as it was.
    """
    have = current_folders(df.sparkSession, path) or {}
    return replace_partitions(df, path, touched=[partition_of(p) for p in have], then=then)


def replace_landing(df: DataFrame, path: str, header: bool = True) -> None:
    """Empty a raw folder and land new rows as CSV; a single ``value`` column lands as lines."""
    writer = df.write.mode("overwrite")
    if df.columns == ["value"]:
        writer.text(path)
    else:
        writer.option("header", header).csv(path)


def land_domain(lake: Lake, domain: str, feeds: Mapping[str, DataFrame]) -> None:
    """Replace a domain's whole raw area: a folder without new rows is left empty."""
    names = [n for n in TABLES if n.startswith(f"stg.{domain}_")]
    unknown = set(feeds) - set(names)
    if unknown:
        raise ValueError(f"no raw tables of {domain}: {sorted(unknown)}")
    for name in names:
        nothing = lake.spark.createDataFrame([], lake.schema(name))
        replace_landing(feeds.get(name, nothing), lake.path(name))
