"""Dense row numbers, sampling by row number, and previews."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidelake.lake import Lake, scratch_path, stage
from tidelake.operators.joins import broadcast_if_small

_FILE = "_row_file"
_ROW = "_row_index"
#: Columns that tell equal rows apart.
ADDRESS = ["_tie_file", "_tie_row"]


def with_address(df: DataFrame, is_scan: bool = False) -> DataFrame:
    """Add the place each row was read from: a hash of its file's path and its position there.

    ``is_scan`` says that ``df`` reads Parquet files, which know these places; any other frame
    is written once first.
    """
    return (df if is_scan else stage(df)).select(
        "*",
        F.xxhash64("_metadata.file_path").alias(ADDRESS[0]),
        F.col("_metadata.row_index").alias(ADDRESS[1]),
    )


def chunk_number(file: Column) -> Column:
    """Place of a written file among those of its task, of which a record limit makes several.

    It stands last in the name, after the run's id, which may hold signs that look like it.
    """
    number = F.regexp_extract(file, r"[-.]c(\d+)\.[^-]*$", 1)
    return F.coalesce(number.try_cast("bigint"), F.lit(0))


def surrogate_key(
    df: DataFrame,
    name: str = "dwid",
    order_by: Sequence[str] = (),
    unique: bool = False,
    base_of: Callable[[int], int] | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Put a dense number 1..n first, as a bigint.

    The rows are written once. A row's number is its position in its file plus the rows of all
    files before it. The files' rows are counted once, without reading a column; the counts are
    summed by thousands of files, so one task sees one row per thousand.

    Without ``order_by`` the order is arbitrary and no row is shuffled. With it, rows are
    range-sorted first. ``unique`` says that the order columns identify a row; otherwise equal
    rows are told apart by their address, so that a large group of them spreads over many
    tasks. ``base_of`` gives the number before the first one for the number of rows. ``keep`` picks
    the rows to number without moving any to another task, as joins with broadcast rows do; with an
    order it runs once, after the shuffle, and not also for the sample that finds the ranges.
    """
    if name in df.columns:
        raise ValueError(f"column {name} exists")
    columns = df.columns
    keep = keep or (lambda rows: rows)
    if order_by:
        placed = df if unique else with_address(df)
        order = [*order_by, *([] if unique else ADDRESS)]
        df = keep(placed.repartitionByRange(*order)).sortWithinPartitions(*order).select(*columns)
    else:
        df = keep(df)

    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    rows = (
        spark.read.schema(df.schema)
        .parquet(path)
        .select(
            "*",
            F.col("_metadata.file_name").alias(_FILE),
            F.col("_metadata.row_index").alias(_ROW),
        )
    )
    task = F.regexp_extract(_FILE, r"^part-(\d+)", 1).cast("bigint")
    counts = stage(
        rows.groupBy(_FILE).agg(F.count("*").alias("rows"))
        .select(_FILE, "rows", task.alias("task"), chunk_number(F.col(_FILE)).alias("chunk"))
        .withColumn("thousand", F.floor(F.col("task") / 1000))
    )
    before = Window.orderBy("thousand").rowsBetween(Window.unboundedPreceding, -1)
    thousands = counts.groupBy("thousand").agg(F.sum("rows").alias("all")).select(
        "thousand", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base")
    )
    within = Window.partitionBy("thousand").orderBy("task", "chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.withColumn(
        "since", F.coalesce(F.sum("rows").over(within), F.lit(0))
    ).join(thousands, "thousand").select(
        _FILE, (F.col("base") + F.col("since")).alias("_offset")
    )
    base = base_of(counts.agg(F.sum("rows")).first()[0] or 0) if base_of else 0
    return rows.join(broadcast_if_small(offsets), _FILE).select(
        (F.col("_offset") + F.col(_ROW) + (base + 1)).alias(name), *columns
    )


def sample_every_nth(
    df: DataFrame, n: int, order_by: Sequence[str], unique: bool = False, is_scan: bool = False
) -> DataFrame:
    """Rows n, 2n, 3n, … in the given order.

    Only the order's columns and the rows' addresses are sorted; of the rest of the columns just
    the rows found are fetched. ``is_scan`` is that of ``with_address``.
    """
    placed = with_address(df, is_scan)
    tie = [] if unique else ADDRESS
    keys = placed.select(*dict.fromkeys([*order_by, *ADDRESS]))
    numbered = surrogate_key(keys, "_number", [*order_by, *tie], unique=True)
    found = stage(numbered.filter(F.col("_number") % n == 0).select(*ADDRESS))
    return placed.join(broadcast_if_small(found), ADDRESS, "left_semi").drop(*ADDRESS)


def sample_by_key(df: DataFrame, n: int, keys: Sequence[str], pick: int = 0) -> DataFrame:
    """About every n-th key, with all of its rows: those whose hash leaves ``pick`` modulo n.

    Nothing is sorted, counted or shuffled. A key is in the sample or not whatever else the table
    holds, so the sample of a table that grows only grows, and samples of tables with the same key
    belong together. Keys are hashed by value and type; a NULL key is one key.
    """
    if not 0 <= pick < n:
        raise ValueError(f"{pick} is not a remainder modulo {n}")
    return df.filter(F.pmod(F.xxhash64(*keys), F.lit(n)) == pick)


def preview(df: DataFrame, n: int = 1, order_by: Sequence[str] = ()) -> DataFrame:
    """The first n rows; any n rows if no order is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def preview_tables(lake: Lake, names: Iterable[str], n: int = 1) -> dict[str, DataFrame]:
    """The first rows of several catalog tables."""
    return {name: preview(lake.spark.table(lake.catalog_name(name)), n) for name in names}
