"""Sharding along a Hilbert curve: near-equal runs whose files prune in several dimensions.

Each dimension is quantised by its own quantiles to ``2**bits`` steps, the steps of a row become
one index on the Hilbert curve, rows are sorted by it, and the sorted run is cut into shards of
near-equal bytes. Files hold consecutive pieces of the run, so the smallest and largest value of
every dimension in a file lie close together. The run is dealt to tasks in pieces of near-equal
bytes, so long rows that lie next to each other do not make a large task.

Nulls and edge cases: a null text has no bytes; a null dimension has step 0, before all values.
Rows of one curve cell are ordered by a hash of id and text, equal ones by the place they were read
from, so a hot cell, even one of equal rows, spreads over many tasks and shards. A row larger than
a shard's share leaves the next shard smaller, or empty. An empty table has no files and gives no
rows. Columns whose names would clash with those of the layout are left as they are.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, NumericType, StringType

from tidelake.lake import scratch_path
from tidelake.llm.common import free_name, reads_files, with_place
from tidelake.operators.joins import broadcast_if_small

#: Bytes of text in a piece of the run, which one task writes.
PIECE_BYTES = 32 << 20
#: Pieces at most, as each has a key on the driver; beyond it they grow with the table.
MOST_PIECES = 50_000
#: Accuracy of the quantiles: their rank is off by at most 1 / QUANTILE_ACCURACY.
QUANTILE_ACCURACY = 10_000


def hilbert_index(steps: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """Position on the Hilbert curve of points with coordinates below ``2**bits``."""
    x = [np.asarray(s, np.int64).copy() for s in steps]
    n, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:  # undo the rotations and reflections of the sub-cubes, from the largest on
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap if i else 0
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = top
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | (((x[i] ^ flip) >> bit) & 1)
    return index


def _dimension(df: DataFrame, dim: str | tuple[str, Column]) -> tuple[Column, bool]:
    """A dimension as text, or as a number that orders rows as the column does, and which it is."""
    if not isinstance(dim, str):
        return dim[1].cast("double"), False
    kind, column = df.schema[dim].dataType, F.col(f"`{dim}`")
    if isinstance(kind, StringType):
        return column, True
    if isinstance(kind, NumericType):
        return column.cast("double"), False
    return F.unix_micros(column.cast("timestamp")).cast("double"), False


def curve_column(df: DataFrame, dims: Sequence[str | tuple[str, Column]], bits: int) -> Column:
    """The Hilbert index of each row of ``df``. A dimension is a column or a named number.

    The step of a value is the number of quantiles up to it, so a frequent value leaves as many
    steps free as it has rows, and one far away from the others takes no more than its own.
    """
    columns = [_dimension(df, d) for d in dims]
    ranks = [i / 2**bits for i in range(1, 2**bits)]
    numbers = [
        F.percentile_approx(v, ranks, QUANTILE_ACCURACY).alias(f"q{i}")
        for i, (v, is_text) in enumerate(columns) if not is_text
    ]
    found = df.agg(*numbers).first() if numbers else {}
    # Less than 2**bits values per dimension.
    bounds = []
    for i, (value, is_text) in enumerate(columns):
        if is_text:
            counts = df.groupBy(value.alias("value")).agg(F.count("*").alias("n"))
            cuts = cut_keys(counts.filter("value IS NOT NULL"), ["value"], "n", 2**bits)
            bounds.append(np.array([cut[0] for cut in cuts], object))
        else:
            bounds.append(np.array(found[f"q{i}"] or [], float))

    @F.pandas_udf(LongType())
    def index(*series: pd.Series) -> pd.Series:
        steps = []
        for values, at in zip(series, bounds, strict=True):
            empty = values.isna().to_numpy()
            if at.dtype == object:
                values = values.mask(empty, "").to_numpy(object)
            else:
                values = values.to_numpy(float, na_value=np.nan)
            step = np.minimum(np.searchsorted(at, values, side="right") + 1, 2**bits - 1)
            steps.append(np.where(empty, 0, step))
        return pd.Series(hilbert_index(steps, bits))

    return index(*[column for column, _ in columns])


def file_number(name: Column) -> Column:
    """Place of a written file in the order of the rows: its task, and its number in the task."""
    task = F.regexp_extract(name, r"^part-(\d+)", 1).cast("bigint")
    chunk = F.coalesce(F.regexp_extract(name, r"[-.]c(\d+)\.", 1).try_cast("bigint"), F.lit(0))
    return task * 1_000_000 + chunk


@dataclass(frozen=True)
class Layout:
    """Shards written at ``path``: folders ``<shard>=0`` …, each file a piece of the sorted run."""

    path: str
    shard: str
    curve: str

    def rows(self, df: DataFrame) -> DataFrame:
        """The files' rows with shard, curve index and ``slot``, the position in the shard.

        ``df`` is the frame that was written; only its columns' names and types are used.
        """
        slot, file, part, before = (free_name(df, n) for n in ("slot", "_file", "_part", "_before"))
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        kinds += f", `{self.curve}` bigint, `{self.shard}` int"
        files = df.sparkSession.read.schema(kinds).parquet(self.path)
        rows = files.select(
            "*",
            file_number(F.col("_metadata.file_name")).alias(file),
            F.col("_metadata.row_index").alias(slot),
        )
        earlier = Window.partitionBy(self.shard).orderBy(file).rowsBetween(
            Window.unboundedPreceding, -1
        )
        sizes = (
            rows.groupBy(self.shard, file).agg(F.count("*").alias(part))
            .withColumn(before, F.coalesce(F.sum(part).over(earlier), F.lit(0))).drop(part)
        )
        # One row of three numbers per file.
        return rows.join(broadcast_if_small(sizes), [self.shard, file]).withColumn(
            slot, F.col(before) + F.col(slot)
        ).select(*[f"`{c}`" for c in df.columns], self.shard, self.curve, slot)


def cut_keys(
    keys: DataFrame, order: Sequence[str], size: str, parts: int, part_size: int | None = None
) -> list[tuple]:
    """The first key of each piece but the first: rows before it hold piece / pieces of all sizes.

    There are ``parts`` pieces, or a multiple of it so that a piece has ``part_size`` at most as
    far as ``MOST_PIECES`` allows. A row with several cuts gives its key for each. ``keys`` is
    sorted into files; only files in which a cut falls are summed row by row.
    """
    spark = keys.sparkSession
    path = scratch_path(spark)
    keys.orderBy(*order).write.parquet(path)
    rows = spark.read.schema(keys.schema).parquet(path).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at")
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = (  # one row per file
        rows.groupBy("_file").agg(F.sum(size).alias("_sum"))
        .withColumn("_part", file_number(F.col("_file")))
        .withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    )
    total = sums.agg(F.sum("_sum")).first()[0]
    if not total:
        return []
    pieces = parts
    if part_size:
        pieces *= max(1, min(-(-total // (parts * part_size)), MOST_PIECES // parts))

    def cuts(begin: Column, length: Column) -> Column:
        """Number of cuts that fall into a stretch of the run."""
        most = F.lit(total).cast("decimal(20,0)")

        def passed(at: Column) -> Column:
            return F.greatest(F.ceil(at * F.lit(pieces) / most).cast("bigint"), F.lit(1))

        return passed(begin + length) - passed(begin)

    within = Window.partitionBy("_file").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    some = sums.filter(cuts(F.col("_before"), F.col("_sum")) > 0)
    found = rows.join(F.broadcast(some), "_file").withColumn(
        "_cum", F.col("_before") + F.coalesce(F.sum(size).over(within), F.lit(0))
    ).withColumn("_cuts", cuts(F.col("_cum"), F.col(size))).filter("_cuts > 0")
    chosen = sorted(found.select("_cum", "_cuts", *order).collect(), key=lambda r: r["_cum"])
    return [tuple(row)[2:] for row in chosen for _ in range(row["_cuts"])]


def piece_column(cuts: Sequence[tuple[int, ...]], key: Sequence[Column]) -> Column:
    """The piece of each row: the number of cuts up to its key, whose columns are integers."""
    first = np.array([cut[0] for cut in cuts], np.int64)
    cuts = [tuple(cut) for cut in cuts]

    @F.pandas_udf(IntegerType())
    def piece(*series: pd.Series) -> pd.Series:
        columns = [s.to_numpy(np.int64) for s in series]
        low = np.searchsorted(first, columns[0], side="left")
        high = np.searchsorted(first, columns[0], side="right")
        near = np.flatnonzero(low < high)  # rows of a cell in which a cut falls
        keys = zip(*[c[near].tolist() for c in columns])
        low[near] = [
            bisect_right(cuts, own, i, j)
            for own, i, j in zip(keys, low[near].tolist(), high[near].tolist())
        ]
        return pd.Series(low.astype(np.int32))

    return piece(*key)


def write_shards(
    df: DataFrame,
    dims: Sequence[str | tuple[str, Column]],
    shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits: int = 8,
    path: str | None = None,
) -> Layout:
    """Write ``df`` in ``shards`` runs of the curve with near-equal bytes.

    The size of a row is the bytes of its text and one. ``dims`` are two columns or more, or
    pairs of a name and a number. The keys alone are sorted first, to find the cuts between pieces
    of near-equal bytes; a shard is a number of pieces. Then each piece goes to a task of its own.
    A frame that does not read files is written once first, for the place of each row.
    """
    rows, place = with_place(df, reads_files(df))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    curve, tie = free_name(df, "curve"), free_name(df, "_tie")
    shard, piece = free_name(df, "shard"), free_name(df, "_piece")
    keyed = rows.withColumn(curve, curve_column(df, dims, bits)).withColumn(
        tie, F.xxhash64(f"`{id_col}`", text)
    )
    key = [curve, tie, *place]
    size = (F.octet_length(text) + 1).cast("bigint")
    keys = keyed.select(*[f"`{c}`" for c in key], size.alias("_size"))
    cuts = cut_keys(keys, key, "_size", shards, PIECE_BYTES)
    pieces = len(cuts) + 1
    number = piece_column(cuts, [F.col(f"`{c}`") for c in key])
    path = path or scratch_path(df.sparkSession)
    (
        keyed.withColumn(piece, number).repartitionById(pieces, f"`{piece}`")
        .withColumn(shard, F.floor(F.col(f"`{piece}`") * shards / pieces).cast("int"))
        .sortWithinPartitions(*[f"`{c}`" for c in [shard, *key]])
        .drop(tie, piece, *place)
        .write.partitionBy(shard).option("compression", "zstd").parquet(path)
    )
    return Layout(path, shard, curve)
