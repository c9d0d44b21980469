"""Small helpers of the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelake.lake import stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores in front as long as a column has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def reads_files(df: DataFrame) -> bool:
    """Whether a frame is made of rows of files, as a table that was just read is."""
    try:
        df.select(df.metadataColumn("_metadata")["row_index"])
    except AnalysisException:
        return False
    return True


def with_place(df: DataFrame, is_scan: bool = False) -> tuple[DataFrame, list[str]]:
    """The rows with the place each was read from, which tells equal rows apart, and its columns.

    ``is_scan`` says that ``df`` reads Parquet files; any other frame is written once first.
    """
    names = [free_name(df, "place_file"), free_name(df, "place_row")]
    rows = df if is_scan else stage(df)
    read_from = rows.metadataColumn("_metadata")
    return rows.select(
        "*", F.xxhash64(read_from["file_path"]).alias(names[0]),
        read_from["row_index"].alias(names[1]),
    ), names


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column, null as empty, and each row's offset in them (rows + 1)."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def per_process(spark: SparkSession) -> Callable[[str, Callable], object]:
    """A function that gives a Python worker's own object of a name, made at the first use.

    A broadcast value stays with a worker from task to task; here it is a dictionary to fill.
    """
    kept = spark.sparkContext.broadcast({})

    def get(name: str, make: Callable) -> object:
        if name not in kept.value:
            kept.value[name] = make()
        return kept.value[name]

    return get


def slices(
    batches: Iterable[pa.RecordBatch], text: str, most_bytes: int
) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of whole rows with about so many bytes of text at most.

    A longer row is a piece of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = utf8(batch.column(text))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(at, at[begin] + most_bytes, side="right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start .. start + length of every range, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def text_array(data: np.ndarray, at: np.ndarray) -> pa.LargeStringArray:
    """Texts that lie one after the other in ``data``, without a copy."""
    return pa.LargeStringArray.from_buffers(
        len(at) - 1, pa.py_buffer(np.ascontiguousarray(at, np.int64)), pa.py_buffer(data)
    )
