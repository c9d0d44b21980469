"""Number ranges: every part of a table that is numbered by itself has one of its own.

The log ``<table>/_numbers`` holds a row for each range that was ever given out: the part, the number
before its first one, and how many numbers it has. Ranges never overlap, so numbers stay unique over
the table whatever parts are built again. One build of a table runs at a time.
"""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidelake.lake import path_exists
from tidelake.versions import append_log

RANGE_LOG = StructType(
    [
        StructField("part", StringType()),
        StructField("base", LongType()),
        StructField("room", LongType()),
    ]
)


def base_of_range(spark: SparkSession, path: str, part: str, n: int) -> int:
    """The number before the first of n numbers for a part of the table.

    A part that is built again gets the range that it had, if there is room for its rows; one that
    has outgrown it gets a new range after all others.
    """
    folder, base = f"{path}/_numbers", 0
    if path_exists(spark, folder):
        log = spark.read.schema(RANGE_LOG).parquet(folder)
        own = F.when((F.col("part") == part) & (F.col("room") >= n), F.col("base"))
        end, fitting = log.coalesce(1).agg(F.max(F.col("base") + F.col("room")), F.min(own)).first()
        if fitting is not None:
            return fitting
        base = end or 0
    append_log(spark, folder, RANGE_LOG, [(part, base, n)])
    return base
