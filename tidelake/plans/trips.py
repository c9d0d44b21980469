"""Trip feeds: raw CSV -> ods partitions -> the same files as dwh partitions."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from tidelake.lake import Lake
from tidelake.operators.project import star_append
from tidelake.schemas import TRIP_FEEDS
from tidelake.sinks.catalog import attach_partition, has_partition
from tidelake.sinks.parquet import overwrite_partitions
from tidelake.sources.csv import load_csv_as_view
from tidelake.sources.tables import partitioned_parquet_scan
from tidelake.versions import Touched, current_folders


def month_of(year: int, month: int) -> dict[str, str]:
    return {"year": f"{year:04d}", "month": f"{month:02d}"}


def load_feed(lake: Lake, feed: str, year: int, month: int, header: bool = True) -> None:
    """Load a feed's landed CSV into the ods month.

    The month is a constant, so every task writes one partition and nothing is shuffled. A dwh month
    that is published already goes on showing the same files as the ods month.
    """
    stg, ods = f"stg.tlc_{feed}_trip", f"ods.tlc_{feed}_trip"
    partition = month_of(year, month)
    raw = load_csv_as_view(lake.spark, stg, lake.path(stg), lake.schema(stg), header)

    def attach(touched: Touched) -> None:
        for folder in touched.folders:
            attach_partition(lake.spark, lake.catalog_name(ods), partition, folder)
            dwh = lake.catalog_name(f"dwh.tlc_{feed}_trip")
            if lake.spark.catalog.tableExists(dwh) and has_partition(lake.spark, dwh, partition):
                attach_partition(lake.spark, dwh, partition, folder)

    overwrite_partitions(
        star_append(raw, partition), lake.path(ods), lake.table(ods).partition_by,
        rebalance=False, then=attach,
    )


def publish_feed(lake: Lake, feed: str, year: int, month: int) -> None:
    """Make the files of the ods month the dwh month, without a copy."""
    partition = month_of(year, month)
    folders = current_folders(lake.spark, lake.path(f"ods.tlc_{feed}_trip"), partition) or {}
    for folder in folders.values():
        attach_partition(
            lake.spark, lake.catalog_name(f"dwh.tlc_{feed}_trip"), partition, folder
        )


def ingest_feed(lake: Lake, feed: str, year: int, month: int, header: bool = True) -> None:
    load_feed(lake, feed, year, month, header)
    publish_feed(lake, feed, year, month)


def trip_ingest_chain(
    lake: Lake, year: int, month: int, feeds: Sequence[str] = TRIP_FEEDS, header: bool = True
) -> None:
    """All feeds of a month. They do not depend on each other, so their jobs run side by side."""
    with ThreadPoolExecutor(len(feeds)) as pool:
        for done in [pool.submit(ingest_feed, lake, f, year, month, header) for f in feeds]:
            done.result()


def dwh_trips(lake: Lake, feed: str) -> DataFrame:
    """A dwh table read by path: the ods files under the dwh schema."""
    return partitioned_parquet_scan(
        lake.spark, lake.path(f"ods.tlc_{feed}_trip"), lake.schema(f"dwh.tlc_{feed}_trip")
    )
