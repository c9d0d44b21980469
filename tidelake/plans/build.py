"""The monthly build of all layers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, functions as F

from tidelake.lake import Lake, path_exists, scratch_scope, stage
from tidelake.operators.dimensions import date_hour_dimension, date_hour_dimension_of
from tidelake.plans.geo import conform_zones, geo_dimension_chain, load_zones, publish_zones
from tidelake.plans.mart import (
    HOURS, UNION, ZONES, build_union_trip, build_wide_trip, registered,
)
from tidelake.plans.trips import load_feed, month_of, publish_feed, trip_ingest_chain
from tidelake.schemas import TABLES, TRIP_FEEDS
from tidelake.sinks.catalog import create_tables
from tidelake.sinks.parquet import overwrite_partitions
from tidelake.sources.csv import csv_scan_with_schema
from tidelake.sources.tables import partitioned_parquet_scan
from tidelake.versions import current_folders, partition_of, read_folders, replace_partitions


def _landed_hours(lake: Lake, header: bool = True) -> DataFrame | None:
    name = "stg.pub_dim_date"
    if not path_exists(lake.spark, lake.path(name)):
        return None
    return csv_scan_with_schema(lake.spark, lake.path(name), lake.schema(name), header)


def _write_hours(lake: Lake, hours: DataFrame) -> None:
    """Replace the years in ``hours``."""
    overwrite_partitions(
        hours.select(*lake.schema(HOURS).names), lake.path(HOURS), lake.table(HOURS).partition_by,
        then=registered(lake, HOURS),
    )


def build_date_dimension(
    lake: Lake, months_in: DataFrame | None = None, column: str = "pickup_datetime",
    hours: tuple[str, str] | None = None,
) -> None:
    """Add hours to the dimension: those of all months in the data, and a range.

    The calendar lies in years. Only hours that a year lacks are added to it, and only the years
    that gain some are written; a run that finds all hours there writes nothing. Hours that are
    stored stay as they are, but a landed calendar goes before them and before generated ones.
    """
    spark, names = lake.spark, lake.schema(HOURS).names
    landed, found = _landed_hours(lake), []
    if months_in is not None:
        found.append(date_hour_dimension_of(months_in, column))
    if hours is not None:
        found.append(date_hour_dimension(spark, *hours))
    if landed is not None:
        found.insert(0, landed)
    if not found:
        return
    ranked = [
        df.filter("dwid IS NOT NULL").select(
            *names, F.lit(landed is not None and rank == 0).alias("_landed"), F.lit(rank).alias("_rank")
        )
        for rank, df in enumerate(found)
    ]
    value = F.struct("_rank", "_landed", *[c for c in names if c != "dwid"])
    with scratch_scope(spark):
        wanted = stage(
            reduce(DataFrame.unionAll, ranked).groupBy("dwid").agg(F.min(value).alias("_first"))
            .select("dwid", "_first.*").drop("_rank")
        )
        folders = current_folders(spark, lake.path(HOURS)) or {}
        years = {str(r.year) for r in wanted.select("year").distinct().collect()}
        stored = read_folders(
            spark, lake.path(HOURS), lake.schema(HOURS),
            [folder for part, folder in folders.items() if part.split("=")[1] in years],
        )
        # Of the hours wanted, those that are not stored like that.
        same = F.col("w.dwid") == F.col("s.dwid")
        for c in names:
            same &= ~F.col("w._landed") | F.col(f"w.{c}").eqNullSafe(F.col(f"s.{c}"))
        new = stage(wanted.alias("w").join(stored.alias("s"), same, "left_anti").select(*names))
        gaining = [r.year for r in new.select("year").distinct().collect()]
        if gaining:
            kept = stored.filter(F.col("year").isin(gaining)).join(new, "dwid", "left_anti")
            _write_hours(lake, kept.select(*names).unionByName(new))


def load_date_dimension(lake: Lake, header: bool = True) -> None:
    """Replace the dimension with the landed CSV of hours: years that it lacks go, too."""
    landed = _landed_hours(lake, header)
    if landed is None:
        raise ValueError("no calendar has landed")
    have = current_folders(lake.spark, lake.path(HOURS)) or {}
    replace_partitions(
        landed, lake.path(HOURS), lake.table(HOURS).partition_by, rebalance=True,
        touched=[partition_of(part) for part in have], then=registered(lake, HOURS),
    )


def catalog_feeds(lake: Lake) -> dict[str, DataFrame]:
    """The dwh trip tables."""
    return {
        feed: lake.spark.table(lake.catalog_name(f"dwh.tlc_{feed}_trip")) for feed in TRIP_FEEDS
    }


def current_zones(lake: Lake) -> DataFrame:
    return partitioned_parquet_scan(lake.spark, lake.path(ZONES), lake.schema(ZONES))


def jobs(
    lake: Lake,
    year: int,
    month: int,
    instant: str,
    after: str | None = None,
    ts: int | None = None,
    max_commits: int | None = None,
    global_key: bool = False,
) -> dict[str, Callable[[], None]]:
    """Each table's job by name, to run single steps of a month in any order.

    ``<layer>_<domain>_create`` creates the tables of a domain, ``…_<table>_create`` one of
    them; ``…_insert``, ``…_upsert`` and ``…_overwrite`` fill a table.
    """
    partition = month_of(year, month)
    found: dict[str, Callable[[], None]] = {}
    # The names of the jobs, from the names of the layers and tables.
    for name, table in TABLES.items():
        if name.startswith("stg.") or table.keys:
            continue
        job = name.replace(".", "_")
        domain = "_".join(job.split("_")[:2])
        same = [n for n in TABLES if n.replace(".", "_").startswith(f"{domain}_")]
        same = [n for n in same if not TABLES[n].keys]
        found[f"{domain}_create"] = partial(create_tables, lake, same, True)
        found[f"{job}_create"] = partial(create_tables, lake, [name], True)
    for feed in TRIP_FEEDS:
        found[f"ods_tlc_{feed}_trip_insert"] = partial(load_feed, lake, feed, year, month)
        found[f"dwh_tlc_{feed}_trip_insert"] = partial(publish_feed, lake, feed, year, month)

    def union() -> None:
        build_union_trip(lake, catalog_feeds(lake), partition)

    def wide() -> None:
        build_wide_trip(lake, current_zones(lake), partition)

    found["ods_geo_taxi_zone_insert"] = partial(load_zones, lake, year, month, instant, ts)
    found["dwh_geo_taxi_zone_upsert"] = partial(
        conform_zones, lake, instant, after, max_commits
    )
    found["dmt_geo_dim_taxi_zone_upsert"] = partial(
        publish_zones, lake, instant, after, max_commits, global_key
    )
    found["dmt_pub_dim_date_overwrite"] = partial(load_date_dimension, lake)
    found["dmt_tlc_union_trip_insert"] = union
    found["dmt_tlc_wide_trip_insert"] = wide
    return found


def monthly_build(
    lake: Lake,
    year: int,
    month: int,
    instant: str,
    after: str | None = None,
    ts: int | None = None,
    hours: tuple[str, str] | None = None,
    how: str = "inner",
    order_by: Sequence[str] = (),
    max_commits: int | None = None,
    global_key: bool = False,
    repeated_zones: bool = False,
) -> None:
    """Trips, zones and hours, then the marts of one month. The first error stops the build.

    The month's raw files must have landed and the tables must have been created. The hour
    dimension gains the hours of all months in which the month's trips begin, and those of the
    range ``hours``. A zone that moves to another service zone needs ``global_key``; else it is
    there twice, which is an error unless ``repeated_zones``.
    """
    partition = month_of(year, month)
    trip_ingest_chain(lake, year, month)
    geo_dimension_chain(lake, year, month, instant, after, ts, max_commits, global_key)
    build_union_trip(lake, catalog_feeds(lake), partition)
    trips = partitioned_parquet_scan(
        lake.spark, lake.path(UNION), lake.schema(UNION), **partition
    )
    build_date_dimension(lake, trips, hours=hours)
    build_wide_trip(lake, current_zones(lake), partition, how, order_by, repeated_zones)
