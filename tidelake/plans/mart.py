"""The trip marts: all feeds united, then widened with hour and zones."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, functions as F

from tidelake.functions.buckets import distance_bucket, duration_bucket, speed_bucket
from tidelake.functions.rates import (
    METERED_TYPES, average_speed, distance_profit_rate, time_profit_rate,
)
from tidelake.functions.text import route_label
from tidelake.functions.times import elapsed_seconds, hour_key
from tidelake.lake import Lake, scratch_scope
from tidelake.operators.joins import Dimension, join_dimension, measured
from tidelake.operators.numbering import ADDRESS, surrogate_key, with_address
from tidelake.operators.union import union_sources
from tidelake.schemas import TABLES, TRIP_FEEDS, TRIP_RENAMES
from tidelake.sinks.catalog import register_catalog
from tidelake.sinks.parquet import overwrite_partitions
from tidelake.sinks.ranges import base_of_range
from tidelake.sources.tables import partitioned_parquet_scan
from tidelake.versions import Touched, part_name

UNION, WIDE, HOURS, ZONES = (
    "dmt.tlc_union_trip", "dmt.tlc_wide_trip", "dmt.pub_dim_date", "dmt.geo_dim_taxi_zone",
)
HOUR_COLUMNS = (
    "db_date", "day", "hour", "quarter", "week", "day_name", "month_name", "weekend_flag",
)
ZONE_COLUMNS = ("borough", "zone", "service_zone")


def union_trips(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """The feeds in one schema, tagged with their trip type."""
    return union_sources(feeds, TABLES[UNION].schema, "tlc_trip_type", TRIP_RENAMES)


def trip_metrics(trips: DataFrame, metered: Sequence[str] = METERED_TYPES) -> DataFrame:
    """Distance, time and speed with their labels, and the profit rates.

    Needs pickup_datetime, dropoff_datetime, trip_distance, total_amount and tlc_trip_type.
    """
    distance, seconds = F.col("trip_distance"), F.col("_seconds")
    minutes, speed = F.col("travel_time"), F.col("travel_average_speed")
    amount, kind = F.col("total_amount"), F.col("tlc_trip_type")
    measured = trips.withColumn(
        "_seconds", elapsed_seconds("pickup_datetime", "dropoff_datetime")
    ).withColumns(
        {
            "travel_time": seconds / F.lit(60.0),
            "travel_average_speed": average_speed(distance, seconds),
        }
    )
    return measured.withColumns(
        {
            "travel_distance_rank": distance_bucket(distance),
            "travel_time_rank": duration_bucket(minutes),
            "travel_average_speed_rank": speed_bucket(speed),
            "time_profit_rate": time_profit_rate(amount, minutes, kind, metered),
            "distance_profit_rate": distance_profit_rate(amount, distance, kind, metered),
        }
    ).drop("_seconds")


def join_hour_dim(
    trips: DataFrame, hours: DataFrame | Dimension, how: str = "inner"
) -> DataFrame:
    """Hour columns by the computed key of the pickup time.

    A time that cannot be read gets a key that no hour has. So the key is never NULL, and the
    optimizer adds no filter that would read the text a second time.
    """
    take = {"dwid": "hour_dwid", **{c: c for c in HOUR_COLUMNS}}
    key = F.coalesce(hour_key("pickup_datetime"), F.lit(-1))
    return join_dimension(trips, hours, key, "dwid", take, how)


def join_pickup_zone(
    trips: DataFrame, zones: DataFrame | Dimension, how: str = "inner"
) -> DataFrame:
    take = {c: f"pu_{c}" for c in ZONE_COLUMNS}
    return join_dimension(trips, zones, F.col("pulocationid"), "locationid", take, how)


def join_dropoff_zone(
    trips: DataFrame, zones: DataFrame | Dimension, how: str = "inner"
) -> DataFrame:
    take = {c: f"do_{c}" for c in ZONE_COLUMNS}
    return join_dimension(trips, zones, F.col("dolocationid"), "locationid", take, how)


def measured_zones(zones: DataFrame | Dimension, repeated_zones: bool = False) -> Dimension:
    """The zones, measured once for both ends. A repeated zone key is an error unless allowed.

    A repeated zone would double each of its trips per end.
    """
    if not isinstance(zones, Dimension):
        zones = measured(zones.select("locationid", *ZONE_COLUMNS), "locationid")
    if zones.repeated and not repeated_zones:
        raise ValueError("a zone occurs twice; publish zones with global_key, or allow it")
    return zones


def measured_hours(hours: DataFrame | Dimension) -> Dimension:
    if isinstance(hours, Dimension):
        return hours
    return measured(hours.select("dwid", *HOUR_COLUMNS), "dwid")


def widen_trips(
    trips: DataFrame,
    zones: DataFrame | Dimension,
    hours: DataFrame | Dimension | None = None,
    how: str = "inner",
    metered: Sequence[str] = METERED_TYPES,
    repeated_zones: bool = False,
) -> DataFrame:
    """Trips with metrics, hour and both zones, without a number.

    With inner joins a trip without a known hour or zone is left out.
    """
    wide, zones = trips, measured_zones(zones, repeated_zones)
    if hours is not None:
        wide = join_hour_dim(wide, hours, how)
    wide = join_dropoff_zone(join_pickup_zone(wide, zones, how), zones, how)
    wide = wide.withColumn("pu_do_zone", route_label(F.col("pu_zone"), F.col("do_zone")))
    return trip_metrics(wide, metered)


def known_trips(trips: DataFrame, zones: Dimension, hours: Dimension) -> DataFrame:
    """The trips whose hour and zones are known, with their own columns."""
    key = F.coalesce(hour_key("pickup_datetime"), F.lit(-1))
    found = join_dimension(trips, hours, key, "dwid", {})
    for end in ("pulocationid", "dolocationid"):
        found = join_dimension(found, zones, F.col(end), "locationid", {})
    return found


def wide_trips(
    trips: DataFrame, zones: DataFrame | Dimension, hours: DataFrame | Dimension,
    how: str = "inner", order_by: Sequence[str] = (), is_scan: bool = False,
    repeated_zones: bool = False, base_of: Callable[[int], int] | None = None,
    gather: Sequence[str] = (),
) -> DataFrame:
    """The wide mart. ``dwid`` is dense and unique within the result.

    The trips that stay are numbered while their rows are short, and widened only as they are
    read. Where a dimension's key repeats, trips multiply, so the wide rows are numbered. Numbers
    that follow an order need equal trips told apart. ``is_scan`` says that the trips read
    Parquet files; ``base_of`` is that of ``surrogate_key``. ``gather`` names columns whose values
    get few tasks each; unless a dimension must be shuffled, rows are moved while they are short.
    """
    columns = [c for c in TABLES[WIDE].schema.names if c != "dwid"]
    zones, hours = measured_zones(zones, repeated_zones), measured_hours(hours)
    placed = with_address(trips, is_scan) if order_by else trips
    order = [*order_by, *ADDRESS] if order_by else []
    if zones.repeated or hours.repeated:
        wide = widen_trips(placed, zones, hours, how, repeated_zones=True)
        wide = wide.select(*columns, *(ADDRESS if order else []))
        # Copies of one trip have its address, so the ends' zones tell them apart.
        ends = [f"{end}_{c}" for end in ("pu", "do") for c in ZONE_COLUMNS] if order else []
        numbered = surrogate_key(wide, "dwid", [*order, *ends], True, base_of).drop(*ADDRESS)
        return gathered(numbered, gather)
    in_place = zones.small and hours.small
    keep = partial(known_trips, zones=zones, hours=hours) if how == "inner" else None
    if keep and not in_place:
        placed, keep = keep(placed), None
    numbered = surrogate_key(placed, "dwid", order, True, base_of, keep).drop(*ADDRESS)
    if in_place:
        return widen_trips(gathered(numbered, gather), zones, hours, how).select("dwid", *columns)
    return gathered(widen_trips(numbered, zones, hours, how).select("dwid", *columns), gather)


def gathered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *[F.col(c) for c in columns]) if columns else df


def build_union_trip(
    lake: Lake,
    feeds: Mapping[str, DataFrame],
    month: Mapping[str, str] | None = None,
    clustered: bool = True,
) -> None:
    """Replace the month of all sources at once, or every month; a rerun adds nothing.

    ``clustered`` says that the feeds' files hold few months each, as those of partitioned
    tables do. Then the rows are written where they were read, without a shuffle.
    """
    if month:
        feeds = {name: in_month(df, month) for name, df in feeds.items()}
    overwrite_partitions(
        union_trips(feeds), lake.path(UNION), lake.table(UNION).partition_by,
        rebalance=not (month or clustered), then=registered(lake, UNION),
    )


def in_month(df: DataFrame, month: Mapping[str, str]) -> DataFrame:
    for column, value in month.items():
        df = df.filter(F.col(column) == value)
    return df


def build_wide_trip(
    lake: Lake,
    zones: DataFrame,
    month: Mapping[str, str] | None = None,
    how: str = "inner",
    order_by: Sequence[str] = (),
    repeated_zones: bool = False,
) -> None:
    """Replace the month, or every month, of the wide mart.

    ``dwid`` is dense within what is built at a time, and unique over the mart: each month has a
    range of numbers, which it keeps when it is built again, as long as its rows have room there.

    Wide rows are written once, into the mart. Without ``order_by`` nothing is shuffled: trips
    stay with those of their month. Rows that were sorted for their numbers are gathered by month
    again.
    """
    trips = partitioned_parquet_scan(
        lake.spark, lake.path(UNION), lake.schema(UNION), **(month or {})
    )
    hours = partitioned_parquet_scan(lake.spark, lake.path(HOURS), lake.schema(HOURS))
    base_of = partial(base_of_range, lake.spark, lake.path(WIDE), part_name(month or {}))
    partition_by = lake.table(WIDE).partition_by
    gather = partition_by if order_by and not month else ()
    with scratch_scope(lake.spark):
        wide = wide_trips(
            trips, zones, hours, how, order_by, True, repeated_zones, base_of, gather
        )
        overwrite_partitions(
            wide, lake.path(WIDE), partition_by, rebalance=False, then=registered(lake, WIDE)
        )


def trip_mart(
    lake: Lake,
    feeds: Mapping[str, DataFrame],
    zones: DataFrame,
    month: Mapping[str, str] | None = None,
    how: str = "inner",
    order_by: Sequence[str] = (),
    clustered: bool = True,
    repeated_zones: bool = False,
) -> None:
    """Union, then wide mart."""
    if set(feeds) - set(TRIP_FEEDS):
        raise ValueError(f"unknown feeds {set(feeds) - set(TRIP_FEEDS)}")
    build_union_trip(lake, feeds, month, clustered)
    build_wide_trip(lake, zones, month, how, order_by, repeated_zones)


def registered(lake: Lake, name: str) -> Callable[[Touched], None]:
    """Moves the catalog entry of a table, if there is one, to the partitions written."""

    def move(touched: Touched) -> None:
        entry = lake.catalog_name(name)
        if lake.spark.catalog.tableExists(entry):
            register_catalog(
                lake.spark, entry, lake.schema(name), lake.path(name),
                lake.table(name).partition_by, touched.written, touched.emptied, touched.folders,
            )

    return move
