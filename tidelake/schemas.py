"""Schemas and keys of the tables of all layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

COMMIT_TIME = "_commit_time"

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
}


def struct_of(columns: str) -> T.StructType:
    """``"a bigint, b string"`` as a StructType, without needing a session."""
    pairs = (c.split() for c in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in pairs])


# Column names and types of the trip feeds, the zone dimension and the marts.
_MONTH = "year string, month string"

_YELLOW = (
    "vendorid bigint, tpep_pickup_datetime string, tpep_dropoff_datetime string,"
    "passenger_count bigint, trip_distance double, ratecodeid bigint,"
    "store_and_fwd_flag string, pulocationid bigint, dolocationid bigint,"
    "payment_type bigint, fare_amount double, extra double, mta_tax double,"
    "tip_amount double, tolls_amount double, improvement_surcharge double,"
    "total_amount double, congestion_surcharge double"
)
_GREEN = (
    "vendorid bigint, lpep_pickup_datetime string, lpep_dropoff_datetime string,"
    "store_and_fwd_flag string, ratecodeid bigint, pulocationid bigint,"
    "dolocationid bigint, passenger_count bigint, trip_distance double,"
    "fare_amount double, extra double, mta_tax double, tip_amount double,"
    "tolls_amount double, ehail_fee string, improvement_surcharge double,"
    "total_amount double, payment_type bigint, trip_type bigint,"
    "congestion_surcharge double"
)
_FHV = (
    "dispatching_base_num string, pickup_datetime string, dropoff_datetime string,"
    "pulocationid bigint, dolocationid bigint, sr_flag string"
)
_FHV_RAW = _FHV + ", affiliated_base_number string"
_FHVHV = (
    "hvfhs_license_num string, dispatching_base_num string, pickup_datetime string,"
    "dropoff_datetime string, pulocationid bigint, dolocationid bigint, sr_flag bigint"
)
_ZONE = "locationid bigint, borough string, zone string, service_zone string"
_UNION = (
    "tlc_trip_type string, vendorid bigint, pickup_datetime string,"
    "dropoff_datetime string, passenger_count bigint, trip_distance double,"
    "ratecodeid bigint, store_and_fwd_flag {flag}, pulocationid bigint,"
    "dolocationid bigint, payment_type bigint, fare_amount double, extra double,"
    "mta_tax double, tip_amount double, tolls_amount double,"
    "improvement_surcharge double, total_amount double, congestion_surcharge double,"
    "trip_type bigint, ehail_fee double, hvfhs_license_num string,"
    "dispatching_base_num string, sr_flag string"
)
_WIDE_EXTRA = (
    "travel_distance_rank string, travel_time double, travel_time_rank string,"
    "travel_average_speed double, travel_average_speed_rank string, hour_dwid bigint,"
    "db_date string, day int, hour int, quarter int, week int, day_name string,"
    "month_name string, weekend_flag boolean, pu_borough string, pu_zone string,"
    "pu_service_zone string, do_borough string, do_zone string, do_service_zone string,"
    "pu_do_zone string, time_profit_rate double, distance_profit_rate double"
)
_DATE = (
    "dwid bigint, db_date string, year int, month int, day int, hour int,"
    "quarter int, week int, day_name string, month_name string, weekend_flag boolean"
)

# The feeds, and the columns that the union calls by other names.
TRIP_FEEDS = ("yellow", "green", "fhv", "fhvhv")

#: Column renames that bring each feed to the names of the union schema.
TRIP_RENAMES = {
    "yellow": {
        "tpep_pickup_datetime": "pickup_datetime",
        "tpep_dropoff_datetime": "dropoff_datetime",
    },
    "green": {
        "lpep_pickup_datetime": "pickup_datetime",
        "lpep_dropoff_datetime": "dropoff_datetime",
    },
    "fhv": {},
    "fhvhv": {},
}


def union_trip_schema(flag_as_text: bool = True) -> T.StructType:
    """Columns of the united trips, without year and month.

    The bigint form of ``store_and_fwd_flag`` turns 'Y' and 'N' to NULL; text keeps them.
    """
    return struct_of(_UNION.format(flag="string" if flag_as_text else "bigint"))


@dataclass(frozen=True)
class Table:
    """What is fixed about one table: columns, layout and, if keyed, its keys."""

    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    precombine: str | None = None


_BY_MONTH = ("year", "month")

_UNION_TEXT = _UNION.format(flag="string")

TABLES: dict[str, Table] = {
    "stg.tlc_yellow_trip": Table(struct_of(_YELLOW)),
    "stg.tlc_green_trip": Table(struct_of(_GREEN)),
    "stg.tlc_fhv_trip": Table(struct_of(_FHV_RAW)),
    "stg.tlc_fhvhv_trip": Table(struct_of(_FHVHV)),
    "stg.geo_taxi_zone": Table(struct_of(_ZONE)),
    "stg.pub_dim_date": Table(struct_of(_DATE)),
    "ods.tlc_yellow_trip": Table(struct_of(f"{_YELLOW}, {_MONTH}"), _BY_MONTH),
    "ods.tlc_green_trip": Table(struct_of(f"{_GREEN}, {_MONTH}"), _BY_MONTH),
    "ods.tlc_fhv_trip": Table(struct_of(f"{_FHV_RAW}, {_MONTH}"), _BY_MONTH),
    "ods.tlc_fhvhv_trip": Table(struct_of(f"{_FHVHV}, {_MONTH}"), _BY_MONTH),
    "dwh.tlc_yellow_trip": Table(struct_of(f"{_YELLOW}, {_MONTH}"), _BY_MONTH),
    "dwh.tlc_green_trip": Table(struct_of(f"{_GREEN}, {_MONTH}"), _BY_MONTH),
    "dwh.tlc_fhv_trip": Table(struct_of(f"{_FHV}, {_MONTH}"), _BY_MONTH),
    "dwh.tlc_fhvhv_trip": Table(struct_of(f"{_FHVHV}, {_MONTH}"), _BY_MONTH),
    "ods.geo_taxi_zone": Table(
        struct_of(f"{_ZONE}, ts bigint, {COMMIT_TIME} string, {_MONTH}"),
        _BY_MONTH, ("locationid",), "ts",
    ),
    "dwh.geo_taxi_zone": Table(
        struct_of(f"{_ZONE}, ts bigint, {_MONTH}, {COMMIT_TIME} string"),
        (), ("locationid",), "ts",
    ),
    "dmt.geo_dim_taxi_zone": Table(
        struct_of(
            f"locationid bigint, borough string, zone string, ts bigint, {_MONTH},"
            f"{COMMIT_TIME} string, service_zone string"
        ),
        ("service_zone",), ("locationid",), "ts",
    ),
    "dmt.pub_dim_date": Table(struct_of(_DATE), ("year",)),
    "dmt.tlc_union_trip": Table(struct_of(f"{_UNION_TEXT}, {_MONTH}"), _BY_MONTH),
    "dmt.tlc_wide_trip": Table(
        struct_of(f"dwid bigint, {_UNION_TEXT}, {_WIDE_EXTRA}, {_MONTH}"), _BY_MONTH
    ),
}
