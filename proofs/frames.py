"""Trips, zones and feeds derived from the provided tables, in Spark and in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from proofs.registry import table
from tidelake.functions.times import month_of, year_of
from tidelake.lake import Lake, scratch_path, stage
from tidelake.operators.joins import join_dimension
from tidelake.plans.mart import ZONE_COLUMNS
from tidelake.schemas import TABLES, union_trip_schema

UNION_COLUMNS = union_trip_schema().names


def new_lake(spark: SparkSession) -> Lake:
    """A lake in a fresh folder with its own databases."""
    return Lake(spark, scratch_path(spark), f"p{uuid.uuid4().hex[:12]}_")


def monthly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with text dates and the year and month they belong to."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.col("o_orderdate").cast("string").alias("o_orderdate"), "o_orderpriority",
        year_of("o_orderdate").alias("year"), month_of("o_orderdate").alias("month"),
    )


MONTHLY_ORDERS = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority,
           strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month
    FROM orders
"""


def line_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order line as a trip from the customer's nation to the supplier's."""
    lines = table(spark, sf_dir, "lineitem")
    customers = table(spark, sf_dir, "customer")
    orders = join_dimension(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"),
        customers, F.col("o_custkey"), "c_custkey", {"c_nationkey": "pulocationid"},
        fact_is_table=True,
    )
    trips = join_dimension(
        lines, orders, F.col("l_orderkey"), "o_orderkey",
        {"o_orderdate": "o_orderdate", "pulocationid": "pulocationid"}, fact_is_table=True,
    )
    suppliers = table(spark, sf_dir, "supplier")
    return join_dimension(
        trips, suppliers, F.col("l_suppkey"), "s_suppkey", {"s_nationkey": "dolocationid"}
    )


LINE_TRIPS = """
    SELECT l.*, o_orderdate, c_nationkey AS pulocationid, s_nationkey AS dolocationid
    FROM lineitem l
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
"""


def nation_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones, regions as boroughs."""
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    return join_dimension(
        nations, regions, F.col("n_regionkey"), "r_regionkey", {"r_name": "borough"},
        fact_is_table=True,
    ).select(
        F.col("n_nationkey").cast("bigint").alias("locationid"),
        "borough",
        F.col("n_name").alias("zone"),
        F.replace(F.col("borough"), F.lit(" "), F.lit("/")).alias("service_zone"),
    )


NATION_ZONES = """
    SELECT CAST(n_nationkey AS BIGINT) AS locationid, r_name AS borough, n_name AS zone,
           replace(r_name, ' ', '/') AS service_zone
    FROM nation JOIN region ON n_regionkey = r_regionkey
"""


def line_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The order lines as four trip feeds; each line is in exactly one of them.

    The joined lines are written once, as the feeds' common origin, in a folder for each feed.
    """
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    hired = F.when(status == "O", "fhv").when(status == "F", "fhvhv")
    feed = F.when(flag == "A", "yellow").when(flag == "R", "green").when(flag == "N", hired)
    lines = line_trips(spark, sf_dir).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_linestatus", "l_shipdate",
        "o_orderdate", "pulocationid", "dolocationid", feed.alias("feed"),
    )
    trips = stage(lines.filter("feed IS NOT NULL"), partition_by=["feed"])
    pickup, dropoff = F.col("o_orderdate").cast("string"), F.col("l_shipdate").cast("string")
    at = [
        F.col("pulocationid").cast("bigint").alias("pulocationid"),
        F.col("dolocationid").cast("bigint").alias("dolocationid"),
    ]
    month = [year_of("o_orderdate").alias("year"), month_of("o_orderdate").alias("month")]
    number = F.col("l_linenumber").cast("bigint")
    base = F.concat(F.lit("B"), F.col("l_suppkey").cast("string"))

    def taxi(prefix: str, *extra) -> list:
        return [
            number.alias("vendorid"),
            pickup.alias(f"{prefix}_pickup_datetime"),
            dropoff.alias(f"{prefix}_dropoff_datetime"),
            number.alias("passenger_count"),
            F.col("l_quantity").alias("trip_distance"),
            F.col("l_partkey").alias("ratecodeid"),
            F.col("l_linestatus").alias("store_and_fwd_flag"),
            *at,
            F.col("l_orderkey").alias("payment_type"),
            F.col("l_extendedprice").alias("fare_amount"),
            *[
                F.lit(0.5).alias(c)
                for c in (
                    "extra", "mta_tax", "tip_amount", "tolls_amount",
                    "improvement_surcharge", "congestion_surcharge",
                )
            ],
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("total_amount"),
            *extra,
            *month,
        ]

    hire = [pickup.alias("pickup_datetime"), dropoff.alias("dropoff_datetime"), *at]
    return {
        "yellow": trips.filter("feed = 'yellow'").select(*taxi("tpep")),
        "green": trips.filter("feed = 'green'").select(
            *taxi("lpep", status.alias("ehail_fee"), number.alias("trip_type"))
        ),
        "fhv": trips.filter("feed = 'fhv'").select(
            base.alias("dispatching_base_num"), *hire,
            number.cast("string").alias("sr_flag"), *month,
        ),
        "fhvhv": trips.filter("feed = 'fhvhv'").select(
            F.lit("HV1").alias("hvfhs_license_num"), base.alias("dispatching_base_num"), *hire,
            number.alias("sr_flag"), *month,
        ),
    }


LINE_UNION = f"""
    SELECT CASE l_returnflag WHEN 'A' THEN 'yellow' WHEN 'R' THEN 'green'
             ELSE CASE l_linestatus WHEN 'O' THEN 'fhv' ELSE 'fhvhv' END END AS tlc_trip_type,
           CASE WHEN l_returnflag <> 'N' THEN CAST(l_linenumber AS BIGINT) END AS vendorid,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS pickup_datetime,
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS dropoff_datetime,
           CASE WHEN l_returnflag <> 'N' THEN CAST(l_linenumber AS BIGINT) END AS passenger_count,
           CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS trip_distance,
           CASE WHEN l_returnflag <> 'N' THEN l_partkey END AS ratecodeid,
           CASE WHEN l_returnflag <> 'N' THEN l_linestatus END AS store_and_fwd_flag,
           CAST(pulocationid AS BIGINT) AS pulocationid,
           CAST(dolocationid AS BIGINT) AS dolocationid,
           CASE WHEN l_returnflag <> 'N' THEN l_orderkey END AS payment_type,
           CASE WHEN l_returnflag <> 'N' THEN l_extendedprice END AS fare_amount,
           CASE WHEN l_returnflag <> 'N' THEN CAST(0.5 AS DOUBLE) END AS extra,
           CASE WHEN l_returnflag <> 'N' THEN CAST(0.5 AS DOUBLE) END AS mta_tax,
           CASE WHEN l_returnflag <> 'N' THEN CAST(0.5 AS DOUBLE) END AS tip_amount,
           CASE WHEN l_returnflag <> 'N' THEN CAST(0.5 AS DOUBLE) END AS tolls_amount,
           CASE WHEN l_returnflag <> 'N' THEN CAST(0.5 AS DOUBLE) END AS improvement_surcharge,
           CASE WHEN l_returnflag <> 'N' THEN l_extendedprice * (1 - l_discount) END
             AS total_amount,
           CASE WHEN l_returnflag <> 'N' THEN CAST(0.5 AS DOUBLE) END AS congestion_surcharge,
           CASE WHEN l_returnflag = 'R' THEN CAST(l_linenumber AS BIGINT) END AS trip_type,
           CAST(NULL AS DOUBLE) AS ehail_fee,
           CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'HV1' END
             AS hvfhs_license_num,
           CASE WHEN l_returnflag = 'N' THEN 'B' || l_suppkey END AS dispatching_base_num,
           CASE WHEN l_returnflag = 'N' THEN CAST(l_linenumber AS VARCHAR) END AS sr_flag,
           strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month
    FROM ({LINE_TRIPS})
"""


def event_feeds(events: DataFrame) -> dict[str, DataFrame]:
    """Events as four raw trip feeds of a month; each event is in one of them."""
    end = F.expr("timestampadd(SECOND, cast(floor(value * 60) as int), ts)")
    pickup = F.substring(F.col("ts").cast("string"), 1, 19)
    dropoff = F.substring(end.cast("string"), 1, 19)
    at = [
        F.pmod("user_id", F.lit(25)).alias("pulocationid"),
        F.pmod("event_id", F.lit(26)).alias("dolocationid"),
    ]
    kind = F.col("event_type")
    values = {
        "vendorid": F.col("event_id"),
        "tpep_pickup_datetime": pickup,
        "tpep_dropoff_datetime": dropoff,
        "lpep_pickup_datetime": pickup,
        "lpep_dropoff_datetime": dropoff,
        "pickup_datetime": pickup,
        "dropoff_datetime": dropoff,
        "passenger_count": F.col("user_id"),
        "trip_distance": F.col("value"),
        "ratecodeid": F.col("user_id"),
        "store_and_fwd_flag": F.lit("N"),
        "pulocationid": at[0],
        "dolocationid": at[1],
        "payment_type": F.col("event_id"),
        "total_amount": F.col("value") + 2.5,
        "ehail_fee": F.lit("1.5"),
        "trip_type": F.col("user_id"),
        "hvfhs_license_num": F.lit("HV1"),
        "dispatching_base_num": F.concat(F.lit("B"), F.col("event_id").cast("string")),
        "sr_flag": F.col("user_id"),
        "affiliated_base_number": F.lit("B0"),
    }
    kinds = {
        "yellow": ["click", "signup"], "green": ["view"], "fhv": ["purchase"], "fhvhv": ["error"],
    }
    return {
        feed: events.filter(kind.isin(kinds[feed])).select(
            *[
                values.get(f.name, F.lit(1.5)).cast(f.dataType).alias(f.name)
                for f in TABLES[f"stg.tlc_{feed}_trip"].schema
            ]
        )
        for feed in kinds
    }


_EVENT_UNION = """
    SELECT CASE event_type WHEN 'view' THEN 'green' WHEN 'purchase' THEN 'fhv'
             WHEN 'error' THEN 'fhvhv' ELSE 'yellow' END AS tlc_trip_type,
           CASE WHEN taxi THEN event_id END AS vendorid,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS pickup_datetime,
           strftime(ts + to_seconds(CAST(floor(value * 60) AS INTEGER)), '%Y-%m-%d %H:%M:%S')
             AS dropoff_datetime,
           CASE WHEN taxi THEN user_id END AS passenger_count,
           CASE WHEN taxi THEN value END AS trip_distance,
           CASE WHEN taxi THEN user_id END AS ratecodeid,
           CASE WHEN taxi THEN 'N' END AS store_and_fwd_flag,
           user_id % 25 AS pulocationid,
           event_id % 26 AS dolocationid,
           CASE WHEN taxi THEN event_id END AS payment_type,
           CASE WHEN taxi THEN CAST(1.5 AS DOUBLE) END AS fare_amount,
           CASE WHEN taxi THEN CAST(1.5 AS DOUBLE) END AS extra,
           CASE WHEN taxi THEN CAST(1.5 AS DOUBLE) END AS mta_tax,
           CASE WHEN taxi THEN CAST(1.5 AS DOUBLE) END AS tip_amount,
           CASE WHEN taxi THEN CAST(1.5 AS DOUBLE) END AS tolls_amount,
           CASE WHEN taxi THEN CAST(1.5 AS DOUBLE) END AS improvement_surcharge,
           CASE WHEN taxi THEN value + 2.5 END AS total_amount,
           CASE WHEN taxi THEN CAST(1.5 AS DOUBLE) END AS congestion_surcharge,
           CASE WHEN event_type = 'view' THEN user_id END AS trip_type,
           CASE WHEN event_type = 'view' THEN CAST(1.5 AS DOUBLE) END AS ehail_fee,
           CASE WHEN event_type = 'error' THEN 'HV1' END AS hvfhs_license_num,
           CASE WHEN NOT taxi THEN 'B' || event_id END AS dispatching_base_num,
           CASE WHEN NOT taxi THEN CAST(user_id AS VARCHAR) END AS sr_flag,
           '{year}' AS year, '{month}' AS month
    FROM (SELECT *, event_type IN ('click', 'signup', 'view') AS taxi FROM {events})
"""


def event_union(events: str = "events", year: str = "2024", month: str = "01") -> str:
    return _EVENT_UNION.format(events=events, year=year, month=month)


# SQL fragments shared by the twins.

HOURS_SQL = """
    SELECT year(t) * 1000000 + month(t) * 10000 + day(t) * 100 + hour(t) AS dwid,
           strftime(t, '%Y-%m-%d') AS db_date, CAST(year(t) AS INTEGER) AS year,
           CAST(month(t) AS INTEGER) AS month, CAST(day(t) AS INTEGER) AS day,
           CAST(hour(t) AS INTEGER) AS hour, CAST(quarter(t) AS INTEGER) AS quarter,
           CAST(week(t) AS INTEGER) AS week, dayname(t) AS day_name,
           monthname(t) AS month_name, dayofweek(t) IN (0, 6) AS weekend_flag
    FROM (
      SELECT unnest(generate_series(m, m + INTERVAL 1 MONTH - INTERVAL 1 HOUR,
                                    INTERVAL 1 HOUR)) AS t
      FROM (SELECT DISTINCT CAST(date_trunc('month', {column}) AS TIMESTAMP) AS m FROM {table}))
"""


def hours_sql(table_name: str, column: str) -> str:
    return HOURS_SQL.format(table=table_name, column=column)


# The labels of the ranges of distance, time and speed.


def distance_label_sql(x: str) -> str:
    return f"""CASE WHEN {x} <= 1 THEN '0-1 Mile' WHEN {x} <= 2 THEN '1-2 Miles'
      WHEN {x} <= 3 THEN '2-3 Miles' WHEN {x} <= 4 THEN '3-4 Miles'
      WHEN {x} <= 5 THEN '4-5 Miles' WHEN {x} <= 6 THEN '5-6 Miles'
      WHEN {x} <= 7 THEN '6-7 Miles' WHEN {x} <= 8 THEN '7-8 Miles'
      WHEN {x} <= 9 THEN '8-9 Miles' WHEN {x} <= 10 THEN '9-10 Miles'
      WHEN {x} <= 15 THEN '10-15 Miles' WHEN {x} <= 20 THEN '15-20 Miles'
      WHEN {x} <= 25 THEN '20-25 Miles' WHEN {x} <= 30 THEN '25-30 Miles'
      WHEN {x} > 30 THEN '30 Miles Above' END"""


def duration_label_sql(x: str) -> str:
    return f"""CASE WHEN {x} <= 10 THEN '0-10 Minutes' WHEN {x} <= 20 THEN '10-20 Minutes'
      WHEN {x} <= 30 THEN '20-30 Minutes' WHEN {x} <= 40 THEN '30-40 Minutes'
      WHEN {x} <= 50 THEN '40-50 Minutes' WHEN {x} <= 60 THEN '50-60 Minutes'
      WHEN {x} > 60 THEN '60 Minutes Above' END"""


def speed_label_sql(x: str) -> str:
    return f"""CASE WHEN {x} <= 5 THEN '0-5 Miles/Hour' WHEN {x} <= 10 THEN '5-10 Miles/Hour'
      WHEN {x} <= 15 THEN '10-15 Miles/Hour' WHEN {x} <= 20 THEN '15-20 Miles/Hour'
      WHEN {x} <= 25 THEN '20-25 Miles/Hour' WHEN {x} <= 30 THEN '25-30 Miles/Hour'
      WHEN {x} > 30 THEN '30 Miles/Hour Above' END"""


def wide_sql(union_sql: str, zones_sql: str, hours: str) -> str:
    """The wide mart of a union, numbered in the order of the union's columns."""
    order = ", ".join(f"{c} NULLS FIRST" for c in [*UNION_COLUMNS])
    seconds = "(epoch(dropoff_datetime::TIMESTAMP) - epoch(pickup_datetime::TIMESTAMP))"
    return f"""
    WITH u AS ({union_sql}), pu AS ({zones_sql}), "do" AS ({zones_sql}), h AS ({hours}),
    m AS (
      SELECT u.*, {seconds} / 60 AS travel_time,
             trip_distance / nullif({seconds} / 3600, 0) AS travel_average_speed
      FROM u)
    SELECT row_number() OVER (ORDER BY {order}) AS dwid,
           {", ".join("m." + c for c in UNION_COLUMNS)},
           {distance_label_sql("trip_distance")} AS travel_distance_rank,
           travel_time, {duration_label_sql("travel_time")} AS travel_time_rank,
           travel_average_speed,
           {speed_label_sql("travel_average_speed")} AS travel_average_speed_rank,
           h.dwid AS hour_dwid, h.db_date, h.day, h.hour, h.quarter, h.week, h.day_name, h.month_name,
           h.weekend_flag,
           {", ".join(f'"{e}".{c} AS {e}_{c}' for e in ("pu", "do") for c in ZONE_COLUMNS)},
           pu.zone || ' -> ' || "do".zone AS pu_do_zone,
           CASE WHEN tlc_trip_type IN ('yellow', 'green')
             THEN total_amount / nullif(travel_time, 0) END AS time_profit_rate,
           CASE WHEN tlc_trip_type IN ('yellow', 'green')
             THEN total_amount / nullif(trip_distance, 0) END AS distance_profit_rate,
           m.year, m.month
    FROM m
    JOIN h ON CAST(strftime(pickup_datetime::TIMESTAMP, '%Y%m%d%H') AS BIGINT) = h.dwid
    JOIN pu ON pulocationid = pu.locationid
    JOIN "do" ON dolocationid = "do".locationid
    """
