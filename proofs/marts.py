"""U1, J1-J3, W1 and the wide mart."""

from pyspark.sql import functions as F

from proofs.frames import (
    LINE_TRIPS, LINE_UNION, NATION_ZONES, UNION_COLUMNS, hours_sql, line_feeds, line_trips,
    nation_zones, new_lake, wide_sql,
)
from proofs.registry import proof, table
from tidelake.lake import stage
from tidelake.operators.dimensions import date_hour_dimension_of
from tidelake.operators.joins import join_dimension
from tidelake.operators.numbering import surrogate_key
from tidelake.plans.mart import (
    HOURS, WIDE, build_union_trip, build_wide_trip, join_dropoff_zone, join_hour_dim,
    join_pickup_zone, union_trips, wide_trips,
)
from tidelake.sinks.parquet import overwrite_table
from tidelake.sources.tables import partitioned_parquet_scan

# The names of the hour columns.
HOUR_COLUMNS_SQL = (
    "h.dwid AS hour_dwid, h.db_date, h.day, h.hour, h.quarter, h.week, h.day_name,"
    " h.month_name, h.weekend_flag"
)


@proof("union_sources", LINE_UNION)
def union(spark, sf_dir):
    return union_trips(line_feeds(spark, sf_dir))


@proof(
    "join_hour_dim",
    f"""
    WITH h AS ({hours_sql("events", "ts")})
    SELECT event_id, {HOUR_COLUMNS_SQL}
    FROM events JOIN h ON CAST(strftime(ts, '%Y%m%d%H') AS BIGINT) = h.dwid
    """,
)
def hour_join(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    trips = events.select("event_id", F.col("ts").cast("string").alias("pickup_datetime"))
    hours = stage(date_hour_dimension_of(events, "ts"))
    return join_hour_dim(trips, hours).drop("pickup_datetime")


@proof(
    "join_pickup_zone",
    f"""
    SELECT l_orderkey, l_linenumber, borough AS pu_borough, zone AS pu_zone,
           service_zone AS pu_service_zone
    FROM ({LINE_TRIPS}) JOIN ({NATION_ZONES}) ON pulocationid = locationid
    """,
)
def pickup_join(spark, sf_dir):
    trips = line_trips(spark, sf_dir).select("l_orderkey", "l_linenumber", "pulocationid")
    return join_pickup_zone(trips, nation_zones(spark, sf_dir)).drop("pulocationid")


@proof(
    "join_dropoff_zone",
    f"""
    SELECT l_orderkey, l_linenumber, p.zone AS pu_zone, d.zone AS do_zone,
           d.borough AS do_borough, d.service_zone AS do_service_zone,
           p.zone || ' -> ' || d.zone AS pu_do_zone
    FROM ({LINE_TRIPS}) JOIN ({NATION_ZONES}) AS p ON pulocationid = p.locationid
    JOIN ({NATION_ZONES}) AS d ON dolocationid = d.locationid
    """,
)
def dropoff_join(spark, sf_dir):
    trips = line_trips(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "pulocationid", "dolocationid"
    )
    zones = nation_zones(spark, sf_dir)
    routes = join_dropoff_zone(join_pickup_zone(trips, zones), zones)
    return routes.withColumn("pu_do_zone", F.concat("pu_zone", F.lit(" -> "), "do_zone")).drop(
        "pulocationid", "dolocationid", "pu_borough", "pu_service_zone"
    )


@proof(
    "surrogate_key",
    "SELECT row_number() OVER (ORDER BY o_orderkey) AS dwid, o_orderkey, o_totalprice FROM orders",
)
def numbered(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return surrogate_key(orders, "dwid", ["o_orderkey"], unique=True)


def dense(df):
    """The rows without their numbers, and what shows that these are 1..n in some order.

    Dense numbers start at 1 and end at the number of rows, and none occurs twice. The distinct
    ones are counted in bitmaps, one for each 32,768 numbers, so few bytes are shuffled.
    """
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("dwid"))
    buckets = df.groupBy(F.bitmap_bucket_number("dwid")).agg(
        F.min("dwid").alias("low"), F.max("dwid").alias("high"), F.count("*").alias("n"),
        F.bitmap_count(bits).alias("numbers"),
    )
    low, high, n, distinct = buckets.agg(
        F.min("low"), F.max("high"), F.sum("n"), F.sum("numbers")
    ).first()
    return df.drop("dwid").withColumns(
        {
            name: F.lit(value).cast("bigint")
            for name, value in zip(
                ("lowest", "highest", "numbers", "n"), (low, high, distinct, n), strict=True
            )
        }
    )


def dense_sql(sql):
    return f"""
    SELECT * EXCLUDE (dwid), min(dwid) OVER () AS lowest, max(dwid) OVER () AS highest,
           (SELECT count(*) FROM ({sql})) AS numbers, count(*) OVER () AS n
    FROM ({sql})
    """


LINES_NUMBERED = """
    SELECT row_number() OVER () AS dwid, l_orderkey, l_linenumber, l_partkey, l_extendedprice
    FROM lineitem
"""


@proof("surrogate_key_any_order", dense_sql(LINES_NUMBERED))
def numbered_in_place(spark, sf_dir):
    """Without an order no row is shuffled; the numbers are still 1..n."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )
    return dense(surrogate_key(lines))


@proof("wide_trips", wide_sql(LINE_UNION, NATION_ZONES, hours_sql("orders", "o_orderdate")))
def wide(spark, sf_dir):
    """The wide mart over all order lines, numbered in a fixed order."""
    hours = stage(date_hour_dimension_of(table(spark, sf_dir, "orders"), "o_orderdate"))
    trips = union_trips(line_feeds(spark, sf_dir))
    return wide_trips(trips, nation_zones(spark, sf_dir), hours, order_by=UNION_COLUMNS)


@proof(
    "wide_trips_any_order",
    dense_sql(wide_sql(LINE_UNION, NATION_ZONES, hours_sql("orders", "o_orderdate"))),
)
def wide_in_place(spark, sf_dir):
    """The wide mart as it is built by default: no order, written through the lake."""
    lake = new_lake(spark)
    hours = date_hour_dimension_of(table(spark, sf_dir, "orders"), "o_orderdate")
    overwrite_table(hours, lake.path(HOURS))
    build_union_trip(lake, line_feeds(spark, sf_dir), clustered=False)
    build_wide_trip(lake, nation_zones(spark, sf_dir))
    return dense(partitioned_parquet_scan(spark, lake.path(WIDE), lake.schema(WIDE)))


def year_sql(year, zones=NATION_ZONES):
    union = f"SELECT * FROM ({LINE_UNION}) WHERE year = '{year}'"
    return wide_sql(union, zones, hours_sql("orders", "o_orderdate"))


SOME_ZONES = f"SELECT * FROM ({NATION_ZONES}) WHERE locationid < 20"


@proof(
    "surrogate_key_ranges",
    f"""
    WITH first AS ({year_sql("1996")}), second AS ({year_sql("1997")}),
    fewer AS ({year_sql("1996", SOME_ZONES)})
    SELECT dwid, year, month, tlc_trip_type, pu_do_zone, total_amount FROM fewer
    UNION ALL
    SELECT dwid + (SELECT count(*) FROM first), year, month, tlc_trip_type, pu_do_zone,
           total_amount
    FROM second
    """,
)
def number_ranges(spark, sf_dir):
    """Two years are built in turn, then the first one again, from which some zones are gone.

    It gets the numbers that it had, so numbers are unique over the mart and dense within a year.
    """
    lake = new_lake(spark)
    hours = date_hour_dimension_of(table(spark, sf_dir, "orders"), "o_orderdate")
    overwrite_table(hours, lake.path(HOURS))
    build_union_trip(lake, line_feeds(spark, sf_dir), clustered=False)
    zones = nation_zones(spark, sf_dir)
    for year, own in (("1996", zones), ("1997", zones), ("1996", zones.filter("locationid < 20"))):
        build_wide_trip(lake, own, {"year": year}, order_by=UNION_COLUMNS)
    return partitioned_parquet_scan(spark, lake.path(WIDE), lake.schema(WIDE)).select(
        "dwid", "year", "month", "tlc_trip_type", "pu_do_zone", "total_amount"
    )


HOT_LINES = """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_returnflag = 'N' THEN 1 WHEN l_returnflag = 'R' THEN l_suppkey END AS key
    FROM lineitem
"""


@proof(
    "join_large_dimension",
    f"""
    SELECT l.*, s_name, s_acctbal FROM ({HOT_LINES}) l JOIN supplier ON key = s_suppkey
    UNION ALL
    SELECT -1 - l_orderkey, l_linenumber, key, s_name, s_acctbal
    FROM ({HOT_LINES}) LEFT JOIN supplier ON key = s_suppkey AND s_suppkey % 2 = 1
    """,
)
def large_join(spark, sf_dir):
    """No side is small; half of the lines share one key and a quarter has none. Inner and left."""
    flag, key = F.col("l_returnflag"), F.col("l_suppkey")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(flag == "N", F.lit(1).cast("bigint")).when(flag == "R", key).alias("key"),
    )
    suppliers, take = table(spark, sf_dir, "supplier"), {"s_name": "s_name", "s_acctbal": "s_acctbal"}
    large = {"broadcast_bytes": 0, "hot_rows": 1500, "fact_is_table": True}
    inner = join_dimension(lines, suppliers, F.col("key"), "s_suppkey", take, **large)
    left = join_dimension(
        lines, suppliers.filter("s_suppkey % 2 = 1"), F.col("key"), "s_suppkey", take, "left", **large
    )
    return inner.unionAll(left.withColumn("l_orderkey", -1 - F.col("l_orderkey")))
