"""P1-P9 and D1-D12: projections, predicates and derived metrics."""

from pyspark.sql import functions as F

from proofs.frames import (
    distance_label_sql, duration_label_sql, hours_sql, speed_label_sql,
)
from proofs.registry import proof, table
from tidelake.functions.buckets import distance_bucket, duration_bucket, speed_bucket
from tidelake.functions.rates import average_speed, distance_profit_rate, time_profit_rate
from tidelake.functions.text import route_label, strip_chars
from tidelake.functions.times import elapsed_minutes, elapsed_seconds, hour_key, load_ts
from tidelake.operators.dimensions import date_hour_dimension_of
from tidelake.operators.joins import join_dimension
from tidelake.operators.project import (
    conform, exclude_columns, null_pad, project_rename, star_append, tag_literal,
)
from tidelake.schemas import struct_of


@proof("project_rename", "SELECT s_suppkey AS party, s_name AS name, s_acctbal AS balance FROM supplier")
def rename(spark, sf_dir):
    return project_rename(
        table(spark, sf_dir, "supplier"),
        {"s_suppkey": "party", "s_name": "name", "s_acctbal": "balance"},
    )


@proof("tag_literal", "SELECT 'customer' AS kind, c_custkey, c_name FROM customer")
def tag(spark, sf_dir):
    return tag_literal(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "kind", "customer"
    )


@proof(
    "null_pad",
    "SELECT CAST(NULL AS BIGINT) AS l_batch, l_orderkey, l_quantity,"
    " CAST(NULL AS VARCHAR) AS l_comment FROM lineitem",
)
def pad(spark, sf_dir):
    schema = struct_of("l_batch bigint, l_orderkey bigint, l_quantity double, l_comment string")
    return null_pad(table(spark, sf_dir, "lineitem"), schema)


@proof(
    "star_append",
    "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice,"
    " '2024' AS year, '01' AS month FROM part",
)
def append_constants(spark, sf_dir):
    return star_append(table(spark, sf_dir, "part"), {"year": "2024", "month": "01"})


@proof("exclude_columns_regex", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def exclude(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    marked = customers.withColumns(
        {"_commit_time": F.lit("20240101000000"), "_commit_seqno": F.col("c_custkey")}
    )
    return exclude_columns(marked, "_commit_(time|seqno)")


@proof(
    "positional_cast_insert",
    "SELECT TRY_CAST(o_orderstatus AS BIGINT) AS status, TRY_CAST(o_orderpriority AS DOUBLE)"
    " AS priority, CAST(o_orderkey AS VARCHAR) AS order_id,"
    " TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS level FROM orders",
)
def positional(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderstatus", "o_orderpriority", "o_orderkey", F.substring("o_orderpriority", 1, 1)
    )
    schema = struct_of("status bigint, priority double, order_id string, level bigint")
    return conform(orders, schema, by_position=True)


@proof(
    "in_list",
    "SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN value / nullif(user_id, 0)"
    " END AS rate FROM events",
)
def in_list(spark, sf_dir):
    """A rate that only rows of some types have."""
    rate = time_profit_rate(
        F.col("value"), F.col("user_id"), F.col("event_type"), ("click", "view")
    )
    return table(spark, sf_dir, "events").select("event_id", rate.alias("rate"))


@proof(
    "null_guard",
    f"""
    SELECT l_orderkey, {distance_label_sql("(CASE WHEN l_returnflag <> 'N' THEN l_quantity END)")}
             AS label
    FROM lineitem
    """,
)
def null_guard(spark, sf_dir):
    """A missing value has no label."""
    quantity = F.when(F.col("l_returnflag") != "N", F.col("l_quantity"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", distance_bucket(quantity).alias("label")
    )


@proof(
    "comparisons",
    f"""
    SELECT event_id, {speed_label_sql("value")} AS label,
           {speed_label_sql("(CASE WHEN value > 100.0 THEN 'NaN'::DOUBLE ELSE value END)")}
             AS holed_label,
           {duration_label_sql("value")} AS duration_label
    FROM events
    """,
)
def comparisons(spark, sf_dir):
    """Bounds are part of the lower range; NaN is above all of them."""
    value = F.col("value")
    holed = F.when(value > 100.0, F.lit(float("nan"))).otherwise(value)
    return table(spark, sf_dir, "events").select(
        "event_id", speed_bucket(value).alias("label"), speed_bucket(holed).alias("holed_label"),
        duration_bucket(value).alias("duration_label"),
    )


@proof(
    "distance_bucket",
    f"""
    SELECT l_orderkey, l_quantity, {distance_label_sql("l_quantity")} AS distance_rank,
           {distance_label_sql("(l_quantity - 25)")} AS shifted_rank
    FROM lineitem
    """,
)
def distance(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity",
        distance_bucket(F.col("l_quantity")).alias("distance_rank"),
        distance_bucket(F.col("l_quantity") - 25).alias("shifted_rank"),
    )


def shipments(spark, sf_dir):
    """Order lines with the time from order to shipping."""
    shipped = join_dimension(
        table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"), F.col("l_orderkey"),
        "o_orderkey", {"o_orderdate": "o_orderdate"}, fact_is_table=True,
    )
    return shipped.withColumn("seconds", elapsed_seconds("o_orderdate", "l_shipdate"))


SHIPMENTS = """
    SELECT *, epoch(l_shipdate) - epoch(o_orderdate) AS seconds
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


@proof(
    "elapsed_minutes",
    f"SELECT l_orderkey, l_linenumber, seconds / 60 AS minutes FROM ({SHIPMENTS})",
)
def minutes(spark, sf_dir):
    return shipments(spark, sf_dir).select(
        "l_orderkey", "l_linenumber",
        elapsed_minutes("o_orderdate", "l_shipdate").alias("minutes"),
    )


@proof(
    "duration_bucket",
    f"""
    SELECT l_orderkey, l_linenumber, {duration_label_sql("(seconds / 60)")} AS time_rank,
           {duration_label_sql("(seconds / 86400)")} AS days_rank
    FROM ({SHIPMENTS})
    """,
)
def duration(spark, sf_dir):
    seconds = F.col("seconds")
    return shipments(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", duration_bucket(seconds / 60).alias("time_rank"),
        duration_bucket(seconds / 86400).alias("days_rank"),
    )


@proof(
    "average_speed",
    f"""
    SELECT l_orderkey, l_linenumber, l_quantity / nullif(seconds / 3600, 0) AS speed
    FROM ({SHIPMENTS})
    """,
)
def speed(spark, sf_dir):
    return shipments(spark, sf_dir).select(
        "l_orderkey", "l_linenumber",
        average_speed(F.col("l_quantity"), F.col("seconds")).alias("speed"),
    )


@proof(
    "speed_bucket",
    f"""
    SELECT l_orderkey, l_linenumber, {speed_label_sql("speed")} AS speed_rank FROM (
      SELECT *, l_extendedprice / nullif(seconds / 3600, 0) AS speed FROM ({SHIPMENTS}))
    """,
)
def speed_label(spark, sf_dir):
    fast = average_speed(F.col("l_extendedprice"), F.col("seconds"))
    return (
        shipments(spark, sf_dir)
        .withColumn("speed", fast)
        .select("l_orderkey", "l_linenumber", speed_bucket(F.col("speed")).alias("speed_rank"))
    )


@proof(
    "time_profit_rate",
    f"""
    SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag IN ('A', 'R')
      THEN l_extendedprice / nullif(seconds / 60, 0) END AS rate
    FROM ({SHIPMENTS})
    """,
)
def time_rate(spark, sf_dir):
    rate = time_profit_rate(
        F.col("l_extendedprice"), F.col("seconds") / 60, F.col("l_returnflag"), ("A", "R")
    )
    return shipments(spark, sf_dir).select("l_orderkey", "l_linenumber", rate.alias("rate"))


@proof(
    "distance_profit_rate",
    """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag IN ('A', 'R')
      THEN l_extendedprice / nullif(l_quantity - 1, 0) END AS rate
    FROM lineitem
    """,
)
def distance_rate(spark, sf_dir):
    rate = distance_profit_rate(
        F.col("l_extendedprice"), F.col("l_quantity") - 1, F.col("l_returnflag"), ("A", "R")
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", rate.alias("rate")
    )


@proof(
    "route_label",
    """
    SELECT o_orderkey, o_orderpriority || ' -> ' || nullif(o_orderstatus, 'P') AS route
    FROM orders
    """,
)
def route(spark, sf_dir):
    end = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", route_label(F.col("o_orderpriority"), end).alias("route")
    )


@proof(
    "hour_key",
    "SELECT event_id, CAST(strftime(ts, '%Y%m%d%H') AS BIGINT) AS hour_dwid FROM events",
)
def hours_of_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", hour_key(F.col("ts").cast("string")).alias("hour_dwid")
    )


@proof("strip_chars", "SELECT o_orderkey, replace(o_orderpriority, '-', '') AS priority FROM orders")
def strip(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", strip_chars(F.col("o_orderpriority"), "-").alias("priority")
    )


@proof("load_ts", "SELECT c_custkey, CAST(1704067200 AS BIGINT) AS ts FROM customer")
def stamp(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", load_ts(1704067200).alias("ts"))


@proof("date_hour_dimension", hours_sql("orders", "o_orderdate"))
def hour_dimension(spark, sf_dir):
    return date_hour_dimension_of(table(spark, sf_dir, "orders"), "o_orderdate")
