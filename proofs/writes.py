"""K1-K13: views, partition writes, keyed writes and the catalog."""

from pyspark.sql import functions as F

from proofs.frames import (
    LINE_UNION, MONTHLY_ORDERS, NATION_ZONES, UNION_COLUMNS, hours_sql, line_feeds,
    monthly_orders, nation_zones, new_lake, wide_sql,
)
from proofs.registry import proof, table
from proofs.scans import ORDER_SCHEMA
from tidelake.functions.text import strip_chars
from tidelake.lake import scratch_path
from tidelake.operators.dimensions import date_hour_dimension_of
from tidelake.operators.keyed import precombine, stamp_commit
from tidelake.plans.mart import HOURS, WIDE, build_union_trip, build_wide_trip, union_trips
from tidelake.schemas import COMMIT_TIME, struct_of
from tidelake.sinks.catalog import (
    attach_partition, create_databases, create_tables, detach_partition,
    register_catalog, temp_view,
)
from tidelake.sinks.keyed import upsert_partitioned, upsert_unpartitioned
from tidelake.sinks.parquet import (
    append_table, overwrite_partitions, overwrite_table, replace_landing,
)
from tidelake.sources.csv import csv_scan_with_schema
from tidelake.sources.tables import incremental_table_scan, partitioned_parquet_scan, snapshot_scan
from tidelake.versions import current_folders

BY_MONTH = ["year", "month"]
FIRST, SECOND = "20240101000000", "20240201000000"


@proof("temp_view", "SELECT event_type, event_id, value * 2 AS doubled FROM events")
def view(spark, sf_dir):
    temp_view(table(spark, sf_dir, "events"), "v_proof_events")
    return spark.sql("SELECT event_type, event_id, value * 2 AS doubled FROM v_proof_events")


@proof(
    "overwrite_partitions",
    f"""
    SELECT * REPLACE (CASE year WHEN '1997' THEN o_totalprice + 1 ELSE o_totalprice END
                      AS o_totalprice)
    FROM ({MONTHLY_ORDERS})
    """,
)
def overwrite(spark, sf_dir):
    orders = monthly_orders(spark, sf_dir)
    path = scratch_path(spark)
    overwrite_partitions(orders, path, BY_MONTH)
    raised = orders.filter("year = '1997'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    overwrite_partitions(raised, path, BY_MONTH)
    return partitioned_parquet_scan(spark, path, ORDER_SCHEMA)


@proof(
    "overwrite_partitions_mart",
    f"""
    WITH w AS ({wide_sql(LINE_UNION, NATION_ZONES, hours_sql("orders", "o_orderdate"))}),
    y AS (SELECT *, row_number() OVER (ORDER BY dwid) AS n FROM w WHERE year = '1996')
    SELECT dwid, year, month, tlc_trip_type, pu_do_zone, total_amount FROM w WHERE year <> '1996'
    UNION ALL
    SELECT n + (SELECT count(*) FROM w), year, month, tlc_trip_type, pu_do_zone, total_amount
    FROM y
    """,
)
def overwrite_mart(spark, sf_dir):
    """Write all months, then replace those of one year, which get numbers after all others."""
    lake = new_lake(spark)
    hours = date_hour_dimension_of(table(spark, sf_dir, "orders"), "o_orderdate")
    overwrite_table(hours, lake.path(HOURS))
    build_union_trip(lake, line_feeds(spark, sf_dir), clustered=False)
    for part in (None, {"year": "1996"}):
        build_wide_trip(lake, nation_zones(spark, sf_dir), part, order_by=UNION_COLUMNS)
    return partitioned_parquet_scan(spark, lake.path(WIDE), lake.schema(WIDE)).select(
        "dwid", "year", "month", "tlc_trip_type", "pu_do_zone", "total_amount"
    )


@proof("overwrite_table", "SELECT p_partkey, p_name, p_size + 1 AS p_size FROM part")
def replace_dimension(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    path = scratch_path(spark)
    overwrite_table(parts, path)
    overwrite_table(snapshot_scan(spark, path).withColumn("p_size", F.col("p_size") + 1), path)
    return snapshot_scan(spark, path)


@proof(
    "append_table",
    f"""
    SELECT * FROM ({MONTHLY_ORDERS})
    UNION ALL SELECT * FROM ({MONTHLY_ORDERS}) WHERE o_orderstatus = 'F'
    """,
)
def append(spark, sf_dir):
    orders = monthly_orders(spark, sf_dir)
    path = scratch_path(spark)
    append_table(orders, path, BY_MONTH, rebalance=True)
    append_table(orders.filter("o_orderstatus = 'F'"), path, BY_MONTH, rebalance=True)
    return partitioned_parquet_scan(spark, path, ORDER_SCHEMA)


@proof(
    "precombine",
    """
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
      SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
             o_totalprice, row_number() OVER (
               PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
      FROM orders)
    WHERE n = 1
    """,
)
def newest_order(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("string").alias("o_orderdate"),
        "o_totalprice",
    )
    return precombine(orders, ["o_custkey"], "o_orderdate")


def changed_customers(spark, sf_dir):
    """Customers, and a batch: those in debt pay, those of nation 3 also come under new keys,
    and those of nation 5 move to another segment."""
    customers = table(spark, sf_dir, "customer")
    paid = customers.filter("c_acctbal < 0 AND c_nationkey <> 5").withColumn(
        "c_acctbal", F.lit(0.0)
    )
    new = customers.filter("c_nationkey = 3").withColumn("c_custkey", -1 - F.col("c_custkey"))
    moved = customers.filter("c_nationkey = 5").withColumn("c_mktsegment", F.lit("NEW/HOME"))
    return customers, paid.unionAll(new).unionAll(moved)


CHANGED_CUSTOMERS = """
    SELECT * REPLACE (0.0::DOUBLE AS c_acctbal) FROM customer
      WHERE c_acctbal < 0 AND c_nationkey <> 5
    UNION ALL
    SELECT * REPLACE (-1 - c_custkey AS c_custkey) FROM customer WHERE c_nationkey = 3
    UNION ALL
    SELECT * REPLACE ('NEW/HOME' AS c_mktsegment) FROM customer WHERE c_nationkey = 5
"""

CUSTOMER_SCHEMA = struct_of(
    f"c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, {COMMIT_TIME} string,"
    "c_mktsegment string"
)


def upserted(spark, sf_dir, **options):
    path = scratch_path(spark)
    for instant, batch in zip((FIRST, SECOND), changed_customers(spark, sf_dir)):
        upsert_partitioned(
            batch, path, ["c_custkey"], "c_acctbal", ["c_mktsegment"], instant, **options
        )
    return partitioned_parquet_scan(spark, path, CUSTOMER_SCHEMA)


@proof(
    "upsert_partitioned",
    f"""
    WITH b AS ({CHANGED_CUSTOMERS})
    SELECT *, '{FIRST}' AS _commit_time FROM customer c WHERE NOT EXISTS (
      SELECT 1 FROM b WHERE b.c_custkey = c.c_custkey AND b.c_mktsegment = c.c_mktsegment)
    UNION ALL SELECT *, '{SECOND}' FROM b
    """,
)
def upsert(spark, sf_dir):
    return upserted(spark, sf_dir)


@proof(
    "upsert_partitioned_global_key",
    f"""
    WITH b AS ({CHANGED_CUSTOMERS})
    SELECT *, '{FIRST}' AS _commit_time FROM customer c WHERE NOT EXISTS (
      SELECT 1 FROM b WHERE b.c_custkey = c.c_custkey)
    UNION ALL SELECT *, '{SECOND}' FROM b
    """,
)
def upsert_global(spark, sf_dir):
    return upserted(spark, sf_dir, global_key=True, schema=CUSTOMER_SCHEMA)


@proof(
    "upsert_unpartitioned",
    f"""
    WITH b AS ({CHANGED_CUSTOMERS})
    SELECT *, '{FIRST}' AS _commit_time FROM customer c WHERE NOT EXISTS (
      SELECT 1 FROM b WHERE b.c_custkey = c.c_custkey)
    UNION ALL SELECT *, '{SECOND}' FROM b
    """,
)
def upsert_whole(spark, sf_dir):
    path = scratch_path(spark)
    for instant, batch in zip((FIRST, SECOND), changed_customers(spark, sf_dir)):
        upsert_unpartitioned(batch, path, ["c_custkey"], "c_acctbal", instant)
    return snapshot_scan(spark, path)


@proof(
    "upsert_buckets",
    f"""
    WITH b AS ({CHANGED_CUSTOMERS})
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, '{FIRST}' AS _commit_time
    FROM customer c WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.c_custkey = c.c_custkey)
    UNION ALL
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, '{SECOND}' FROM b
    UNION ALL
    SELECT c_custkey, c_name || '*', c_nationkey, c_acctbal, c_mktsegment, 'taken' FROM b
    """,
)
def upsert_buckets(spark, sf_dir):
    """The same in 16 buckets, and beside it what the second commit brings to a consumer."""
    path = scratch_path(spark)
    for instant, batch in zip((FIRST, SECOND), changed_customers(spark, sf_dir)):
        upsert_unpartitioned(batch, path, ["c_custkey"], "c_acctbal", instant, buckets=16)
    taken = incremental_table_scan(spark, path, None, after=FIRST).withColumns(
        {"c_name": F.concat("c_name", F.lit("*")), COMMIT_TIME: F.lit("taken")}
    )
    return snapshot_scan(spark, path).unionByName(taken)


@proof("stamp_commit", f"SELECT s_suppkey, s_name, '{FIRST}' AS _commit_time FROM supplier")
def stamp(spark, sf_dir):
    return stamp_commit(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), FIRST)


@proof(
    "register_catalog",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, '20240101000000' AS _commit_time,"
    " c_mktsegment FROM customer",
)
def register(spark, sf_dir):
    lake = new_lake(spark)
    create_databases(lake)
    path = f"{lake.root}/dwh/customer"
    upsert_partitioned(
        table(spark, sf_dir, "customer"), path, ["c_custkey"], "c_acctbal", ["c_mktsegment"],
        FIRST,
    )
    name = lake.catalog_name("dwh.customer")
    register_catalog(spark, name, CUSTOMER_SCHEMA, path, ["c_mktsegment"])
    return spark.table(name)


@proof(
    "attach_partition",
    f"""
    SELECT o_orderkey, o_totalprice, year, month FROM ({MONTHLY_ORDERS})
    WHERE year || month <> '199605'
    """,
)
def attach(spark, sf_dir):
    """All months of the ods files become partitions of a dwh table; one is detached again."""
    lake = new_lake(spark)
    create_databases(lake)
    path = f"{lake.root}/ods/orders"
    overwrite_partitions(monthly_orders(spark, sf_dir), path, BY_MONTH)
    name = lake.catalog_name("dwh.orders")
    schema = struct_of("o_orderkey bigint, o_totalprice double, year string, month string")
    register_catalog(spark, name, schema, path, BY_MONTH)
    detach_partition(spark, name, {"year": "1996", "month": "05"})
    june = {"year": "1996", "month": "06"}
    attach_partition(spark, name, june, *current_folders(spark, path, june).values())
    return spark.table(name)


@proof("create_tables", LINE_UNION)
def create(spark, sf_dir):
    """Create the layers, then fill one table of the registry."""
    lake = new_lake(spark)
    create_databases(lake, replace=True)
    create_tables(lake, replace=True)
    name = "dmt.tlc_union_trip"
    overwrite_partitions(
        union_trips(line_feeds(spark, sf_dir)), lake.path(name), lake.table(name).partition_by
    )
    register_catalog(
        spark, lake.catalog_name(name), lake.schema(name), lake.path(name),
        lake.table(name).partition_by,
    )
    return spark.table(lake.catalog_name(name))


@proof("replace_landing", "SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal > 0")
def landing(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    path = scratch_path(spark)
    replace_landing(suppliers, path)
    replace_landing(suppliers.filter("s_acctbal > 0"), path)
    schema = struct_of("s_suppkey bigint, s_name string, s_acctbal double")
    return csv_scan_with_schema(spark, path, schema)


@proof(
    "stripped_partitions",
    "SELECT o_orderkey, o_totalprice, replace(o_orderpriority, '-', '') AS priority FROM orders",
)
def stripped(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", strip_chars(F.col("o_orderpriority"), "-").alias("priority")
    )
    path = scratch_path(spark)
    overwrite_partitions(orders, path, ["priority"])
    schema = struct_of("o_orderkey bigint, o_totalprice double, priority string")
    return partitioned_parquet_scan(spark, path, schema)
