"""S1-S9 and L1: reading, sampling and previewing."""

from pyspark.sql import functions as F

from proofs.frames import MONTHLY_ORDERS, monthly_orders, new_lake
from proofs.registry import proof, table
from tidelake.lake import open_partitions, scratch_path, stage
from tidelake.operators.keyed import incremental_scan, scan_since_latest_commit
from tidelake.operators.numbering import preview, sample_by_key, sample_every_nth
from tidelake.operators.project import null_pad
from tidelake.schemas import COMMIT_TIME, struct_of
from tidelake.sinks.catalog import register_catalog
from tidelake.sinks.keyed import upsert_unpartitioned
from tidelake.sinks.parquet import overwrite_partitions, replace_landing
from tidelake.sources.csv import (
    csv_scan_with_schema, found_types, infer_merge_schema, sample_lines, widened_schema,
)
from tidelake.sources.tables import catalog_scan, partitioned_parquet_scan, snapshot_scan

ORDER_SCHEMA = struct_of(
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    "o_orderdate string, o_orderpriority string, year string, month string"
)


@proof(
    "csv_scan_with_schema",
    "SELECT l_orderkey AS order_id, l_partkey AS part_id, l_quantity AS quantity,"
    " l_returnflag AS flag, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipped FROM lineitem",
)
def csv_scan(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("OrderID"), F.col("l_partkey").alias("PartID"), "l_quantity",
        "l_returnflag", F.col("l_shipdate").cast("string").alias("Shipped"),
    )
    path = scratch_path(spark)
    replace_landing(raw, path)
    schema = struct_of(
        "order_id bigint, part_id bigint, quantity double, flag string, shipped string"
    )
    return csv_scan_with_schema(spark, path, schema)


@proof("catalog_scan", MONTHLY_ORDERS)
def catalog(spark, sf_dir):
    lake = new_lake(spark)
    path = f"{lake.root}/orders"
    overwrite_partitions(monthly_orders(spark, sf_dir), path, ["year", "month"])
    spark.sql(f"CREATE DATABASE `{lake.database('ods')}` LOCATION '{lake.root}/ods'")
    name = lake.catalog_name("ods.orders")
    register_catalog(spark, name, ORDER_SCHEMA, path, ["year", "month"])
    return catalog_scan(spark, name)


@proof("partitioned_parquet_scan", MONTHLY_ORDERS)
def partitioned(spark, sf_dir):
    path = scratch_path(spark)
    overwrite_partitions(monthly_orders(spark, sf_dir), path, ["year", "month"])
    return partitioned_parquet_scan(spark, path, ORDER_SCHEMA)


def committed_orders(spark, sf_dir):
    """Orders as a table to which each order month was one commit."""
    orders = monthly_orders(spark, sf_dir).drop("month")
    instant = F.concat(F.translate(F.substring("o_orderdate", 1, 7), "-", ""), F.lit("01000000"))
    path = scratch_path(spark)
    overwrite_partitions(orders.withColumn(COMMIT_TIME, instant), path, ["year"])
    schema = struct_of(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        f"o_orderdate string, o_orderpriority string, {COMMIT_TIME} string, year string"
    )
    return partitioned_parquet_scan(spark, path, schema)


COMMITTED_ORDERS = f"""
    SELECT * EXCLUDE (month), strftime(o_orderdate::TIMESTAMP, '%Y%m') || '01000000'
      AS _commit_time
    FROM ({MONTHLY_ORDERS})
"""


@proof(
    "incremental_scan",
    f"""
    WITH t AS ({COMMITTED_ORDERS})
    SELECT * FROM t WHERE _commit_time IN (
      SELECT DISTINCT _commit_time FROM t WHERE _commit_time > '19980101000000'
      ORDER BY 1 LIMIT 12)
    """,
)
def incremental(spark, sf_dir):
    return incremental_scan(committed_orders(spark, sf_dir), "19980101000000", max_commits=12)


@proof(
    "scan_since_latest_commit",
    f"""
    WITH t AS ({COMMITTED_ORDERS})
    SELECT * FROM t WHERE _commit_time > (
      SELECT max(_commit_time) FROM t WHERE _commit_time < '19990615000000')
    """,
)
def since_latest(spark, sf_dir):
    orders = committed_orders(spark, sf_dir)
    seen = orders.filter(F.col(COMMIT_TIME) < "19990615000000")
    return scan_since_latest_commit(orders, known=seen)


@proof(
    "incremental_partition_glob",
    f"""
    SELECT * FROM ({COMMITTED_ORDERS})
    WHERE _commit_time > '19980601000000' AND year IN ('1998', '1999')
    """,
)
def partition_glob(spark, sf_dir):
    return incremental_scan(
        committed_orders(spark, sf_dir), "19980601000000",
        where=F.col("year").isin("1998", "1999"),
    )


@proof(
    "snapshot_scan",
    """
    SELECT c_custkey, c_name, c_nationkey,
           CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal, c_mktsegment,
           CASE WHEN c_acctbal < 0 THEN '20240201000000' ELSE '20240101000000' END
             AS _commit_time
    FROM customer
    """,
)
def snapshot(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    path = scratch_path(spark)
    upsert_unpartitioned(customers, path, ["c_custkey"], "c_acctbal", "20240101000000")
    cleared = customers.filter("c_acctbal < 0").withColumn("c_acctbal", F.lit(0.0))
    upsert_unpartitioned(cleared, path, ["c_custkey"], "c_acctbal", "20240201000000")
    return snapshot_scan(spark, path)


@proof(
    "infer_merge_schema",
    "SELECT l_orderkey, CAST(NULL AS VARCHAR) AS l_comment, l_partkey, l_quantity,"
    " l_extendedprice, l_linestatus FROM lineitem",
)
def infer(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("L_OrderKey"), "l_partkey", "l_quantity", "l_extendedprice",
        "l_linestatus",
    )
    root = scratch_path(spark)
    replace_landing(raw, f"{root}/lines")
    found = infer_merge_schema(spark, root, "tpch", ["lines"])["tpch_lines"]
    known = {"tpch_lines": struct_of("l_orderkey bigint, l_comment string, l_partkey bigint")}
    merged = infer_merge_schema(spark, root, "tpch", ["lines"], known)["tpch_lines"]
    rows = null_pad(csv_scan_with_schema(spark, f"{root}/lines", found), merged)
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in merged]).withColumns(
        {"l_partkey": F.col("l_partkey").cast("bigint")}
    )


@proof(
    "widen_types",
    """
    SELECT CAST(o_orderkey AS INTEGER) AS k, CAST(CASE p WHEN 0 THEN o_custkey
        WHEN 1 THEN o_custkey * 10000000000 ELSE o_totalprice END AS DOUBLE) AS v,
      CASE p WHEN 1 THEN o_custkey * 10000000000 ELSE o_custkey END AS u,
      CASE p WHEN 2 THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR) END AS w
    FROM (SELECT *, o_orderkey % 3 AS p FROM orders)
    """,
)
def widen(spark, sf_dir):
    """Three folders of integers, large integers, and decimals with text, under a schema of integers."""
    key, part = F.col("o_custkey"), F.col("o_orderkey") % 3
    large = (key * 10_000_000_000).cast("string")
    small = key.cast("string")
    root = scratch_path(spark)
    mixed = table(spark, sf_dir, "orders").select(
        part.alias("part"), F.col("o_orderkey").alias("K"),
        F.when(part == 0, small).when(part == 1, large)
        .otherwise(F.col("o_totalprice").cast("string")).alias("V"),
        F.when(part == 1, large).otherwise(small).alias("U"),
        F.when(part == 2, F.col("o_orderpriority")).otherwise(small).alias("W"),
    ).hint("rebalance", "part")  # a part that is too large for one task becomes several files
    with open_partitions(spark):
        mixed.write.partitionBy("part").option("header", True).csv(f"{root}/mixed")
    known = {"raw_mixed": struct_of("k int, v int, u int, w int")}
    files = [f"part={i}" for i in range(3)]
    for name in files:  # file by file, as months come in
        known["raw_mixed"] = widened_schema(
            found_types(spark, f"{root}/mixed/{name}"), known["raw_mixed"]
        )
    return csv_scan_with_schema(spark, f"{root}/mixed/part=*", known["raw_mixed"])


@proof(
    "sample_every_nth",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM (
      SELECT *, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders)
    WHERE n % 100 = 0
    """,
)
def every_nth(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sample_every_nth(orders, 100, ["o_orderkey"], unique=True, is_scan=True)


@proof("sample_by_key", None)
def every_nth_key(spark, sf_dir):
    """Orders and their lines: both tables' samples hold the same orders."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    sampled = sample_by_key(orders, 100, ["o_orderkey"])
    return sampled.join(
        sample_by_key(lines, 100, ["l_orderkey"]), F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )


@proof(
    "sample_lines",
    """
    SELECT value FROM (
      SELECT o_orderkey || '|' || o_custkey || '|' || o_orderpriority AS value,
             row_number() OVER (PARTITION BY o_orderkey % 3 ORDER BY o_orderkey) AS line
      FROM orders)
    WHERE line % 100 = 0
    """,
)
def every_nth_line(spark, sf_dir):
    """Three raw files, each read in several blocks; lines count from 1 in each file."""
    path = scratch_path(spark)
    line = F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderpriority")
    raw = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") % 3).alias("part"), "o_orderkey", line.alias("value")
    )
    one_file_each = raw.repartition(3, "part").sortWithinPartitions("part", "o_orderkey")
    one_file_each.select("part", "value").write.partitionBy("part").text(path)
    block = "spark.sql.files.maxPartitionBytes"
    usual = spark.conf.get(block)
    spark.conf.set(block, "16k")
    try:
        return stage(sample_lines(spark, path, 100))
    finally:
        spark.conf.set(block, usual)


@proof(
    "preview",
    "SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id LIMIT 1",
)
def first_row(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return preview(events, 1, ["event_id"])
