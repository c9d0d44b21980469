"""R1-R6: parameterised steps, jobs and the chains of all layers."""

from pyspark.sql import functions as F

from proofs.frames import (
    LINE_UNION, MONTHLY_ORDERS, NATION_ZONES, UNION_COLUMNS, event_feeds, event_union, hours_sql,
    line_feeds, monthly_orders, nation_zones, new_lake, wide_sql,
)
from proofs.registry import proof, table
from proofs.scans import ORDER_SCHEMA
from tidelake.lake import scratch_path
from tidelake.operators.dimensions import date_hour_dimension_of
from tidelake.plans.build import monthly_build
from tidelake.plans.geo import geo_dimension_chain, load_zones
from tidelake.plans.mart import HOURS, WIDE, trip_mart, union_trips
from tidelake.plans.steps import run_job, run_sql_step
from tidelake.plans.trips import trip_ingest_chain
from tidelake.schemas import TRIP_FEEDS
from tidelake.sinks.catalog import create_databases, create_tables
from tidelake.sinks.parquet import (
    land_domain, overwrite_partitions, overwrite_table, replace_landing,
)
from tidelake.sources.csv import load_csv_as_view
from tidelake.sources.tables import partitioned_parquet_scan


@proof(
    "run_sql_step",
    "SELECT event_id, value * 2.0 AS doubled, '2024' AS year, '01' AS month FROM events"
    " WHERE event_type = 'click'",
)
def sql_step(spark, sf_dir):
    table(spark, sf_dir, "events").createOrReplaceTempView("v_proof_step_source")
    return run_sql_step(
        spark,
        [
            "CREATE OR REPLACE TEMPORARY VIEW v_proof_step AS SELECT event_id, value * 2.0D AS"
            " doubled, event_type, '@year@' AS year, '@month@' AS month FROM v_proof_step_source",
            "SELECT event_id, doubled, year, month FROM v_proof_step WHERE event_type = :kind",
        ],
        {"year": "2024", "month": "01", "kind": "click"},
    )


@proof("source_sql_sink_job", MONTHLY_ORDERS)
def job(spark, sf_dir):
    """Land orders as CSV, load them as a view, add the month in SQL, overwrite partitions."""
    raw, path = scratch_path(spark), scratch_path(spark)
    replace_landing(monthly_orders(spark, sf_dir).drop("year", "month"), raw)
    schema = ORDER_SCHEMA[:6]
    run_job(
        spark,
        source=lambda: load_csv_as_view(spark, "stg.proof_orders", raw, schema),
        statements=[
            "CREATE OR REPLACE TEMPORARY VIEW v_ods_proof_orders AS SELECT *,"
            " substr(o_orderdate, 1, 4) AS year, substr(o_orderdate, 6, 2) AS month"
            " FROM @source@"
        ],
        params={"source": "v_stg_proof_orders"},
        sink=lambda df: overwrite_partitions(df, path, ["year", "month"]),
        sink_view="v_ods_proof_orders",
    )
    return partitioned_parquet_scan(spark, path, ORDER_SCHEMA)


def zone_batches(spark, sf_dir):
    """Customers as zones: all of them, then changed ones, then new ones."""
    zones = (
        table(spark, sf_dir, "customer")
        .select(
            F.col("c_custkey").alias("LocationID"),
            F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("Borough"),
            F.col("c_name").alias("Zone"),
            F.replace(F.col("c_mktsegment"), F.lit("U"), F.lit("/U")).alias("service_zone"),
            "c_acctbal", "c_nationkey",
        )
    )
    changed = zones.filter("c_acctbal < 0").withColumn(
        "Borough", F.concat("Borough", F.lit("-Updated"))
    )
    new = zones.filter("c_nationkey = 3").withColumn("LocationID", -1 - F.col("LocationID"))
    columns = ["LocationID", "Borough", "Zone", "service_zone"]
    return zones.select(*columns), changed.select(*columns), new.select(*columns)


#: Business month and instant of each run: months are built in the following month, January twice.
ZONE_RUNS = ((1, "20200201031500"), (1, "20200205031500"), (2, "20200301031500"))


@proof(
    "geo_dimension_chain",
    """
    WITH z AS (
      SELECT c_custkey AS locationid, 'N' || c_nationkey AS borough, c_name AS zone,
             replace(replace(c_mktsegment, 'U', '/U'), '/', '') AS service_zone, c_acctbal,
             c_nationkey
      FROM customer)
    SELECT locationid, borough, zone, CAST(1 AS BIGINT) AS ts, '2020' AS year, '01' AS month,
           '20200201031500' AS _commit_time, service_zone
    FROM z WHERE c_acctbal >= 0
    UNION ALL
    SELECT locationid, borough || '-Updated', zone, 2, '2020', '01', '20200205031500',
           service_zone
    FROM z WHERE c_acctbal < 0
    UNION ALL
    SELECT -1 - locationid, borough, zone, 3, '2020', '02', '20200301031500', service_zone
    FROM z WHERE c_nationkey = 3
    """,
)
def geo_chain(spark, sf_dir):
    """Three commits, two of them in one month, the last one run twice."""
    lake = new_lake(spark)
    create_databases(lake)
    for ts, (batch, (month, instant)) in enumerate(zip(zone_batches(spark, sf_dir), ZONE_RUNS), 1):
        replace_landing(batch, lake.path("stg.geo_taxi_zone"))
        for _ in range(2 if ts == 3 else 1):
            geo_dimension_chain(lake, 2020, month, instant, ts=ts)
    return spark.table(lake.catalog_name("dmt.geo_dim_taxi_zone"))


LATE_ZONES = """
    SELECT 1000000 + c_custkey AS locationid, 'L' || c_nationkey AS borough, c_name AS zone,
           replace(replace(c_mktsegment, 'U', '/U'), '/', '') AS service_zone
    FROM customer WHERE c_nationkey = {nation}
"""


@proof(
    "geo_late_commits",
    f"""
    WITH z AS (
      SELECT c_custkey AS locationid, 'N' || c_nationkey AS borough, c_name AS zone,
             replace(replace(c_mktsegment, 'U', '/U'), '/', '') AS service_zone, c_acctbal
      FROM customer)
    SELECT locationid, borough, zone, CAST(1 AS BIGINT) AS ts, '2020' AS year, '01' AS month,
           '20200201031500' AS _commit_time, service_zone
    FROM z WHERE c_acctbal >= 0
    UNION ALL
    SELECT locationid, borough || '-Updated', zone, 2, '2020', '02', '20200301031500',
           service_zone
    FROM z WHERE c_acctbal < 0
    UNION ALL
    SELECT locationid, borough, zone, 3, '2020', '01', '20200401031500', service_zone
    FROM ({LATE_ZONES.format(nation=4)})
    UNION ALL
    SELECT locationid, borough, zone, 4, '2020', '03', '20200401031500', service_zone
    FROM ({LATE_ZONES.format(nation=6)})
    """,
)
def geo_late(spark, sf_dir):
    """January and February; a late January file under January's instant; March; January again.

    The late zones come with March, the next run. The rerun of January finds the rows that it wrote
    and those that later months wrote over them, and changes neither.
    """
    lake = new_lake(spark)
    create_databases(lake)
    january, february, _ = zone_batches(spark, sf_dir)
    customers = table(spark, sf_dir, "customer")

    def late(nation):
        return customers.filter(F.col("c_nationkey") == nation).select(
            (F.col("c_custkey") + 1000000).alias("LocationID"),
            F.concat(F.lit("L"), F.col("c_nationkey").cast("string")).alias("Borough"),
            F.col("c_name").alias("Zone"),
            F.replace(F.col("c_mktsegment"), F.lit("U"), F.lit("/U")).alias("service_zone"),
        )

    def land(batch):
        replace_landing(batch, lake.path("stg.geo_taxi_zone"))

    first, second, third = "20200201031500", "20200301031500", "20200401031500"
    land(january)
    geo_dimension_chain(lake, 2020, 1, first, ts=1)
    land(february)
    geo_dimension_chain(lake, 2020, 2, second, ts=2)
    land(late(4))
    load_zones(lake, 2020, 1, first, ts=3)
    land(late(6))
    geo_dimension_chain(lake, 2020, 3, third, ts=4)
    land(january)
    geo_dimension_chain(lake, 2020, 1, first, ts=1)
    return spark.table(lake.catalog_name("dmt.geo_dim_taxi_zone"))


def land_event_feeds(lake, events):
    feeds = event_feeds(events)
    land_domain(lake, "tlc", {f"stg.tlc_{feed}_trip": raw for feed, raw in feeds.items()})


@proof("trip_ingest_chain", event_union())
def ingest_chain(spark, sf_dir):
    """Four CSV feeds become dwh partitions; shown united."""
    lake = new_lake(spark)
    create_databases(lake)
    create_tables(lake)
    land_event_feeds(lake, table(spark, sf_dir, "events"))
    trip_ingest_chain(lake, 2024, 1)
    return union_trips(
        {feed: spark.table(lake.catalog_name(f"dwh.tlc_{feed}_trip")) for feed in TRIP_FEEDS}
    )


@proof("trip_mart", wide_sql(LINE_UNION, NATION_ZONES, hours_sql("orders", "o_orderdate")))
def mart(spark, sf_dir):
    """Feeds -> union table -> wide table, all months."""
    lake = new_lake(spark)
    hours = date_hour_dimension_of(table(spark, sf_dir, "orders"), "o_orderdate")
    overwrite_table(hours, lake.path(HOURS))
    zones = nation_zones(spark, sf_dir)
    trip_mart(
        lake, line_feeds(spark, sf_dir), zones, order_by=UNION_COLUMNS, clustered=False
    )
    return partitioned_parquet_scan(spark, lake.path(WIDE), lake.schema(WIDE))


# Even events a month earlier; of the others one at the end of time and one in an earlier year.
MOVED_EVENTS = """
    (SELECT * REPLACE (CASE WHEN event_id % 2 = 0 THEN ts - INTERVAL 31 DAY
                            WHEN event_id = 1 THEN TIMESTAMP '9999-12-30 10:00:00'
                            WHEN event_id = 3 THEN TIMESTAMP '2022-12-31 23:58:00'
                            ELSE ts END AS ts)
     FROM events {where})
"""
EVEN = MOVED_EVENTS.format(where="WHERE event_id % 2 = 0")
ODD = MOVED_EVENTS.format(where="WHERE event_id % 2 = 1")
STRIPPED_ZONES = NATION_ZONES.replace("replace(r_name, ' ', '/')", "replace(r_name, ' ', '')")
MOVED_ZONES = f"""
    SELECT * REPLACE (CASE WHEN locationid = 3 THEN 'Moved' ELSE service_zone END AS service_zone)
    FROM ({STRIPPED_ZONES})
"""
ALL_HOURS = hours_sql(MOVED_EVENTS.format(where=""), "ts")


@proof(
    "monthly_build",
    f"""
    WITH december AS ({wide_sql(event_union(EVEN, "2023", "12"), STRIPPED_ZONES, ALL_HOURS)}),
    january AS ({wide_sql(event_union(ODD, "2024", "01"), MOVED_ZONES, ALL_HOURS)})
    SELECT * FROM december
    UNION ALL
    SELECT * REPLACE (dwid + (SELECT count(*) FROM december) AS dwid) FROM january
    """,
)
def build(spark, sf_dir):
    """December and January in turn, each in the month after; the second build runs twice.

    The numbers of January follow those of December, also the second time.

    Trips begin in other years than their month's, too. A zone moves to another service zone.
    """
    lake = new_lake(spark)
    create_databases(lake)
    create_tables(lake)
    number, ts = F.col("event_id"), F.col("ts")
    moved = table(spark, sf_dir, "events").withColumn(
        "ts",
        F.when(number % 2 == 0, ts - F.expr("INTERVAL '31' DAY"))
        .when(number == 1, F.lit("9999-12-30 10:00:00").cast("timestamp_ntz"))
        .when(number == 3, F.lit("2022-12-31 23:58:00").cast("timestamp_ntz"))
        .otherwise(ts),
    )
    zones = nation_zones(spark, sf_dir)
    landed = F.when(F.col("locationid") == 3, "Moved").otherwise(F.col("service_zone"))
    months = (
        (2023, 12, "20240101031500", 0, zones),
        (2024, 1, "20240201031500", 1, zones.withColumn("service_zone", landed)),
    )
    for year, month, instant, odd, own in months:
        land_event_feeds(lake, moved.filter(number % 2 == odd))
        replace_landing(own, lake.path("stg.geo_taxi_zone"))
        for _ in range(1 + odd):
            monthly_build(
                lake, year, month, instant, ts=1, order_by=UNION_COLUMNS, global_key=True
            )
    return spark.table(lake.catalog_name(WIDE))
