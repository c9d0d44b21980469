import pytest
from pyspark.sql import functions as F

from tidelake.lake import path_exists, scratch_path, table_path, view_name
from tidelake.operators.keyed import latest_commit
from tidelake.plans.build import (
    build_date_dimension, jobs, load_date_dimension, monthly_build,
)
from tidelake.plans.geo import (
    DMT, DWH, ODS, STG, conform_zones, geo_dimension_chain, load_zones,
)
from tidelake.plans.mart import HOURS, UNION, WIDE, join_hour_dim, trip_mart, widen_trips
from tidelake.plans.steps import run_job, run_sql_step
from tidelake.plans.trips import dwh_trips, ingest_feed, trip_ingest_chain
from tidelake.schemas import TABLES
from tidelake.sinks.catalog import (
    attach_partition, create_databases, create_table, create_tables, detach_partition,
    drop_tables, register_catalog,
)
from tidelake.sinks.parquet import land_domain, overwrite_partitions, replace_landing
from tidelake.sources.tables import catalog_scan, partitioned_parquet_scan, snapshot_scan
from tidelake.versions import current_folders


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


def stored_hours(lake):
    return partitioned_parquet_scan(lake.spark, lake.path(HOURS), lake.schema(HOURS))


def test_names_and_paths():
    assert table_path("/r", "stg.geo_taxi_zone") == "/r/stg/geo/taxi_zone"
    assert table_path("/r", "ods.geo_taxi_zone") == "/r/ods/geo_taxi_zone"
    assert view_name("ods.geo_taxi_zone") == "v_ods_geo_taxi_zone"


def test_scratch_lies_in_the_named_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark).startswith(root)
    assert scratch_path(spark) != scratch_path(spark)
    assert not path_exists(spark, scratch_path(spark))


def test_sql_step(spark):
    spark.range(5).createOrReplaceTempView("t_numbers")
    result = run_sql_step(
        spark,
        ["CREATE OR REPLACE TEMPORARY VIEW t_big AS SELECT * FROM @from@ WHERE id > 1",
         "SELECT id, :tag AS tag FROM t_big WHERE id < :top"],
        {"from": "t_numbers", "top": 4, "tag": "it's; a = b"},
    )
    assert rows(result) == [(2, "it's; a = b"), (3, "it's; a = b")]
    with pytest.raises(KeyError):
        run_sql_step(spark, ["SELECT '@missing@'"], {})
    assert run_sql_step(spark, []) is None


def test_job_stops_at_the_first_error(spark, path):
    def sink(df):
        df.write.parquet(path)

    run_job(spark, lambda: spark.range(3).createOrReplaceTempView("t_job"), sink=sink, sink_view="t_job")
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception):
        run_job(spark, sink=sink, sink_view="t_job")  # the path exists


def zones(spark, *data):
    return spark.createDataFrame(
        list(data), "LocationID bigint, Borough string, Zone string, service_zone string"
    )


def two_months(lake, **options):
    spark = lake.spark
    create_databases(lake)
    january = zones(
        spark, (1, "EWR", "Newark", "EWR"), (2, "Queens", "Bay", "Boro Zone"),
        (264, "Unknown", "NV", "N/A"),
    )
    february = zones(
        spark, (1, "EWR-Updated", "Newark", "EWR"), (2, "Queens", "Bay", "Yellow Zone"),
        (266, "New", "W", "Boro Zone"),
    )
    for month, batch in ((1, january), (2, february)):
        replace_landing(batch, lake.path(STG))
        geo_dimension_chain(lake, 2020, month, f"20200{month}15000000", ts=month, **options)


def test_two_months_of_zones(lake):
    two_months(lake)
    spark = lake.spark
    ods = spark.table(lake.catalog_name(ODS))
    assert rows(ods, "locationid", "month") == [
        (1, "01"), (1, "02"), (2, "01"), (2, "02"), (264, "01"), (266, "02"),
    ]
    state = rows(spark.table(lake.catalog_name(DWH)), "locationid", "borough", "ts", "month")
    assert state == [
        (1, "EWR-Updated", 2, "02"), (2, "Queens", 2, "02"), (264, "Unknown", 1, "01"),
        (266, "New", 2, "02"),
    ]
    assert rows(snapshot_scan(spark, lake.path(DWH)), "locationid", "borough", "ts", "month") == state
    mart = rows(spark.table(lake.catalog_name(DMT)), "locationid", "service_zone")
    assert mart == [
        (1, "EWR"), (2, "Boro Zone"), (2, "Yellow Zone"), (264, "NA"), (266, "Boro Zone"),
    ]


def test_zones_with_a_global_key(lake):
    two_months(lake, global_key=True)
    mart = lake.spark.table(lake.catalog_name(DMT))
    assert rows(mart, "locationid", "service_zone") == [
        (1, "EWR"), (2, "Yellow Zone"), (264, "NA"), (266, "Boro Zone"),
    ]


def feed_rows(lake):
    def raw(feed, **values):
        schema = lake.schema(f"stg.tlc_{feed}_trip")
        data = {"pulocationid": 1, "dolocationid": 2, "sr_flag": None, **values}
        return lake.spark.createDataFrame([tuple(data.get(f.name) for f in schema)] * 2, schema)

    times = ("2020-01-05 10:00:00", "2020-01-05 10:30:00")
    return {
        "stg.tlc_yellow_trip": raw(
            "yellow", tpep_pickup_datetime=times[0], tpep_dropoff_datetime=times[1],
            trip_distance=3.5, total_amount=21.0, store_and_fwd_flag="Y",
        ),
        "stg.tlc_green_trip": raw(
            "green", lpep_pickup_datetime=times[0], lpep_dropoff_datetime=times[0],
            trip_distance=0.0, total_amount=21.0, ehail_fee="",
        ),
        "stg.tlc_fhv_trip": raw(
            "fhv", pickup_datetime=times[0], dropoff_datetime=times[1], sr_flag="1",
            affiliated_base_number="B1",
        ),
        "stg.tlc_fhvhv_trip": raw(
            "fhvhv", pickup_datetime="2020-03-01 00:00:00", dropoff_datetime=times[1],
            hvfhs_license_num="HV",
        ),
    }


def prepared(lake):
    create_databases(lake)
    create_tables(lake)
    land_domain(lake, "tlc", feed_rows(lake))
    replace_landing(
        zones(lake.spark, (1, "A", "Z1", "S/1"), (2, "B", "Z2", "S2")), lake.path(STG)
    )


def test_ingest(lake):
    prepared(lake)
    trip_ingest_chain(lake, 2020, 1)
    trip_ingest_chain(lake, 2020, 1)
    dwh = lake.spark.table(lake.catalog_name("dwh.tlc_fhv_trip"))
    assert "affiliated_base_number" not in dwh.columns
    assert rows(dwh, "sr_flag", "year", "month") == [("1", "2020", "01")] * 2
    ods = lake.spark.table(lake.catalog_name("ods.tlc_fhv_trip"))
    assert rows(ods, "affiliated_base_number") == [("B1",)] * 2
    assert dwh.inputFiles() == ods.inputFiles()
    assert rows(dwh_trips(lake, "fhv")) == rows(dwh)
    ingest_feed(lake, "fhv", 2020, 9)
    assert dwh_trips(lake, "fhv").filter("month = '09'").count() == 2


def test_monthly_build(lake):
    prepared(lake)
    for _ in range(2):
        monthly_build(lake, 2020, 1, "20200102000000", ts=1, hours=("2020-01-01", "2020-01-31 23:00:00"))
    wide = lake.spark.table(lake.catalog_name(WIDE))
    assert wide.columns == TABLES[WIDE].schema.names
    # The fhvhv trips begin in other months; their hours are added.
    assert sorted(r.dwid for r in wide.collect()) == [1, 2, 3, 4, 5, 6, 7, 8]
    by_type = {r.tlc_trip_type: r for r in wide.collect()}
    yellow, green, fhv = (by_type[k] for k in ("yellow", "green", "fhv"))
    assert (yellow.travel_distance_rank, yellow.travel_time, yellow.travel_time_rank) == (
        "3-4 Miles", 30.0, "20-30 Minutes",
    )
    assert (yellow.travel_average_speed, yellow.travel_average_speed_rank) == (7.0, "5-10 Miles/Hour")
    assert (yellow.time_profit_rate, yellow.distance_profit_rate) == (0.7, 6.0)
    assert (yellow.pu_do_zone, yellow.pu_service_zone) == ("Z1 -> Z2", "S1")
    assert (yellow.hour_dwid, yellow.day_name, yellow.weekend_flag) == (2020010510, "Sunday", True)
    assert (yellow.store_and_fwd_flag, yellow.year, yellow.month) == ("Y", "2020", "01")
    assert green.travel_average_speed is None and green.time_profit_rate is None
    assert green.distance_profit_rate is None and green.ehail_fee is None
    assert fhv.time_profit_rate is None and fhv.travel_distance_rank is None and fhv.sr_flag == "1"
    assert lake.spark.table(lake.catalog_name(UNION)).count() == 8


def test_a_failing_step_stops_the_build(lake):
    create_databases(lake)
    create_tables(lake)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        monthly_build(lake, 2020, 1, "20200102000000")
    assert not path_exists(lake.spark, lake.path(WIDE))


def test_the_mart_of_one_month_leaves_others(lake):
    spark = lake.spark
    build_date_dimension(lake, hours=("2020-01-01", "2020-12-31 23:00:00"))
    dim = zones(spark, (1, "A", "Z1", "S1"), (2, "B", "Z2", "S2"))
    schema = TABLES["dwh.tlc_fhv_trip"].schema
    trips = spark.createDataFrame(
        [(None, f"2020-0{m}-01 00:00:00", None, 1, 2, None, "2020", f"0{m}") for m in (1, 2, 2)],
        schema,
    )
    trip_mart(lake, {"fhv": trips}, dim)
    wide = partitioned_parquet_scan(spark, lake.path(WIDE), lake.schema(WIDE))
    assert rows(wide, "month") == [("01",), ("02",), ("02",)]
    fewer = trips.dropDuplicates(["month"])
    trip_mart(lake, {"fhv": fewer}, dim, {"year": "2020", "month": "02"})
    wide = partitioned_parquet_scan(spark, lake.path(WIDE), lake.schema(WIDE))
    assert rows(wide, "month") == [("01",), ("02",)]
    with pytest.raises(ValueError):
        trip_mart(lake, {"bus": trips}, dim)


def test_hours_may_come_from_csv(lake):
    build_date_dimension(lake, hours=("2020-01-01", "2020-01-01 23:00:00"))
    hours = stored_hours(lake)
    want = rows(hours)
    replace_landing(hours, lake.path("stg.pub_dim_date"))
    load_date_dimension(lake)
    assert rows(stored_hours(lake)) == want


def test_hours_are_added_and_a_landed_calendar_goes_first(lake):
    spark = lake.spark
    build_date_dimension(lake, hours=("2019-05-01", "2019-05-01 02:00:00"))
    landed = stored_hours(lake).filter("hour = 1").withColumn(
        "day_name", F.lit("Holiday")
    )
    replace_landing(landed, lake.path("stg.pub_dim_date"))
    times = spark.createDataFrame(
        [("2019-12-31 23:58:00",), ("9999-01-01 00:00:00",), ("soon",), (None,)], "t string"
    )
    build_date_dimension(lake, times, "t")
    hours = stored_hours(lake)
    assert hours.count() == 3 + 2 * 744 == hours.select("dwid").distinct().count()
    assert rows(hours.filter("year = 2019 AND month = 5"), "hour", "day_name") == [
        (0, "Wednesday"), (1, "Holiday"), (2, "Wednesday"),
    ]
    # Trips are joined with hours of any of these years.
    trips = times.withColumnRenamed("t", "pickup_datetime")
    assert join_hour_dim(trips, hours).count() == 2


def test_a_build_writes_only_the_years_that_gain_hours(lake):
    path, spark = lake.path(HOURS), lake.spark
    build_date_dimension(lake, hours=("2019-12-31", "2020-01-01 23:00:00"))
    before = current_folders(spark, path)
    assert set(before) == {"year=2019", "year=2020"}
    times = spark.createDataFrame([("2020-01-15 10:00:00",), ("2020-01-01 00:00:00",)], "t string")
    build_date_dimension(lake, times, "t")
    after = current_folders(spark, path)
    assert after["year=2019"] == before["year=2019"] and after["year=2020"] != before["year=2020"]
    assert stored_hours(lake).count() == 24 + 744
    build_date_dimension(lake, times, "t")  # nothing is missing: nothing is written
    assert current_folders(spark, path) == after
    landed = stored_hours(lake).filter("dwid = 2019123105").withColumn("week", F.lit(99))
    replace_landing(landed, lake.path("stg.pub_dim_date"))
    build_date_dimension(lake, times, "t")
    assert stored_hours(lake).filter("week = 99").count() == 1
    assert current_folders(spark, path)["year=2020"] == after["year=2020"]
    load_date_dimension(lake)  # the landed calendar alone
    assert stored_hours(lake).count() == 1


def test_a_zone_that_occurs_twice_is_an_error_unless_allowed(spark):
    dim = zones(spark, (1, "A", "Z1", "S1"), (1, "A", "Z1", "S2"), (2, "B", "Z2", "S2"))
    trips = spark.createDataFrame(
        [("t", "2020-01-01 00:00:00", "2020-01-01 00:10:00", 1.0, 2.0, 1, 2)],
        "tlc_trip_type string, pickup_datetime string, dropoff_datetime string,"
        "trip_distance double, total_amount double, pulocationid bigint, dolocationid bigint",
    )
    with pytest.raises(ValueError, match="twice"):
        widen_trips(trips, dim)
    assert widen_trips(trips, dim, repeated_zones=True).count() == 2


def test_commits_are_consumed_once_each(lake):
    """Two commits wait; one is taken at a time, then none is left."""
    spark = lake.spark
    create_databases(lake)
    for i, instant in enumerate(("20200201000000", "20200202000000"), 1):
        replace_landing(zones(spark, (i, "A", f"Z{i}", "S"), (9, "A", f"Z{i}", "S")),
                        lake.path("stg.geo_taxi_zone"))
        load_zones(lake, 2020, i, instant, ts=i)
    state = lambda: rows(
        snapshot_scan(spark, lake.path("dwh.geo_taxi_zone")), "locationid", "zone")
    conform_zones(lake, "20200301000000", max_commits=1)
    assert state() == [(1, "Z1"), (9, "Z1")]
    for _ in range(2):  # a rerun takes the same commit again
        conform_zones(lake, "20200302000000", max_commits=1)
        assert state() == [(1, "Z1"), (2, "Z2"), (9, "Z2")]
    conform_zones(lake, "20200303000000")
    assert state() == [(1, "Z1"), (2, "Z2"), (9, "Z2")]


def test_partitions_are_attached_without_a_copy(lake):
    spark = lake.spark
    create_databases(lake, replace=True)
    path = f"{lake.root}/ods/t"
    schema = TABLES["dwh.tlc_fhv_trip"].schema
    data = spark.createDataFrame(
        [("B", "t", "t", 1, 2, None, "2020", m) for m in ("01", "02")], schema
    ).withColumn("extra", F.lit(1))
    overwrite_partitions(data, path, ["year", "month"])
    name = lake.catalog_name("dwh.t")
    create_table(spark, name, schema, path, ["year", "month"])
    assert catalog_scan(spark, name).count() == 0
    january = {"year": "2020", "month": "01"}
    for _ in range(2):
        attach_partition(spark, name, january, *current_folders(spark, path, january).values())
    assert rows(catalog_scan(spark, name), "month") == [("01",)]
    assert "extra" not in catalog_scan(spark, name).columns
    detach_partition(spark, name, january)
    detach_partition(spark, name, january)
    assert catalog_scan(spark, name).count() == 0
    assert spark.read.parquet(path).count() == 2
    register_catalog(spark, name, schema, path, ["year", "month"])
    assert catalog_scan(spark, name).count() == 2
    drop_tables(spark, [name, lake.catalog_name("dwh.none")])
    assert not spark.catalog.tableExists(name)


def test_registering_follows_a_changed_schema(lake):
    spark = lake.spark
    create_databases(lake)
    path, name = f"{lake.root}/dwh/u", lake.catalog_name("dwh.u")
    spark.range(2).write.parquet(path)
    register_catalog(spark, name, spark.read.parquet(path).schema, path)
    spark.range(3).withColumn("v", F.lit("a")).write.mode("overwrite").parquet(path)
    register_catalog(spark, name, spark.read.parquet(path).schema, path)
    assert rows(spark.table(name)) == [(0, "a"), (1, "a"), (2, "a")]


def test_incremental_consumption_by_the_last_instant(lake):
    """A late build names the last instant consumed, so no commit is read twice."""
    spark = lake.spark
    create_databases(lake)
    after = "0"
    for month in (1, 2):
        replace_landing(zones(spark, (month, f"b{month}", "z", "s")), lake.path(STG))
        instant = f"2021030{month}000000"
        geo_dimension_chain(lake, 2020, month, instant, after=after, ts=month)
        after = latest_commit(partitioned_parquet_scan(spark, lake.path(ODS), lake.schema(ODS)))
    assert rows(snapshot_scan(spark, lake.path(DWH)), "locationid", "borough") == [
        (1, "b1"), (2, "b2"),
    ]


def test_single_jobs_make_the_same_mart_as_the_build(lake):
    prepared(lake)
    hours = ("2020-01-01", "2020-01-31 23:00:00")
    monthly_build(lake, 2020, 1, "20200102000000", ts=1, hours=hours)
    columns = [c for c in TABLES[WIDE].schema.names if c != "dwid"]
    want = rows(lake.spark.table(lake.catalog_name(WIDE)), *columns)
    replace_landing(stored_hours(lake), lake.path("stg.pub_dim_date"))
    steps = jobs(lake, 2020, 1, "20200102000000", ts=1)
    assert len(steps) == 29
    order = [n for n in steps if n.endswith("_create")]
    order += [n for n in steps if not n.endswith("_create")]
    for name in order:
        steps[name]()
    assert rows(lake.spark.table(lake.catalog_name(WIDE)), *columns) == want


@pytest.mark.parametrize("limit", [None, 0])
def test_ordered_wide_trips_are_gathered_while_short(spark, monkeypatch, limit):
    """And not at all in place of a dimension that must be shuffled; the rows are the same."""
    import contextlib
    import io

    from tidelake.plans import mart

    schema = TABLES["dmt.tlc_union_trip"].schema
    blank = {f.name: None for f in schema}
    trips = [
        {**blank, "tlc_trip_type": kind, "pickup_datetime": f"2020-0{1 + i % 2}-01 0{i % 5}:00:00",
         "dropoff_datetime": "2020-03-01 00:00:00", "pulocationid": i % 4, "dolocationid": 1,
         "year": "2020", "month": f"0{1 + i % 2}"}
        for i, kind in enumerate(["yellow", "green"] * 20)
    ]
    df = spark.createDataFrame([tuple(t[f.name] for f in schema) for t in trips], schema)
    zones = spark.createDataFrame(
        [(i, "b", f"z{i}", "s") for i in range(3)],
        "locationid bigint, borough string, zone string, service_zone string",
    )
    hours = spark.createDataFrame(
        [(2020000100 + m * 10000 + h, "d", 1, h, 1, 1, "n", "n", True) for m in (1, 2) for h in range(4)],
        "dwid bigint, db_date string, day int, hour int, quarter int, week int, day_name string,"
        " month_name string, weekend_flag boolean",
    )
    if limit is not None:
        monkeypatch.setattr("tidelake.operators.joins.BROADCAST_BYTES", limit)
    order = ["tlc_trip_type", "pickup_datetime", "pulocationid"]
    wide = mart.wide_trips(df, zones, hours, order_by=order, gather=["year", "month"])
    known = [t for t in trips if t["pulocationid"] < 3 and int(t["pickup_datetime"][12]) < 4]
    want = sorted(tuple(t[c] for c in order) for t in known)
    rows = sorted(wide.collect(), key=lambda r: r.dwid)
    assert [r.dwid for r in rows] == list(range(1, len(known) + 1))
    assert [tuple(r[c] for c in order) for r in rows] == want
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        wide.explain()
    plan = out.getvalue()
    shuffle = plan.index("REBALANCE_PARTITIONS_BY_COL")
    assert (plan.index("Join") < shuffle) == (limit is None)  # a plan is read from its end
