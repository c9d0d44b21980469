import pytest
from pyspark.sql import functions as F

from tidelake.operators.dimensions import date_hour_dimension, date_hour_dimension_of
from tidelake.operators.project import (
    conform, exclude_columns, null_pad, project_rename, star_append, tag_literal,
)
from tidelake.operators.union import union_sources
from tidelake.plans.mart import union_trips
from tidelake.schemas import TABLES, struct_of, union_trip_schema


def test_projections(spark):
    df = spark.createDataFrame([(1, "a")], "id bigint, name string")
    assert project_rename(df, {"name": "n", "id": "i"}).first().asDict() == {"n": "a", "i": 1}
    assert tag_literal(df, "kind", "x").columns == ["kind", "id", "name"]
    assert star_append(df, {"year": "2020", "twice": F.col("id") * 2}).first().twice == 2
    padded = null_pad(df, struct_of("v double, id bigint"))
    assert padded.first().asDict() == {"v": None, "id": 1}
    assert padded.dtypes == [("v", "double"), ("id", "bigint")]
    assert exclude_columns(df.withColumn("_commit_time", F.lit("1"))).columns == ["id", "name"]
    assert exclude_columns(df, "na").columns == ["id", "name"]


def test_conform_casts_what_it_can(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "x", 7), ("Y", "", None, 8), ("1.9", "1e2", "y", 9), ("-1.9", None, "", 1)],
        "a string, b string, c string, d bigint",
    )
    schema = struct_of("p bigint, q double, r string, s string")
    rows = [tuple(r) for r in conform(df, schema, by_position=True).collect()]
    assert rows == [
        (1, 1.5, "x", "7"), (None, None, None, "8"), (1, 100.0, "y", "9"), (-1, None, "", "1"),
    ]
    with pytest.raises(ValueError):
        conform(df, struct_of("p bigint"), by_position=True)


def feeds(spark):
    def frame(feed, **values):
        schema = TABLES[f"dwh.tlc_{feed}_trip"].schema
        row = tuple(values.get(f.name) for f in schema)
        return spark.createDataFrame([row], schema)

    return {
        "yellow": frame(
            "yellow", tpep_pickup_datetime="2020-01-01 00:00:00", store_and_fwd_flag="Y",
            year="2020", month="01", vendorid=1,
        ),
        "green": frame(
            "green", lpep_pickup_datetime="2020-01-02 00:00:00", ehail_fee="1.5", trip_type=2,
            year="2020", month="01",
        ),
        "fhv": frame("fhv", pickup_datetime="2020-01-03 00:00:00", sr_flag="1", year="2020"),
        "fhvhv": frame("fhvhv", hvfhs_license_num="HV", sr_flag=1, month="02"),
    }


def test_union_of_four_feeds(spark):
    sources = feeds(spark)
    united = union_trips(sources)
    assert united.columns == TABLES["dmt.tlc_union_trip"].schema.names
    assert dict(united.dtypes)["store_and_fwd_flag"] == "string"
    rows = {r.tlc_trip_type: r for r in united.collect()}
    assert rows["yellow"].pickup_datetime == "2020-01-01 00:00:00"
    assert rows["yellow"].store_and_fwd_flag == "Y" and rows["yellow"].ehail_fee is None
    assert rows["green"].ehail_fee == 1.5 and rows["green"].trip_type == 2
    assert rows["fhv"].sr_flag == "1" and rows["fhv"].vendorid is None
    assert rows["fhvhv"].sr_flag == "1" and rows["fhvhv"].month == "02"


def test_union_keeps_duplicates_and_the_numeric_flag_is_null(spark):
    yellow = feeds(spark)["yellow"]
    united = union_sources(
        {"yellow": yellow.unionAll(yellow)}, union_trip_schema(flag_as_text=False), "tlc_trip_type"
    )
    assert [r.store_and_fwd_flag for r in united.collect()] == [None, None]


def test_hours(spark):
    hours = date_hour_dimension(spark, "2020-02-28 22:00:00", "2020-03-01 01:00:00")
    rows = [r.asDict() for r in hours.orderBy("dwid").collect()]
    assert len(rows) == 28  # 2020 is a leap year
    assert rows[2] == {
        "dwid": 2020022900, "db_date": "2020-02-29", "year": 2020, "month": 2, "day": 29,
        "hour": 0, "quarter": 1, "week": 9, "day_name": "Saturday", "month_name": "February",
        "weekend_flag": True,
    }
    assert rows[0]["weekend_flag"] is False
    assert hours.schema.names == TABLES["dmt.pub_dim_date"].schema.names


def test_hours_have_no_gap_where_clocks_change(spark):
    hours = date_hour_dimension(spark, "2020-03-08", "2020-03-08 23:00:00")
    assert [r.hour for r in hours.orderBy("dwid").collect()] == list(range(24))


def test_hours_of_a_column_cover_whole_months(spark):
    df = spark.createDataFrame([("2020-01-31 10:00:00",), ("2020-02-01 00:00:00",)], "t string")
    hours = date_hour_dimension_of(df, "t")
    assert hours.count() == (31 + 29) * 24
    assert date_hour_dimension_of(df.limit(0), "t").count() == 0
