import contextlib
import io

import pytest
from pyspark.sql import functions as F

from tidelake.operators import joins
from tidelake.operators.joins import (
    hot_keys, join_dimension, measured, rows_without, size_in_bytes,
)
from tidelake.plans.mart import join_hour_dim, widen_trips


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def sides(spark):
    fact = spark.range(1000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k")
    ).withColumn("k", F.when(F.col("id") % 11 != 0, F.col("k")))
    dim = spark.range(40).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"))
    return fact, dim


@pytest.mark.parametrize("how", ["inner", "left"])
def test_all_ways_to_join_agree(spark, how):
    fact, dim = sides(spark)
    want = sorted(
        fact.join(dim, fact.k == dim.key, how).select("id", "k", "name").collect(), key=str
    )
    for options in ({}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "hot_rows": 100}):
        got = join_dimension(fact, dim, F.col("k"), "key", {"name": "name"}, how, **options)
        assert sorted(got.collect(), key=str) == want


def test_a_small_dimension_does_not_shuffle_the_fact(spark):
    fact, dim = sides(spark)
    text = plan(join_dimension(fact, dim, F.col("k"), "key", {"name": "name"}))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_hot_keys_of_a_large_dimension_are_joined_apart(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact, dim = sides(spark)
        text = plan(
            join_dimension(
                fact, dim, F.col("k"), "key", {"name": "name"}, broadcast_bytes=0, hot_rows=100
            )
        )
        assert "BroadcastHashJoin" in text and "SortMergeJoin" in text and "Union" in text
        assert "CartesianProduct" not in text and "NestedLoop" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys(spark):
    fact, _ = sides(spark)
    assert [r._hot_key for r in hot_keys(fact, "k", 100).collect()] == [7]
    assert hot_keys(fact, "k", 10_000).isEmpty()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_that_do_not_fit_are_dealt_to_many_tasks(spark, monkeypatch, how):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    fact, dim = sides(spark)
    want = fact.join(dim, fact.k == dim.key, how).select("id", "k", "name").collect()
    got = join_dimension(fact, dim, F.col("k"), "key", {"name": "name"}, how, hot_rows=11)
    assert sorted(got.collect(), key=str) == sorted(want, key=str)


def test_hot_keys_from_a_sample(spark, monkeypatch):
    monkeypatch.setattr(joins, "SAMPLED_ROWS", 50)
    fact = spark.range(40_000).select(F.when(F.col("id") % 4 == 0, 7).otherwise(F.col("id")).alias("k"))
    assert [tuple(r) for r in hot_keys(fact, "k", 5_000).collect()] == [(7, 10_001)]


def test_a_dimension_is_measured_once(spark):
    fact, dim = sides(spark)
    known = measured(dim, "key")
    assert known.small and not known.repeated
    assert measured(dim.unionAll(dim), "key").repeated
    assert not measured(dim, "key", 10).small
    want = fact.join(dim, fact.k == dim.key).count()
    assert join_dimension(fact, known, F.col("k"), "key", {"name": "name"}).count() == want


def test_only_known_join_types(spark):
    fact, dim = sides(spark)
    with pytest.raises(ValueError):
        join_dimension(fact, dim, F.col("k"), "key", {}, "full")


def test_size_in_bytes(spark):
    df = spark.createDataFrame([("ab",), (None,)], "a string")
    assert size_in_bytes(df) == 2 + 2 * 16
    assert size_in_bytes(df.limit(0)) == 0


def test_rows_without(spark, monkeypatch):
    stored = spark.createDataFrame([("a", 1), (None, 1), (None, 2)], "p string, k int")
    batch = spark.createDataFrame([(None, 1), ("b", 2)], "p string, k int")
    for limit in (joins.BROADCAST_BYTES, 0):
        monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
        left = rows_without(stored, batch, ["k"], ["p"]).collect()
        assert sorted(map(tuple, left), key=str) == [("a", 1), (None, 2)]


def trips(spark):
    rows = [
        (1, "2020-01-31 23:30:00", 1, 2),
        (2, "2020-02-01 00:00:00", 1, 2),  # outside the dimension
        (3, "not a time", 1, 2),
        (4, None, 1, 2),
        (5, "2020-01-01 00:00:00", None, 2),
        (6, "2020-01-01 00:00:00", 1, 99),
        (7, "2020-01-01 00:00:00", 2, 2),
    ]
    return spark.createDataFrame(
        rows, "id int, pickup_datetime string, pulocationid bigint, dolocationid bigint"
    ).withColumns(
        {
            "dropoff_datetime": F.col("pickup_datetime"),
            "trip_distance": F.lit(1.0),
            "total_amount": F.lit(2.0),
            "tlc_trip_type": F.lit("yellow"),
        }
    )


def dimensions(spark):
    from tidelake.operators.dimensions import date_hour_dimension

    zones = spark.createDataFrame(
        [(1, "B1", "Z1", "S1"), (2, "B2", None, "S2")],
        "locationid bigint, borough string, zone string, service_zone string",
    )
    return zones, date_hour_dimension(spark, "2020-01-01", "2020-01-31 23:00:00")


def test_inner_joins_drop_trips_without_hour_or_zone(spark):
    zones, hours = dimensions(spark)
    rows = {r.id: r for r in widen_trips(trips(spark), zones, hours).collect()}
    assert sorted(rows) == [1, 7]
    assert rows[1].pu_borough == "B1" and rows[1].do_service_zone == "S2"
    assert rows[1].hour_dwid == 2020013123 and rows[1].pu_do_zone is None
    assert rows[7].pu_borough == rows[7].do_borough == "B2"
    assert rows[1].travel_average_speed is None and rows[1].time_profit_rate is None
    assert rows[1].distance_profit_rate == 2.0 and rows[1].travel_time == 0.0


def test_left_joins_keep_all_trips(spark):
    zones, hours = dimensions(spark)
    rows = {r.id: r for r in widen_trips(trips(spark), zones, hours, how="left").collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6, 7]
    assert rows[3].hour_dwid is None and rows[6].do_zone is None and rows[5].pu_zone is None


def test_the_pickup_text_is_read_once(spark):
    _, hours = dimensions(spark)
    text = plan(join_hour_dim(trips(spark).select("id", "pickup_datetime"), hours))
    assert "isnotnull(pickup_datetime" not in text and "BroadcastHashJoin" in text
