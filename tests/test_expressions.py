import math
import time

from pyspark.sql import functions as F

from tidelake.functions.buckets import (
    DISTANCE_LABELS, DURATION_LABELS, SPEED_LABELS, distance_bucket, duration_bucket, speed_bucket,
)
from tidelake.functions.rates import average_speed, distance_profit_rate, time_profit_rate
from tidelake.functions.text import route_label, strip_chars
from tidelake.functions.times import elapsed_minutes, elapsed_seconds, hour_key, load_ts


def evaluate(spark, column, rows, schema):
    df = spark.createDataFrame(rows, schema).coalesce(1)
    return [r[0] for r in df.select(column.alias("r")).collect()]


def labels(spark, function, values):
    return evaluate(spark, function(F.col("x")), [(v,) for v in values], "x double")


def test_every_bound_belongs_to_its_own_range(spark):
    for function, table in (
        (distance_bucket, DISTANCE_LABELS),
        (duration_bucket, DURATION_LABELS),
        (speed_bucket, SPEED_LABELS),
    ):
        names = [name for _, name in table]
        assert labels(spark, function, [bound for bound, _ in table]) == names
        above = labels(spark, function, [bound + 0.0001 for bound, _ in table])
        assert above[:-1] == names[1:]
        assert above[-1] not in names


def test_bucket_of_odd_values(spark):
    values = [0.0, -0.0, -7.5, None, float("nan"), float("inf"), float("-inf"), 30.0, 30.5]
    assert labels(spark, distance_bucket, values) == [
        "0-1 Mile", "0-1 Mile", "0-1 Mile", None, "30 Miles Above", "30 Miles Above", "0-1 Mile",
        "25-30 Miles", "30 Miles Above",
    ]
    assert labels(spark, duration_bucket, [None, -1.0, 60.0, 61.0]) == [
        None, "0-10 Minutes", "50-60 Minutes", "60 Minutes Above",
    ]
    assert labels(spark, speed_bucket, [None, -1.0, 5.0, 31.0]) == [
        None, "0-5 Miles/Hour", "0-5 Miles/Hour", "30 Miles/Hour Above",
    ]


def test_elapsed_time_of_text(spark):
    rows = [
        ("2020-01-31 23:50:00", "2020-02-01 00:05:30"),
        ("2020-01-01 10:00:00", "2020-01-01 09:00:00"),
        ("2020-03-08 01:30:00", "2020-03-08 03:30:00"),  # over a clock change in New York
        ("no time", "2020-01-01 00:00:00"),
        (None, "2020-01-01 00:00:00"),
    ]
    assert evaluate(spark, elapsed_minutes("a", "b"), rows, "a string, b string") == [
        15.5, -60.0, 120.0, None, None,
    ]
    assert evaluate(spark, elapsed_seconds("a", "b"), rows[:1], "a string, b string") == [930]


def test_hour_key(spark):
    rows = [
        ("2020-01-31 23:59:59",), ("2020-03-08 02:30:00",), ("2020-12-01 00:00:00.5",),
        ("2020-13-01 00:00:00",), ("",), (None,),
    ]
    assert evaluate(spark, hour_key("t"), rows, "t string") == [
        2020013123, 2020030802, 2020120100, None, None, None,
    ]


def test_rates_are_null_where_the_divisor_is_zero(spark):
    schema = "kind string, amount double, distance double, seconds double"
    rows = [
        ("yellow", 20.0, 10.0, 1800.0),
        ("green", 20.0, 0.0, 0.0),
        ("fhv", 20.0, 10.0, 1800.0),
        ("yellow", None, 10.0, -1800.0),
        (None, 20.0, 10.0, 1800.0),
        ("yellow", 20.0, None, None),
    ]
    c = F.col
    speeds = evaluate(spark, average_speed(c("distance"), c("seconds")), rows, schema)
    assert speeds == [20.0, None, 20.0, -20.0, 20.0, None]
    by_time = time_profit_rate(c("amount"), c("seconds") / 60, c("kind"))
    assert [v and round(v, 9) for v in evaluate(spark, by_time, rows, schema)] == [
        round(20 / 30, 9), None, None, None, None, None,
    ]
    by_distance = distance_profit_rate(c("amount"), c("distance"), c("kind"))
    assert evaluate(spark, by_distance, rows, schema) == [2.0, None, None, None, None, None]


def test_text(spark):
    rows = [("a", "b"), (None, "b"), ("a", None)]
    assert evaluate(spark, route_label(F.col("a"), F.col("b")), rows, "a string, b string") == [
        "a -> b", None, None,
    ]
    rows = [("N/A",), ("a/b/c",), ("",), (None,)]
    assert evaluate(spark, strip_chars(F.col("a")), rows, "a string") == ["NA", "abc", "", None]


def test_load_ts(spark):
    rows = [(1,), (2,)]
    assert evaluate(spark, load_ts(7), rows, "a int") == [7, 7]
    first, second = evaluate(spark, load_ts(), rows, "a int")
    assert first == second and math.isclose(first, time.time(), abs_tol=60)
