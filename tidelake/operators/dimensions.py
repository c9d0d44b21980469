"""The hourly date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelake.functions.times import hour_key, local_time
from tidelake.schemas import TABLES

# Day and month names.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]


def _name_of(names: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), number)


def describe_hours(hours: DataFrame, column: str = "t") -> DataFrame:
    """The dimension's columns for a column of full hours.

    Weeks are ISO weeks; the weekend is Saturday and Sunday. Names do not depend on the locale
    or the session time zone.
    """
    t = F.col(column)
    weekday = F.dayofweek(t)
    columns = {
        "dwid": hour_key(t),
        "db_date": t.cast("date").cast("string"),
        "year": F.year(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "hour": F.hour(t),
        "quarter": F.quarter(t),
        "week": F.weekofyear(t),
        "day_name": _name_of(DAY_NAMES, weekday),
        "month_name": _name_of(MONTH_NAMES, F.month(t)),
        "weekend_flag": weekday.isin(1, 7),
    }
    return hours.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in TABLES["dmt.pub_dim_date"].schema]
    )


def date_hour_dimension(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per hour from ``start`` to ``end`` (``yyyy-MM-dd[ HH:mm:ss]``), both included."""
    bounds = spark.range(1).select(
        local_time(F.lit(start)).alias("lo"), local_time(F.lit(end)).alias("hi")
    )
    number = lambda t: F.year(t) * 12 + F.month(t) - 1
    months = bounds.select(
        "lo", "hi", F.explode(F.sequence(number("lo"), number("hi"))).alias("i")
    ).select("lo", "hi", _month((F.col("i") / 12).cast("int"), F.col("i") % 12 + 1).alias("m"))
    return describe_hours(_hours_of(months).filter("t >= lo AND t <= hi").select("t"))


def _month(year: Column, month: Column) -> Column:
    zero = F.lit(0)
    return F.make_timestamp_ntz(year, month, F.lit(1), zero, zero, zero)


def months_of(df: DataFrame, column: str) -> DataFrame:
    """The months that ``column`` touches, each by its first instant, as ``m``.

    A time that cannot be read is in no month. Each task hands on a month at most once.
    """
    t = local_time(column)
    return df.select(_month(F.year(t), F.month(t)).alias("m")).filter("m IS NOT NULL").distinct()


def date_hour_dimension_of(df: DataFrame, column: str) -> DataFrame:
    """The hours of all months that ``column`` touches.

    Months become hours where they lie, so a single stray year adds its own months only.
    """
    return describe_hours(_hours_of(months_of(df, column)).select("t"))


def _hours_of(months: DataFrame) -> DataFrame:
    """The hours of each month ``m``, as ``t``."""
    hours = F.dayofmonth(F.last_day(F.col("m").cast("date"))) * 24
    place = F.explode(F.sequence(F.lit(0), hours - 1))
    t = F.make_timestamp_ntz(
        F.year("m"), F.month("m"), (F.col("h") / 24).cast("int") + 1, F.col("h") % 24, F.lit(0),
        F.lit(0),
    )
    return months.withColumn("h", place).withColumn("t", t)
