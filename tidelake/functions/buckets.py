"""Labels for ranges of distance, duration and speed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Inclusive upper bound and label of each range, and the label above the last.
DISTANCE_LABELS = [
    (1.0, "0-1 Mile"),
    (2.0, "1-2 Miles"),
    (3.0, "2-3 Miles"),
    (4.0, "3-4 Miles"),
    (5.0, "4-5 Miles"),
    (6.0, "5-6 Miles"),
    (7.0, "6-7 Miles"),
    (8.0, "7-8 Miles"),
    (9.0, "8-9 Miles"),
    (10.0, "9-10 Miles"),
    (15.0, "10-15 Miles"),
    (20.0, "15-20 Miles"),
    (25.0, "20-25 Miles"),
    (30.0, "25-30 Miles"),
]
DISTANCE_ABOVE = "30 Miles Above"
DURATION_LABELS = [
    (10.0, "0-10 Minutes"),
    (20.0, "10-20 Minutes"),
    (30.0, "20-30 Minutes"),
    (40.0, "30-40 Minutes"),
    (50.0, "40-50 Minutes"),
    (60.0, "50-60 Minutes"),
]
DURATION_ABOVE = "60 Minutes Above"
SPEED_LABELS = [
    (5.0, "0-5 Miles/Hour"),
    (10.0, "5-10 Miles/Hour"),
    (15.0, "10-15 Miles/Hour"),
    (20.0, "15-20 Miles/Hour"),
    (25.0, "20-25 Miles/Hour"),
    (30.0, "25-30 Miles/Hour"),
]
SPEED_ABOVE = "30 Miles/Hour Above"


def bucket(value: Column, labels: Sequence[tuple[float, str]], above: str) -> Column:
    """Label of the first range whose upper bound is not exceeded; NULL stays NULL.

    Negative values fall in the first range; NaN, larger than any number, in the last.
    """
    label = F.when(value.isNull(), None)
    for bound, name in labels:
        label = label.when(value <= bound, name)
    return label.otherwise(above)


def distance_bucket(distance: Column) -> Column:
    return bucket(distance, DISTANCE_LABELS, DISTANCE_ABOVE)


def duration_bucket(minutes: Column) -> Column:
    return bucket(minutes, DURATION_LABELS, DURATION_ABOVE)


def speed_bucket(speed: Column) -> Column:
    return bucket(speed, SPEED_LABELS, SPEED_ABOVE)
