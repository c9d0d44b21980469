"""Speed and profit rates. A zero divisor gives NULL, also in ANSI mode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

#: Trip types that carry an amount.
METERED_TYPES = ("yellow", "green")


def average_speed(distance: Column, seconds: Column) -> Column:
    """Distance per hour."""
    return F.try_divide(distance, seconds / F.lit(3600.0))


def time_profit_rate(
    amount: Column, minutes: Column, trip_type: Column, types: Sequence[str] = METERED_TYPES
) -> Column:
    """Amount per minute, for metered trip types only."""
    return F.when(trip_type.isin(*types), F.try_divide(amount, minutes))


def distance_profit_rate(
    amount: Column, distance: Column, trip_type: Column, types: Sequence[str] = METERED_TYPES
) -> Column:
    """Amount per mile, for metered trip types only."""
    return F.when(trip_type.isin(*types), F.try_divide(amount, distance))
