"""Text expressions of the dimensions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def route_label(start: Column, end: Column) -> Column:
    """``start -> end``; NULL if either is NULL."""
    return F.concat(start, F.lit(" -> "), end)


def strip_chars(value: Column, chars: str = "/") -> Column:
    """Remove characters that do not belong in a partition directory's name."""
    for char in chars:
        value = F.replace(value, F.lit(char), F.lit(""))
    return value
