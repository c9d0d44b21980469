"""Projections: rename, tag, pad, append, exclude and conform columns."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, IntegralType, StringType, StructType

from tidelake.schemas import COMMIT_TIME


def project_rename(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Select the columns named by the keys under the names given by the values."""
    return df.select(*[F.col(old).alias(new) for old, new in columns.items()])


def tag_literal(df: DataFrame, column: str, value) -> DataFrame:
    """Put a constant column first."""
    return df.select(F.lit(value).alias(column), "*")


def null_pad(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` in its order, with typed NULLs for those missing."""
    have = set(df.columns)
    return df.select(
        *[
            F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def star_append(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """All columns, then constants; a Column value is used as it is."""
    return df.select(
        "*",
        *[
            (v if isinstance(v, Column) else F.lit(v)).alias(name)
            for name, v in constants.items()
        ],
    )


def exclude_columns(df: DataFrame, pattern: str = COMMIT_TIME) -> DataFrame:
    """Drop the columns whose whole name matches a regular expression."""
    return df.drop(*[c for c in df.columns if re.fullmatch(pattern, c)])


def lenient_cast(value: Column, source: DataType, target: DataType) -> Column:
    """Cast where text that cannot be read gives NULL; '1.5' as an integer gives 1."""
    cast = value.try_cast(target)
    if isinstance(source, StringType) and isinstance(target, IntegralType):
        cast = F.coalesce(cast, value.try_cast("decimal(38,10)").try_cast(target))
    return cast


def conform(df: DataFrame, schema: StructType, by_position: bool = False) -> DataFrame:
    """Cast to the types of ``schema``, matching columns by name or by position."""
    if by_position and len(df.columns) != len(schema):
        raise ValueError(f"{len(df.columns)} columns do not fit {len(schema)}")
    columns = []
    for position, field in enumerate(schema):
        name = df.columns[position] if by_position else field.name
        source = df.schema[name].dataType
        column = F.col(f"`{name}`")
        if source != field.dataType:
            column = lenient_cast(column, source, field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns)
