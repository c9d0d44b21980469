"""Union of sources of different shape."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tidelake.operators.project import conform, null_pad, tag_literal


def union_sources(
    sources: Mapping[str, DataFrame],
    schema: StructType,
    tag: str,
    renames: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """UNION ALL of the sources in one schema; the ``tag`` column tells where a row is from.

    Each source is renamed, tagged, padded with NULLs and cast. Columns outside the schema are
    not read. No rows move between partitions.
    """
    renames = renames or {}
    parts = []
    for name, df in sources.items():
        renamed = df.withColumnsRenamed(dict(renames.get(name, {})))
        parts.append(conform(null_pad(tag_literal(renamed, tag, name), schema), schema))
    return reduce(DataFrame.unionAll, parts)
