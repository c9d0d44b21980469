"""The generic job: a source, SQL statements with parameters, a sink."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def run_sql_step(
    spark: SparkSession,
    statements: Sequence[str],
    params: Mapping[str, object] | None = None,
) -> DataFrame | None:
    """Run statements in order and return the last one's result.

    ``:name`` is bound as a value. ``@name@`` is put in as text, for the places where SQL takes
    no value: partition specs, locations, names. A parameter without a value is an error.
    """
    params = dict(params or {})

    def text(match: re.Match) -> str:
        if match[1] not in params:
            raise KeyError(f"no value for parameter {match[1]}")
        return str(params[match[1]])

    result = None
    for statement in statements:
        result = spark.sql(re.sub(r"@(\w+)@", text, statement), args=params)
    return result


def run_job(
    spark: SparkSession,
    source: Callable[[], object] | None = None,
    statements: Sequence[str] = (),
    params: Mapping[str, object] | None = None,
    sink: Callable[[DataFrame], None] | None = None,
    sink_view: str | None = None,
) -> None:
    """Optional source (it registers views), SQL, optional sink of the view ``sink_view``.

    An error in any part stops the job.
    """
    if source is not None:
        source()
    run_sql_step(spark, statements, params)
    if sink is not None:
        sink(spark.table(sink_view))
