"""The zone dimension: raw CSV -> ods by month -> dwh current state -> dmt by service zone."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, functions as F

from tidelake.functions.text import strip_chars
from tidelake.functions.times import load_ts
from tidelake.lake import Lake, scratch_scope
from tidelake.operators.project import exclude_columns, star_append
from tidelake.schemas import COMMIT_TIME
from tidelake.sinks.catalog import create_table, locate_table, register_catalog
from tidelake.sinks.keyed import (
    commits_to_take, note_consumed, upsert_partitioned, upsert_unpartitioned,
)
from tidelake.sources.csv import load_csv_as_view
from tidelake.sources.tables import current_snapshot, scan_commits
from tidelake.versions import Touched

STG, ODS, DWH, DMT = (
    "stg.geo_taxi_zone", "ods.geo_taxi_zone", "dwh.geo_taxi_zone", "dmt.geo_dim_taxi_zone",
)


def _scoped(step):
    """The step, after which its scratch is removed."""

    @wraps(step)
    def run(lake: Lake, *args, **options) -> None:
        with scratch_scope(lake.spark):
            step(lake, *args, **options)

    return run


def _upsert_partitioned(lake: Lake, name: str, batch: DataFrame, instant: str, global_key: bool) -> None:
    table = lake.table(name)

    def register(touched: Touched) -> None:
        register_catalog(
            lake.spark, lake.catalog_name(name), table.schema, lake.path(name),
            table.partition_by, touched.written, touched.emptied, touched.folders,
        )

    upsert_partitioned(
        batch, lake.path(name), table.keys, table.precombine, table.partition_by, instant,
        schema=table.schema, global_key=global_key, then=register,
    )


@_scoped
def load_zones(
    lake: Lake, year: int, month: int, instant: str, ts: int | None = None, header: bool = True
) -> None:
    """Upsert the landed zone file into the month's partition."""
    raw = load_csv_as_view(lake.spark, STG, lake.path(STG), lake.schema(STG), header)
    batch = star_append(
        raw, {"ts": load_ts(ts), "year": f"{year:04d}", "month": f"{month:02d}"}
    )
    _upsert_partitioned(lake, ODS, batch, instant, global_key=False)


@_scoped
def conform_zones(
    lake: Lake, instant: str, after: str | None = None, max_commits: int | None = None
) -> None:
    """Upsert the rows of new ods commits into the current state of all zones.

    New are the commits that this table has not taken in, whatever their instants; with ``after``
    those of later stamps. ``max_commits`` leaves later ones for the next run.
    """
    commits = commits_to_take(
        lake.spark, lake.path(ODS), lake.path(DWH), instant, after, max_commits
    )
    rows = scan_commits(lake.spark, lake.path(ODS), lake.schema(ODS), commits)
    table, name = lake.table(DWH), lake.catalog_name(DWH)
    upsert_unpartitioned(
        exclude_columns(rows), lake.path(DWH), table.keys, table.precombine, instant,
        schema=table.schema,
    )
    note_consumed(lake.spark, lake.path(DWH), instant, commits)
    # The dimension has one bucket, so its rows lie in one folder.
    _, folders = current_snapshot(lake.spark, lake.path(DWH))
    create_table(lake.spark, name, table.schema, folders[0])
    locate_table(lake.spark, name, folders[0])


@_scoped
def publish_zones(
    lake: Lake, instant: str, after: str | None = None, max_commits: int | None = None,
    global_key: bool = False,
) -> None:
    """Upsert the rows of new dwh commits into the mart, by service zone.

    A zone that changes its service zone stays in the old partition too, unless ``global_key``.
    """
    commits = commits_to_take(
        lake.spark, lake.path(DWH), lake.path(DMT), instant, after, max_commits
    )
    rows = scan_commits(lake.spark, lake.path(DWH), lake.schema(DWH), commits)
    batch = rows.withColumn("service_zone", strip_chars(F.col("service_zone")))
    _upsert_partitioned(lake, DMT, batch.drop(COMMIT_TIME), instant, global_key)
    note_consumed(lake.spark, lake.path(DMT), instant, commits)


@_scoped
def geo_dimension_chain(
    lake: Lake,
    year: int,
    month: int,
    instant: str,
    after: str | None = None,
    ts: int | None = None,
    max_commits: int | None = None,
    global_key: bool = False,
) -> None:
    """One month through all layers, at the instant of the run.

    Every commit that a layer has not taken in yet is consumed, in whichever month it was made.
    ``after`` takes another instant as the last one consumed, in both upper layers.
    """
    load_zones(lake, year, month, instant, ts)
    conform_zones(lake, instant, after, max_commits)
    publish_zones(lake, instant, after, max_commits, global_key)
