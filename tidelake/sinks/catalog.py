"""Databases, tables and partitions in the session catalog."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidelake.lake import Lake, partition_folder
from tidelake.schemas import TABLES
from tidelake.versions import current_folders, part_name, partition_of

# The layers.
LAYERS = ("tmp", "stg", "ods", "dwh", "dmt")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _spec(partition: Mapping[str, str | None]) -> str:
    return ", ".join(
        f"`{c}` = {'NULL' if v in (None, '') else _text(str(v))}" for c, v in partition.items()
    )


def create_databases(lake: Lake, replace: bool = False) -> None:
    """Create the database of each layer; ``replace`` drops it with its tables first."""
    for layer in LAYERS:
        name = f"`{lake.database(layer)}`"
        if replace:
            lake.spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
        lake.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {name} LOCATION {_text(f'{lake.root}/{layer}')}"
        )


def create_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    path: str,
    partition_by: Sequence[str] = (),
    replace: bool = False,
) -> None:
    """A Parquet table over ``path``; ``replace`` drops the entry first and keeps the files."""
    if replace:
        drop_tables(spark, [name])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    layout = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_name(name)} ({columns}) USING parquet{layout}"
        f" LOCATION {_text(path)}"
    )


def create_tables(lake: Lake, names: Iterable[str] | None = None, replace: bool = False) -> None:
    """Create tables of the registry: those named, or all but raw and keyed ones."""
    if names is None:
        names = [n for n, t in TABLES.items() if not n.startswith("stg.") and not t.keys]
    for name in names:
        table = lake.table(name)
        home = f"ods.{name[4:]}" if name.startswith("dwh.tlc_") else name
        create_table(
            lake.spark, lake.catalog_name(name), table.schema, lake.path(home),
            table.partition_by, replace,
        )


def drop_tables(spark: SparkSession, names: Iterable[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {_name(name)}")


def register_catalog(
    spark: SparkSession,
    name: str,
    schema: StructType,
    path: str,
    partition_by: Sequence[str] = (),
    added: Sequence[Mapping[str, str | None]] | None = None,
    removed: Sequence[Mapping[str, str | None]] = (),
    folders: Sequence[str] | None = None,
) -> None:
    """Register a written table, or bring its entry up to the files' partitions and schema.

    ``added`` and ``removed`` name the partitions that have changed; ``folders`` are those of the
    added ones, where they are not the usual ones. Without ``added`` the partitions come from the
    table's log, or, if it has none, from listing its folders.

    New columns are added to the entry, which keeps its partitions. Only an entry of which a column
    is gone or has another type is made anew.
    """
    versions = current_folders(spark, path)
    place = path
    if versions is not None and not partition_by:
        place = versions.get("", path)
    known = spark.catalog.tableExists(name)
    if known and not add_columns(spark, name, schema):
        drop_tables(spark, [name])
        known = False
    create_table(spark, name, schema, place, partition_by)
    if known and not partition_by:
        locate_table(spark, name, place)
    if partition_by:
        if known and added is not None:
            folders = folders or [partition_folder(path, p) for p in added]
            move_partitions(spark, name, added, folders)
            _drop_partitions(spark, name, removed)
        elif versions is None:
            spark.sql(f"MSCK REPAIR TABLE {_name(name)} SYNC PARTITIONS")
        else:
            parts = [partition_of(part) for part in versions]
            held = {part_name(p) for p in partitions_of(spark, name)} if known else set()
            move_partitions(spark, name, parts, list(versions.values()))
            _drop_partitions(spark, name, [partition_of(p) for p in held - set(versions)])
    spark.sql(f"REFRESH TABLE {_name(name)}")


def add_columns(spark: SparkSession, name: str, schema: StructType) -> bool:
    """Add the columns that an entry lacks. False if it has others, or others' types."""
    have = {f.name: f.dataType for f in spark.table(name).schema}
    want = {f.name: f.dataType for f in schema}
    if any(c not in want or want[c] != kind for c, kind in have.items()):
        return False
    new = ", ".join(f"`{c}` {t.simpleString()}" for c, t in want.items() if c not in have)
    if new:
        spark.sql(f"ALTER TABLE {_name(name)} ADD COLUMNS ({new})")
    return True


def locate_table(spark: SparkSession, name: str, path: str) -> None:
    """Switch a table without partitions to the files at ``path``."""
    spark.sql(f"ALTER TABLE {_name(name)} SET LOCATION {_text(path)}")
    spark.sql(f"REFRESH TABLE {_name(name)}")


def partitions_of(spark: SparkSession, name: str) -> list[dict]:
    rows = spark.sql(f"SHOW PARTITIONS {_name(name)}").collect()
    return [partition_of(row[0]) for row in rows]


def has_partition(spark: SparkSession, name: str, partition: Mapping[str, str | None]) -> bool:
    spec = f"PARTITION ({_spec(partition)})"
    return bool(spark.sql(f"SHOW PARTITIONS {_name(name)} {spec}").head(1))


def move_partitions(
    spark: SparkSession, name: str, partitions: Sequence[Mapping[str, str | None]],
    locations: Sequence[str],
) -> None:
    """Point partitions of a table at files that are already there; nothing is copied.

    A partition that the entry has already is switched in one step, so readers find either the old
    files or the new ones. Many new ones go into one statement.
    """
    table = _name(name)
    place = {part_name(p): (p, at) for p, at in zip(partitions, locations, strict=True)}
    if len(place) <= 10:
        held = {part for part, (p, _) in place.items() if has_partition(spark, name, p)}
    else:
        held = {part_name(p) for p in partitions_of(spark, name)}
    new = [v for part, v in place.items() if part not in held]
    for i in range(0, len(new), 1000):
        own = [f"PARTITION ({_spec(p)}) LOCATION {_text(at)}" for p, at in new[i : i + 1000]]
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(own)}")
    for part, (p, at) in place.items():
        if part in held:
            spark.sql(f"ALTER TABLE {table} PARTITION ({_spec(p)}) SET LOCATION {_text(at)}")


def _drop_partitions(
    spark: SparkSession, name: str, partitions: Sequence[Mapping[str, str | None]]
) -> None:
    for i in range(0, len(partitions), 1000):
        own = ", ".join(f"PARTITION ({_spec(p)})" for p in partitions[i : i + 1000])
        spark.sql(f"ALTER TABLE {_name(name)} DROP IF EXISTS {own}")


def attach_partition(
    spark: SparkSession, name: str, partition: Mapping[str, str], location: str
) -> None:
    """Point a partition of a table at files that are already there; nothing is copied."""
    move_partitions(spark, name, [partition], [location])
    spark.sql(f"REFRESH TABLE {_name(name)}")


def detach_partition(spark: SparkSession, name: str, partition: Mapping[str, str]) -> None:
    """Remove a partition's entry; its files stay."""
    _drop_partitions(spark, name, [partition])


def temp_view(df: DataFrame, name: str) -> DataFrame:
    """Name a result for the next step."""
    df.createOrReplaceTempView(name)
    return df
