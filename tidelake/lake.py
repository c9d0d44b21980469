"""Where tables live: paths, view names, catalog names and scratch space."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidelake.schemas import TABLES, Table

#: Setting of a session for the scratch folder of applications without a checkpoint folder.
SCRATCH_SETTING = "spark.tidelake.scratch.dir"
#: The scratch folder of the running scope, if there is one.
_SCOPE: ContextVar[str | None] = ContextVar("scope", default=None)


def table_path(root: str, name: str) -> str:
    """Path of ``layer.domain_table``; the stg layer has one folder per domain."""
    layer, table = name.split(".", 1)
    if layer == "stg":
        domain, table = table.split("_", 1)
        return f"{root}/stg/{domain}/{table}"
    return f"{root}/{layer}/{table}"


def view_name(name: str) -> str:
    """Default view of a table: ``ods.geo_taxi_zone`` is ``v_ods_geo_taxi_zone``."""
    return "v_" + name.replace(".", "_")


def scratch_path(spark: SparkSession) -> str:
    """A new, unused path in the shared folder named by ``spark.checkpoint.dir``.

    That setting is fixed when the application starts; where it is unset, ``SCRATCH_SETTING`` of
    the session may name the folder.

    Each application has one folder there, which may be removed once it has ended. There is no
    default: on a cluster no machine's own disk is visible to the others.
    """
    if _SCOPE.get():
        return f"{_SCOPE.get()}/{uuid.uuid4().hex}"
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH_SETTING, None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{root.rstrip('/')}/tidelake/{app}/{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Scratch space for steps whose result is written before the scope ends; then it is removed.

    After an error it stays. Inside another scope this is the outer one.
    """
    if _SCOPE.get():
        yield _SCOPE.get()
        return
    folder = scratch_path(spark)
    token = _SCOPE.set(folder)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
    remove_folders(spark, [folder])


def remove_folders(spark: SparkSession, folders: Iterable[str]) -> None:
    """Delete folders with all that is in them, several at a time; a missing one is no error."""

    def remove(folder: str) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    with ThreadPoolExecutor(16) as pool:
        for done in [pool.submit(remove, folder) for folder in folders]:
            done.result()


#: Setting of the files of partitions that a task may have open at a time.
WRITERS_SETTING = "spark.sql.maxConcurrentOutputFileWriters"
#: Partitions whose files a task has open at a time; its rows are sorted only if it meets more.
OPEN_PARTITIONS = 16


@contextmanager
def open_partitions(spark: SparkSession) -> Iterator[None]:
    """Within it, tasks write rows of some partitions as they come, without sorting them first.

    The sort would hold all of a task's rows, as wide as they are, or spill them. Files of a task
    that meets more partitions are written from sorted rows, as usual.
    """
    before = spark.conf.get(WRITERS_SETTING)
    spark.conf.set(WRITERS_SETTING, max(int(before), OPEN_PARTITIONS))
    try:
        yield
    finally:
        spark.conf.set(WRITERS_SETTING, before)


def stage(df: DataFrame, path: str | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to scratch space and read it back.

    The result has no lineage to recompute when executors are lost, its size is known to
    the optimizer, and every later use of it reads the same rows. Readers that filter by the
    columns ``partition_by`` (they come last) read only the rows that they ask for.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark)
    with open_partitions(spark):
        (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def partition_folder(path: str, partition: Mapping[str, str | None]) -> str:
    """Folder of one partition, escaped as Spark's writer escapes it."""

    def escaped(value: str | None) -> str:
        if value is None or value == "":
            return "__HIVE_DEFAULT_PARTITION__"
        # The characters that are written as %XX in a partition folder.
        return re.sub(
            r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""",
            lambda m: f"%{ord(m.group()):02X}", str(value),
        )

    return "/".join([path, *[f"{c}={escaped(v)}" for c, v in partition.items()]])


@dataclass(frozen=True)
class Lake:
    """One lake: its root path and, for several lakes in one catalog, a database prefix."""

    spark: SparkSession
    root: str
    prefix: str = ""

    def path(self, name: str) -> str:
        return table_path(self.root, name)

    def catalog_name(self, name: str) -> str:
        return self.prefix + name

    def table(self, name: str) -> Table:
        return TABLES[name]

    def schema(self, name: str) -> StructType:
        return TABLES[name].schema

    def database(self, layer: str) -> str:
        return self.prefix + layer
