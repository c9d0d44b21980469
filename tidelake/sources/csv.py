"""Raw CSV: reading with an applied schema, inference, and sampling of raw files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import (
    BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampNTZType,
)

from tidelake.lake import view_name
from tidelake.operators.joins import broadcast_if_small


def csv_scan_with_schema(
    spark: SparkSession, path: str, schema: StructType, header: bool = True
) -> DataFrame:
    """CSV under a schema that is applied by position, whatever the header says.

    A cell that cannot be read, a missing one or an empty one is NULL; surplus cells are left
    out. ``header=False`` reads the first line as data.
    """
    return spark.read.schema(schema).option("header", header).csv(path)


def load_csv_as_view(
    spark: SparkSession, name: str, path: str, schema: StructType, header: bool = True
) -> DataFrame:
    """``csv_scan_with_schema``, registered under the table's view name."""
    df = csv_scan_with_schema(spark, path, schema, header)
    df.createOrReplaceTempView(view_name(name))
    return df


def infer_csv_schema(spark: SparkSession, path: str, header: bool = True) -> StructType:
    """Schema of a CSV folder from all of its rows, with lower-case names."""
    found = spark.read.option("header", header).option("inferSchema", True).csv(path).schema
    return StructType([StructField(f.name.lower(), f.dataType, True) for f in found])


def merge_schemas(known: StructType | None, found: StructType) -> StructType:
    """The known columns unchanged, then new ones. Columns are never dropped or retyped."""
    fields = list(known or [])
    names = {f.name.lower() for f in fields}
    return StructType(fields + [f for f in found if f.name.lower() not in names])


def infer_merge_schema(
    spark: SparkSession,
    root: str,
    prefix: str,
    folders: Sequence[str],
    known: Mapping[str, StructType] | None = None,
    widen: bool = False,
) -> dict[str, StructType]:
    """Schemas of the folders under ``root``, as tables ``<prefix>_<folder>``.

    Tables known before keep their columns and gain the new ones. With ``widen`` a known column gets
    a wider type where its files hold cells that the known one cannot hold.
    """
    merged = dict(known or {})
    for folder in folders:
        name, path = f"{prefix}_{folder}", f"{root}/{folder}"
        if widen:
            merged[name] = widened_schema(found_types(spark, path), merged.get(name))
        else:
            merged[name] = merge_schemas(merged.get(name), infer_csv_schema(spark, path))
    return merged


#: Kinds of cells, each with a bit. Sets of kinds are joined by OR, in any order.
KINDS = {
    "int": 1, "bigint": 2, "double": 4, "boolean": 8, "timestamp_ntz": 16, "string": 32,
}
NUMBERS = ("int", "bigint", "double")
_TYPES = {
    "int": IntegerType(), "bigint": LongType(), "double": DoubleType(), "boolean": BooleanType(),
    "timestamp_ntz": TimestampNTZType(), "string": StringType(),
}


def _kind(cell: Column) -> Column:
    """The bit of a cell's kind; 0 for an empty one. Whole numbers beyond a bigint are text."""
    text = F.trim(cell)
    whole, number = text.rlike(r"^[+-]?[0-9]+$"), text.rlike(
        r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
    )
    time = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?)?$")
    bit = {kind: F.lit(value) for kind, value in KINDS.items()}
    return (
        F.when(cell.isNull() | (text == ""), F.lit(0))
        .when(whole & text.try_cast("int").isNotNull(), bit["int"])
        .when(whole & text.try_cast("bigint").isNotNull(), bit["bigint"])
        .when(whole, bit["string"])
        .when(number, bit["double"])
        .when(F.lower(text).isin("true", "false"), bit["boolean"])
        .when(time & text.try_cast("timestamp_ntz").isNotNull(), bit["timestamp_ntz"])
        .otherwise(bit["string"])
    )


def joined_type(bits: int) -> str | None:
    """The narrowest type that holds all kinds of a set; None for no kind."""
    kinds = [k for k, bit in KINDS.items() if bits & bit]
    if not kinds:
        return None
    if all(k in NUMBERS for k in kinds):
        return kinds[-1]
    return kinds[0] if len(kinds) == 1 else "string"


def found_types(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """What every column of every CSV file holds: column, place, file, kinds (the set of bits).

    One scan of all cells, aggregated by file before the shuffle. The files of a folder share their
    columns; names are in lower case.
    """
    named = spark.read.option("header", header).csv(path)
    cells = spark.read.schema(
        StructType([StructField(c, StringType()) for c in named.columns])
    ).option("header", header).csv(path)
    held = [F.bit_or(_kind(F.col(f"`{c}`"))).alias(f"_{i}") for i, c in enumerate(cells.columns)]
    files = cells.groupBy(F.col("_metadata.file_path").alias("file")).agg(*held)
    each = F.array(*[
        F.struct(
            F.lit(c.lower()).alias("column"), F.lit(i).alias("place"),
            F.col(f"_{i}").alias("kinds"),
        )
        for i, c in enumerate(cells.columns)
    ])
    return files.select("file", F.inline(each))


def widened_schema(found: DataFrame, known: StructType | None = None) -> StructType:
    """The known columns, then new ones, each with a type that holds every cell of ``found_types``.

    A known type is only ever widened, along int, bigint, double, string; every other mixture is
    text. A known type that is none of these stays. A new column without any cell is text.
    """
    rows = found.groupBy("column").agg(
        F.min("place").alias("place"), F.bit_or("kinds").alias("kinds")
    ).collect()
    kinds = {r.column: r.kinds for r in rows}
    fields = []
    for f in known or []:
        own = f.dataType.simpleString()
        if own in KINDS and f.name.lower() in kinds:
            own = joined_type(kinds[f.name.lower()] | KINDS[own])
            f = StructField(f.name, _TYPES[own], True)
        fields.append(f)
    names = {f.name.lower() for f in fields}
    new = sorted((r for r in rows if r.column not in names), key=lambda r: r.place)
    return StructType(
        fields
        + [StructField(r.column, _TYPES[joined_type(r.kinds) or "string"], True) for r in new]
    )


def widened_columns(found: DataFrame, known: StructType) -> DataFrame:
    """Which files made which columns wider: column, file, known, holds (the type of its cells)."""
    spark, wide = found.sparkSession, widened_schema(found, known)
    changed = [
        (f.name.lower(), f.dataType.simpleString())
        for f in known if wide[f.name].dataType != f.dataType
    ]
    types = {bits: joined_type(bits) for bits in range(1, 64)}
    holds = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    known_bit = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    columns = spark.createDataFrame(changed, "column string, known string")
    joint = holds[F.col("kinds").bitwiseOR(known_bit[F.col("known")])]
    return (
        found.join(F.broadcast(columns), "column").filter(joint != F.col("known"))
        .select("column", "file", "known", holds[F.col("kinds")].alias("holds"))
    )


def number_lines(lines: DataFrame) -> DataFrame:
    """Lines of text files (``spark.read.text``) with ``file`` and ``line``, counted from 1.

    A line's number is its position in its block of the file plus the lines of the file's
    earlier blocks. Only one row per block is shuffled.
    """
    rows = lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    before = (
        Window.partitionBy("file")
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = (
        rows.groupBy("file", "_block")
        .agg(F.count("*").alias("_lines"), F.min("_id").alias("_first"))
        .select("file", "_block", "_first", F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_offset"))
    )
    return rows.join(broadcast_if_small(blocks), ["file", "_block"]).select(
        "file", (F.col("_offset") + F.col("_id") - F.col("_first") + 1).alias("line"), "value"
    )


def sample_lines(spark: SparkSession, path: str, n: int = 100) -> DataFrame:
    """Lines n, 2n, 3n, … of each raw file, as column ``value``; a header counts as line 1."""
    numbered = number_lines(spark.read.text(path))
    return numbered.filter(F.col("line") % n == 0).select("value")
