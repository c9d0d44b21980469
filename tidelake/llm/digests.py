"""Exact dedup against a persistent index of digests, bucketed and sorted by digest.

The index is a Parquet table of (digest, keep_id, group_size) whose files are bucketed by digest
and sorted within. A batch is reduced to one row per digest (largest id, number of rows), joined
to the index with a sort-merge anti-join that does not shuffle the index, and what is new is
appended. Of a digest that is there already the number of rows is appended, and summed on reading.

Nulls and edge cases: a null text counts as empty. A null id loses to any other; a group of null
ids only keeps null. Rows that repeat an id and a text are one document: all are marked as kept,
and ``without_copies`` returns one of them. Texts are hashed whole, of any length. Only A-Z are
lower-cased. An empty batch appends nothing. Columns of the batch other than the id and the text
are not read by the index.
"""

from __future__ import annotations

import hashlib
import string
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelake.lake import scratch_path, stage
from tidelake.llm.common import free_name

INDEX_SCHEMA = "digest BINARY, keep_id BIGINT, group_size BIGINT, batch STRING"


def normal_text(text: Column) -> Column:
    """The text with A-Z lower-cased and nothing else; null as empty.

    ``lower`` does that much faster than ``translate`` where all characters are ASCII.
    """
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(F.encode(normal_text(text), "UTF-8"), 256))


class DigestIndex:
    """An index at ``path``, which may exist already; ``buckets`` must then be what it was.

    Its catalog entry is named by a hash of the exact path, so no two indexes share one, and points
    there alone; ``close`` drops the entry and keeps the files.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = "digest_index_" + hashlib.sha256(path.encode()).hexdigest()
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{self.name}` ({INDEX_SCHEMA}) USING parquet"
            f" CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS"
            f" LOCATION '{place}'"
        )

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS `{self.name}`")

    def _table(self) -> DataFrame:
        """All rows of the index, bucketed: a join by digest does not shuffle it."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def rows(self) -> DataFrame:
        """One row per digest, bucketed, with the number of its rows in all batches."""
        return self._table().groupBy("digest").agg(
            F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
        )

    def files(self) -> DataFrame:
        """The index as plain files: a join shuffles it, and can split a hot digest."""
        return self.spark.read.schema(INDEX_SCHEMA).parquet(self.path)

    def holds(self, batch: str) -> bool:
        return not self._table().filter(F.col("batch") == batch).isEmpty()

    def add(self, digests: DataFrame, batch: str) -> None:
        """Append a batch, unless it is there already, as after a retry.

        A new digest gets a row with the largest id and the number of rows. One that is there gets
        a row with the number alone, so the document that is kept stays the first batch's.

        ``digests`` has the columns doc_id and digest. Copies are counted before the shuffle, so
        a large group of them is one row per task. The counts are written before the join, which
        would otherwise be done first, on the rows.
        """
        if self.holds(batch):
            return
        counted = stage(
            digests.groupBy("digest").agg(
                F.max("doc_id").cast("bigint").alias("keep_id"), F.count("*").alias("group_size")
            )
        )
        added = counted.hint("merge").join(self._table(), "digest", "left_anti")
        if not self._table().isEmpty():
            again = counted.hint("merge").join(self._table(), "digest", "left_semi")
            added = added.unionAll(again.withColumn("keep_id", F.lit(None).cast("bigint")))
        (
            added.withColumn("batch", F.lit(batch)).repartition(self.buckets, "digest")
            .sortWithinPartitions("digest").write.insertInto(self.name)
        )


def default_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mark_copies(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    index: DigestIndex | None = None,
    batch: str | None = None,
    batches: Sequence[Column] = (),
) -> DataFrame:
    """One row per row of ``df``: doc_id, digest, keep_id, group_size, kept.

    New digests are added to ``index`` (by default one in a new scratch folder). A text that the
    index already had keeps the document of the batch that brought it. group_size counts the rows
    of all batches so far, this one included. ``batch`` names this one: given again under the same
    name, as after a lost driver, it counts once. ``batches``, conditions on the id of which one
    holds for each row (as ``doc_id``), add the rows in several batches, one after the other.
    """
    spark = df.sparkSession
    own = index or DigestIndex(spark, scratch_path(spark), default_buckets(spark))
    batch = batch or uuid.uuid4().hex
    digests = stage(
        df.select(F.col(id_col).alias("doc_id"), digest(F.col(text_col)).alias("digest"))
    )
    parts = list(batches) or [F.lit(True)]
    for i, part in enumerate(parts):
        own.add(digests.filter(part), f"{batch}/{i}")
    if index is None and len(parts) == 1:
        found = own.files().drop("batch")
    elif index is None:
        found = own.files().groupBy("digest").agg(
            F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
        )
    else:
        wanted = digests.select("digest").distinct()
        found = stage(wanted.hint("merge").join(own.rows(), "digest"))
    if index is None:
        own.close()
        found = stage(found) if len(parts) > 1 else found
    marked = digests.join(found, "digest")
    return marked.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def without_copies(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    index: DigestIndex | None = None,
) -> DataFrame:
    """The rows of ``df`` that are kept, one per digest, with all their columns."""
    marked = mark_copies(df, id_col, text_col, index).filter("kept")
    key, other = free_name(df, "kept_digest"), free_name(df, "kept_id")
    kept = marked.select(F.col("digest").alias(key), F.col("doc_id").alias(other)).distinct()
    own = free_name(df, "own_digest")
    rows = df.withColumn(own, digest(F.col(text_col)))
    on = reduce(
        Column.__and__, [F.col(own) == F.col(key), F.col(id_col).eqNullSafe(F.col(other))]
    )
    joined = rows.join(kept, on).drop(other, own)
    return joined.dropDuplicates([key]).drop(key).select(*[f"`{c}`" for c in df.columns])
