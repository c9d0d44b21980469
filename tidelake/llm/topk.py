"""Exact top-k search: tiled products of query blocks and shards, and a tree of merged top lists.

Vectors are dealt into shards of about ``SHARD_ROWS``, queries into blocks of about
``BLOCK_ROWS``. Each cell of the grid is one task's matrix product; of its scores only the k best
of each query leave the task. The lists of the shards are then merged in rounds, ``FAN_IN`` shards
at a time, by rank within the query.

Scores are integers: a component x counts as floor(scale * x), and products are computed in the
narrowest type that is exact (doubles up to 2**53, then 64-bit integers, then Python's integers,
whose scores are cut to the range of a long).

Nulls and edge cases: vectors that are null, or hold a null, NaN or infinite component, and rows
without an id take no part. Vectors are only compared with those of the same length; empty ones
score 0. A query's own row is the one with its id, so rows that repeat an id are not compared with
each other; for other queries they all are candidates. Queries that repeat an id and a vector ask
once; those that repeat an id with another vector share one list. Equal scores are ranked by the smaller id.
With fewer candidates than k all are returned. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidelake.lake import stage

SHARD_ROWS, BLOCK_ROWS, FAN_IN = 16_384, 4_096, 8
#: Rows of scores held at once in a task.
TILE_QUERIES, TILE_ROWS = 256, 4_096

CELL_SCHEMA = "query_id bigint, shard bigint, vec_id bigint, score bigint"


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component; null if the vector cannot take part."""
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return F.when(~bad, whole)


def _exact_product(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    bound = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * queries.shape[1]
    if bound < 2.0**53:
        return (queries @ rows.T).astype(np.int64)
    if bound < 2.0**63:
        return queries.astype(np.int64) @ rows.astype(np.int64).T
    whole = np.frompyfunc(int, 1, 1)
    scores = whole(queries).dot(whole(rows).T)
    return np.clip(scores, -(2**63) + 1, 2**63 - 1).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k best of one query: larger scores, then smaller ids."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        level = np.flatnonzero(scores == least)
        level = level[np.argsort(ids[level], kind="stable")][: k - len(above)]
        columns = np.concatenate([above, level])
    else:
        columns = np.arange(len(scores))
    return columns[np.lexsort((ids[columns], -scores[columns]))]


def search_tiles(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each query its id, and ids and scores of the k best rows with another id."""
    for q in range(0, len(query_ids), TILE_QUERIES):
        own = query_ids[q : q + TILE_QUERIES]
        kept: list[tuple[np.ndarray, np.ndarray]] = [
            (np.zeros(0, np.int64), np.zeros(0, np.int64))
        ] * len(own)
        for r in range(0, len(ids), TILE_ROWS):
            tile = ids[r : r + TILE_ROWS]
            scores = _exact_product(queries[q : q + TILE_QUERIES], rows[r : r + TILE_ROWS])
            for i, query in enumerate(own):
                other = tile != query
                near, far = (tile, scores[i]) if other.all() else (tile[other], scores[i][other])
                best = _best(far, near, k)
                both = np.concatenate([kept[i][0], near[best]])
                value = np.concatenate([kept[i][1], far[best]])
                best = _best(value, both, k)
                kept[i] = both[best], value[best]
        for query, (near, value) in zip(own, kept, strict=True):
            yield np.full(len(near), query), near, value


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    if not len(column):
        return np.zeros((0, width))
    return np.stack([np.asarray(v, np.float64) for v in column]).reshape(len(column), width)


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    scale: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows of every query.

    ``is_query`` is a condition on the id. Every cell of queries and shards is computed, so the
    work is their product; each vector is sent once per query block and each query once per shard.
    """
    rows = stage(
        vectors.filter(F.col(id_col).isNotNull()).select(
            F.col(id_col).cast("bigint").alias("id"),
            quantised(F.col(vector_col), scale).alias("v"),
            is_query.alias("asks"),
        ).filter("v IS NOT NULL")
    )
    n, asked = rows.agg(F.count("*"), F.count_if("asks")).first()
    shards, blocks = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(asked / block_rows))
    width = F.size("v").alias("width")
    # Dealt by the place in the staged files, so rows that repeat an id spread, too.
    place = F.xxhash64("_metadata.file_name", "_metadata.row_index")
    found = rows.select(
        F.col("id").alias("row"), F.col("v").alias("of_row"), width,
        F.pmod(place, F.lit(shards)).alias("shard"),
    )
    asking = rows.filter("asks").select(
        F.col("id").alias("query"), F.col("v").alias("of_query"), width,
        F.pmod(place, F.lit(blocks)).alias("block"),
    ).dropDuplicates(["query", "of_query"])
    # Every shard meets every block: a grid of tiles, not a join of rows.
    found = found.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn(
        "block", F.col("block").cast("bigint")
    )
    asking = asking.withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    ).withColumn("shard", F.col("shard").cast("bigint"))

    def cell(key: tuple, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        width, shard = int(key[0]), int(key[1])
        if not len(queries) or not len(rows):
            return pd.DataFrame({c: [] for c in ("query_id", "shard", "vec_id", "score")})
        lists = list(
            search_tiles(
                queries["query"].to_numpy(), _matrix(queries["of_query"], width),
                rows["row"].to_numpy(), _matrix(rows["of_row"], width), k,
            )
        )
        query, near, value = (np.concatenate(x) for x in zip(*lists, strict=True))
        return pd.DataFrame({"query_id": query, "shard": shard, "vec_id": near, "score": value})

    keys = ["width", "shard", "block"]
    lists = (
        asking.groupBy(*keys).cogroup(found.groupBy(*keys)).applyInPandas(cell, CELL_SCHEMA)
    )
    order = [F.desc("score"), F.asc("vec_id")]
    while shards > 1:
        shards = math.ceil(shards / FAN_IN)
        lists = lists.withColumn("shard", F.floor(F.col("shard") / FAN_IN))
        ranked = F.row_number().over(Window.partitionBy("query_id", "shard").orderBy(*order))
        lists = lists.withColumn("rank", ranked).filter(F.col("rank") <= k).drop("rank")
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return lists.withColumn("rank", ranked).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
