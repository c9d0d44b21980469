"""Mixing sources to target weights by cube-method balanced sampling.

Each source gets a target of words: its share by weight, at most ``MOST_COPIES`` times its own
words, what is cut off shared again by weight. A document of a source whose target is r times its
words is taken floor(r) times, and once more with probability r - floor(r). Which ones are taken
once more is decided by the cube method: the probabilities of a few documents at a time are moved
along a direction in which neither the number of documents nor the number of words changes, until
one of them is 0 or 1. Blocks of documents do this side by side; what is left undecided, at most
two documents of a source and block, meets again in a quarter of the blocks or less, until one block is
left. There the largest few documents of each source wait; with the last two undecided ones they
are the landing problem, solved by trying every rounding.

Nulls and edge cases: a null text has size 0, a null source is a source of its own, the last one.
Documents of size 0 are decided like others; they add no words. A source without words has target
0. Repeated rows, and rows that repeat an id or have none, count each for itself. The draws are
hashes of a seed and the row's number in the order of source, id and size, and blocks depend on the
rows alone, so reruns agree. An empty table gives no rows. Other
columns are carried by ``mixed_rows`` only.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidelake.lake import stage
from tidelake.llm.common import free_name, with_place
from tidelake.operators.joins import join_dimension
from tidelake.operators.numbering import surrogate_key

# Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
#: Documents of a block, about.
BLOCK_ROWS = 4_000
#: Documents of a source, besides at most two, that are rounded together at the end.
LANDING = 12
#: Probabilities this close to 0 or 1 are decided.
EPSILON = 1e-9


def n_words(text: Column) -> Column:
    """Number of runs of characters that are no ASCII white space; null: 0."""
    return F.coalesce(
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)
    ).cast("bigint")


def water_level(rows: DataFrame) -> float:
    """The level at which the sum of all min(most, level * weight) is that of the sizes.

    It rises from 0: sources that are full at a level keep what they hold, and the rest is shared
    by the others, until no more of them are full. A rise is one aggregation. With each one the
    words that are left or the weight that is not full are halved at least, so there are few.
    """
    level, before = 0.0, -1
    while True:
        is_full = F.col("full_at") <= level
        words, held, weight, n = rows.agg(
            F.sum("source_size"), F.sum(F.when(is_full, F.col("most"))),
            F.sum(F.when(~is_full, F.col("weight"))), F.count_if(is_full),
        ).first()
        if n == before or weight is None:
            return level
        level, before = (words - (held or 0)) / weight, n


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target, copies (whole) and chance (of one more), one row per source.

    Sources may be as many as documents: they are numbered by a range sort, written once, and the
    driver sees four sums of them at a time.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = totals.withColumn("no_source", F.col("source").isNull())
    number = F.col("number") - 1
    weight = F.element_at(
        F.array(*[F.lit(w) for w in WEIGHTS]), (number % len(WEIGHTS) + 1).cast("int")
    )
    rows = stage(
        surrogate_key(ordered, "number", ["no_source", "source"], unique=True).select(
            "source", "source_size", weight.alias("weight"),
            (F.col("source_size") * MOST_COPIES).alias("most"),
        )
    ).withColumn("full_at", F.col("most") / F.col("weight"))
    target = F.least(F.col("most").cast("double"), F.lit(water_level(rows)) * F.col("weight"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    near = F.when(F.abs(ratio - F.round(ratio)) < EPSILON, F.round(ratio)).otherwise(ratio)
    shares = rows.withColumn("target", target).withColumn("ratio", near)
    return shares.select(
        "source", "source_size", "target", F.floor("ratio").cast("int").alias("copies"),
        (F.col("ratio") - F.floor("ratio")).alias("chance"),
    )


class Flight:
    """The flight phase over a stream of (size, chance): at most two units stay undecided.

    Three units with sizes a, b, c can move along (b - c, c - a, a - b): the sum of chances and
    the sum of chance * size stay the same.
    """

    def __init__(self) -> None:
        self.open: list[list] = []  # [key, size, chance, draw]

    def add(self, key, size: int, chance: float, draw: float) -> list[tuple[object, bool]]:
        self.open.append([key, size, chance, draw])
        return self._move(3)

    def _move(self, least: int) -> list[tuple[object, bool]]:
        decided = []
        while len(self.open) >= least:
            units = self.open[:3]
            a, b, c = (u[1] for u in units)
            way = (b - c, c - a, a - b) if (a, b) != (c, c) else (1, -1, 0)
            up = down = math.inf
            for (_, _, chance, _), step in zip(units, way, strict=True):
                if step:
                    rise, fall = (1 - chance) / abs(step), chance / abs(step)
                    up = min(up, rise if step > 0 else fall)
                    down = min(down, fall if step > 0 else rise)
            # Up with probability down / (up + down), so that every chance keeps its mean.
            move = up if units[0][3] * (up + down) < down else -down
            for unit, step in zip(units, way, strict=True):
                unit[2] += move * step
            # The draw is used up; the next one follows from it.
            units[0][3] = (units[0][3] * 65_537.0 + 0.5) % 1.0
            decided += [(u[0], u[2] > 0.5) for u in units if not EPSILON < u[2] < 1 - EPSILON]
            self.open = [u for u in self.open if EPSILON < u[2] < 1 - EPSILON]
        return decided


def land(units: list[list]) -> list[tuple[object, bool]]:
    """Round the last units (key, size, chance, …) of a source, trying every way.

    Of the ways in which the number of documents is off by less than one, the one whose words come
    nearest; of equal ones the one with the larger chances.
    """
    sizes = np.array([u[1] for u in units], float)
    chances = np.array([u[2] for u in units])
    ways = (np.arange(1 << len(units))[:, None] >> np.arange(len(units))) & 1
    off = np.abs(ways.sum(axis=1) - chances.sum())
    error = np.abs(ways @ sizes - chances @ sizes)
    error[off >= 1] = np.inf
    near = np.flatnonzero(error <= error.min() + 1e-6)
    best = ways[near[np.argmax(ways[near] @ chances)]]
    return [(u[0], bool(t)) for u, t in zip(units, best, strict=True)]


def _flight(last: bool):
    """Rows (block, source, key, size, chance, draw) sorted by block and source, to the same
    rows with ``extra``: 0 or 1, or null with the chance that is left.

    In the last round the ``LANDING`` largest documents of each source wait for the landing, where
    they make up for each other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, flight, held = None, Flight(), {}
        waiting: list[tuple] = []  # a heap: the smallest document first
        out: list[tuple] = []

        def close() -> None:
            left = flight.open
            if last:
                left = left + [[number, size, chance] for size, number, chance, _ in waiting]
                waiting.clear()
                out.extend((*held.pop(k), None, int(t)) for k, t in land(left) if left)
            else:
                out.extend((*held.pop(u[0]), u[2], None) for u in left)

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * len(_KINDS)
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _KINDS.values(), strict=True)],
                list(_KINDS),
            )

        number = 0
        for rows in batches:
            for block, source, key, size, chance, draw in zip(
                *(c.to_pylist() for c in rows.columns), strict=True
            ):
                if (block, source) != group:
                    close()
                    group, flight = (block, source), Flight()
                number += 1
                held[number] = (source, key, size, draw)
                unit = (size, number, chance, draw)
                if last and len(waiting) < LANDING:
                    heapq.heappush(waiting, unit)
                    continue
                if last:
                    unit = heapq.heappushpop(waiting, unit)
                for k, taken in flight.add(unit[1], unit[0], unit[2], unit[3]):
                    out.append((*held.pop(k), None, int(taken)))
            yield batch()
        close()
        yield batch()

    return run


_KINDS = {
    "source": pa.string(), "key": pa.int64(), "size": pa.int64(), "draw": pa.float64(),
    "chance": pa.float64(), "extra": pa.int32(),
}
_FLIGHT_SCHEMA = "source string, key bigint, size bigint, draw double, chance double, extra int"


def decide(units: DataFrame, seed: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """source, key, size, extra (0 or 1) of units (source, key, size, chance) by the cube method."""
    # A draw from 0 to 1 that depends on the row and the seed alone.
    hashed = F.xxhash64(F.lit(seed), "source", "key", "size")
    rows = units.withColumn("draw", F.shiftrightunsigned(hashed, 11) / F.lit(2.0**53))
    rows = stage(rows.select("source", "key", "size", "chance", "draw"))
    done: list[DataFrame] = []
    count, level, blocks = rows.count(), 0, 1 << 62
    while True:
        blocks = max(1, min(math.ceil(count / block_rows), blocks // 4))
        block = F.pmod(F.xxhash64(F.lit(seed + level), "key", "size"), F.lit(blocks))
        ordered = (
            rows.withColumn("block", block)
            .repartition("block", "source")
            .sortWithinPartitions("block", "source", "draw", "key", "size")
            .select("block", "source", "key", "size", "chance", "draw")
        )
        flown = stage(ordered.mapInArrow(_flight(last=blocks == 1), _FLIGHT_SCHEMA))
        done.append(flown.filter("extra IS NOT NULL").select("source", "key", "size", "extra"))
        if blocks == 1:
            break
        rows, level = flown.filter("extra IS NULL").drop("extra"), level + 1
        count = rows.count()
    result = done[0]
    for frame in done[1:]:
        result = result.unionAll(frame)
    return result


def mix(
    df: DataFrame, seed: int = 42, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source", block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    ``copies`` says how often the mix takes the document, ``taken`` is copies * size.
    """
    docs = df.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).alias("source"),
        n_words(F.col(text_col)).alias("size"),
    )
    return _mix(docs, seed, block_rows)


def _mix(
    docs: DataFrame, seed: int, block_rows: int = BLOCK_ROWS, carried: Sequence[str] = ()
) -> DataFrame:
    """The same for rows (doc_id, source, size, …); the columns ``carried`` are returned, too.

    Each row is a unit of its own, known by its number in the order of source, id and size. So rows
    without an id and rows that repeat one are spread over the blocks like any others, and what is
    decided does not depend on the files that the rows lie in.
    """
    order = ["source", "doc_id", "size"]
    docs = surrogate_key(docs.select(*order, *carried), "unit", order)
    own = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    targets = stage(source_targets(docs).withColumn("key", own))
    units = join_dimension(
        docs, targets, own, "key",
        {"source_size": "source_size", "target": "target", "copies": "whole", "chance": "chance"},
    )
    open_units = units.filter("chance > 0").select(
        "source", F.col("unit").alias("key"), "size", "chance"
    )
    extra = decide(open_units, seed, block_rows).select(F.col("key").alias("unit"), "extra")
    copies = F.col("whole") + F.coalesce(F.col("extra").cast("int"), F.lit(0))
    return units.join(extra, "unit", "left").withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"), *carried,
    )


def mixed_rows(df: DataFrame, seed: int = 42, is_scan: bool = False) -> DataFrame:
    """The rows of ``df`` with all their columns, each as often as the mix takes it.

    Every row is decided for itself, also where ids repeat or are null. ``is_scan`` is that of
    ``with_place``.
    """
    placed, place = with_place(df, is_scan)
    at = [f"at_{i}" for i in range(len(place))]
    docs = placed.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").alias("source"),
        n_words(F.col("text")).alias("size"), *[F.col(c).alias(n) for c, n in zip(place, at)],
    )
    times, copy = free_name(placed, "mix_times"), free_name(placed, "mix_copy")
    chosen = _mix(docs, seed, carried=at).filter("copies > 0").select(
        *[F.col(n).alias(c) for c, n in zip(place, at)], F.col("copies").alias(times)
    )
    joined = placed.join(chosen, place)
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), times))).select(
        *[f"`{c}`" for c in df.columns]
    )
