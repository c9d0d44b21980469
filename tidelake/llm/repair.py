"""Token ids in Re-Pair compressed shards with random access.

Documents are range-sorted by id, encoded, and gathered into shards of about ``SHARD_TOKENS`` ids.
Each shard has a grammar of its own. Re-Pair replaces the most frequent pair of neighbours by a new
symbol, again and again; here a round replaces many frequent pairs at once, chosen so that no two
of them can overlap (a symbol is only the left or only the right part of the round's pairs). Rounds
go on until no pair has ``LEAST_COUNT`` places. The shard stores the rules, the length of each symbol's expansion and the sequence that is left; to
read some ids, the lengths lead to the few symbols to expand.

The file format is a folder of Parquet files with one row per shard: ``part`` and ``number`` (shards
in this order hold the documents in ascending id order), ``begin`` (ids before it in its part),
``n_tokens``, ``first_id``, ``last_id`` and ``payload``. A payload is, in little-endian order: the
eight header numbers of ``HEADER``, document ids, null marks, document offsets, rules per round, rules,
expansion lengths, sequence.

Nulls and edge cases: a null text is empty, so its document is the end id alone. A null id sorts
first and is kept as null. Repeated ids are documents of their own, ordered by text hash,
and equal rows by the place they were read from, so that many of them go to many tasks. A very
long text makes a longer shard: a document never spans two. An empty table gives a folder
without rows. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidelake.llm.common import per_process, ranges, reads_files, slices, utf8, with_place
from tidelake.llm.tokens import Encoder, with_end
from tidelake.operators.joins import broadcast_if_small

MAGIC, VERSION = 0x52505347, 1
HEADER = 8  # magic, version, bytes of a symbol, terminals, documents, rounds, rules, symbols
SHARD_TOKENS = 1 << 20
#: A pair must be this frequent to become a rule, and this many rules are made in one round.
LEAST_COUNT, ROUND_RULES = 12, 3000
#: Text taken at once from an Arrow batch.
SLICE_BYTES = 12_000_000

FILE_SCHEMA = (
    "part int, number bigint, begin bigint, n_tokens bigint, first_id bigint, last_id bigint,"
    " payload binary"
)


def _slot(pairs: np.ndarray) -> np.ndarray:
    """A place from 0 to 65535 for each pair."""
    factor = pairs.dtype.type(0x9E3779B1 if pairs.itemsize == 4 else 0x9E3779B97F4A7C15)
    return (pairs * factor) >> pairs.dtype.type(8 * pairs.itemsize - 16)


def _chosen(pairs: np.ndarray, half: int, most: int) -> np.ndarray:
    """Indices of pairs, most frequent first, of which no two can overlap or share a place."""
    role: dict[int, int] = {}
    places: set[int] = set()
    chosen = []
    for i, (pair, place) in enumerate(zip(pairs.tolist(), _slot(pairs).tolist(), strict=True)):
        left, right = pair >> half, pair & ((1 << half) - 1)
        if place in places:
            continue  # it comes back in the next round
        if left == right:
            if left in role:
                continue
            role[left] = 3
        elif role.get(left, 1) != 1 or role.get(right, 2) != 2:
            continue
        else:
            role[left], role[right] = 1, 2
        places.add(place)
        chosen.append(i)
        if len(chosen) == most:
            break
    return np.array(chosen, np.int64)


def compress(ids: np.ndarray, terminals: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """What is left of the ids, the rules (left, right) and the number of rules of each round."""
    half, kind = (16, np.uint32) if terminals < 1 << 16 else (32, np.uint64)
    room = (1 << 16) - terminals if half == 16 else 1 << 31
    sequence, rules, rounds = ids.astype(kind), [], []
    while len(sequence) > 1:
        if not room:  # the symbols no longer fit into 16 bits
            half, kind, room = 32, np.uint64, 1 << 31
            sequence = sequence.astype(kind)
        pairs = (sequence[:-1] << kind(half)) | sequence[1:]
        found = np.sort(pairs)
        # A pair that is the same as the one LEAST_COUNT - 1 places on is frequent.
        alike = np.flatnonzero(found[LEAST_COUNT - 1 :] == found[: 1 - LEAST_COUNT])
        if not len(alike):
            break
        alike_pairs = found[alike]
        first = np.flatnonzero(np.concatenate([[True], alike_pairs[1:] != alike_pairs[:-1]]))
        count = np.diff(first, append=len(alike))  # less LEAST_COUNT - 1 each
        often = alike_pairs[first[np.argsort(-count, kind="stable")]]
        new = often[_chosen(often, half, min(room, ROUND_RULES))]
        if not len(new):
            break
        # One pair at most in each place of a table small enough to stay in the cache.
        table, symbol = np.zeros(1 << 16, kind), np.zeros(1 << 16, kind)
        table[0] = 1  # the pair 0 belongs there: an empty place must not look like it
        place = _slot(new)
        table[place] = new
        symbol[place] = terminals + sum(rounds) + np.arange(len(new))
        place = _slot(pairs)
        match = table[place] == pairs
        at = np.flatnonzero(match)
        # Neighbouring matches are runs of one symbol: every other one counts.
        head = np.concatenate([[True], np.diff(at) != 1])
        if not head.all():
            since = at - at[head][np.cumsum(head) - 1]
            at = at[since % 2 == 0]
        sequence[at] = symbol[place[at]]
        keep = np.ones(len(sequence), bool)
        keep[at + 1] = False
        sequence = sequence[keep]
        parts = np.stack([new >> kind(half), new & kind((1 << half) - 1)], axis=1)
        rules.append(parts.astype(np.int64))
        rounds.append(len(new))
        room -= len(new)
    if not rules:
        return sequence, np.zeros((0, 2), np.int64), rounds
    return sequence, np.concatenate(rules), rounds


def write_payload(
    ids: np.ndarray, at: np.ndarray, doc_ids: np.ndarray, nulls: np.ndarray, terminals: int
) -> bytes:
    sequence, rules, rounds = compress(ids, terminals)
    symbol = np.dtype("<u2") if terminals + len(rules) <= 1 << 16 else np.dtype("<u4")
    length = np.ones(terminals + len(rules), np.uint32)
    done = 0
    for n in rounds:
        own = rules[done : done + n]
        length[terminals + done : terminals + done + n] = length[own].sum(axis=1)
        done += n
    header = [MAGIC, VERSION, symbol.itemsize, terminals, len(doc_ids), len(rounds), len(rules),
              len(sequence)]
    parts = [
        np.array(header, "<i8"), doc_ids.astype("<i8"), nulls.astype("u1"), at.astype("<u4"),
        np.array(rounds, "<u4"), rules.astype(symbol), length[terminals:].astype("<u4"),
        sequence.astype(symbol),
    ]
    return b"".join(p.tobytes() for p in parts)


class Payload:
    """A shard as it was read."""

    def __init__(self, data: bytes):
        self.data, self.place = data, 0
        header = self._take("<i8", HEADER)
        if header[0] != MAGIC or header[1] != VERSION:
            raise ValueError("not a shard of token ids")
        _, _, size, self.terminals, docs, rounds, rules, symbols = map(int, header)
        self.doc_ids = self._take("<i8", docs)
        self.nulls = self._take("u1", docs).astype(bool)
        self.at = self._take("<u4", docs + 1).astype(np.int64)
        self.rounds = self._take("<u4", rounds)
        self.rules = self._take(f"<u{size}", 2 * rules).reshape(-1, 2).astype(np.int64)
        length = self._take("<u4", rules)
        self.sequence = self._take(f"<u{size}", symbols)
        self.length = np.concatenate([np.ones(self.terminals, np.int64), length])
        self.upto: np.ndarray | None = None  # ends of the sequence's symbols, once asked for

    def _take(self, kind: str, n: int) -> np.ndarray:
        found = np.frombuffer(self.data, kind, n, self.place)
        self.place += found.nbytes
        return found

    def _expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of every symbol, one symbol after the other, and where each begins."""
        begin = np.cumsum(self.length) - self.length
        pool = np.zeros(int(self.length.sum()), np.uint32)
        pool[: self.terminals] = np.arange(self.terminals)
        done = 0
        for n in self.rounds:  # the parts of a round's rules were made in earlier rounds
            parts = self.rules[done : done + n].ravel()
            to = begin[self.terminals + done]
            ids = pool[ranges(begin[parts], self.length[parts])]
            pool[to : to + len(ids)] = ids
            done += n
        return pool, begin

    def all_ids(self) -> np.ndarray:
        """All ids of the shard; every symbol is expanded once."""
        pool, at = self._expansions()
        return pool[ranges(at[self.sequence], self.length[self.sequence])]

    def ids(self, begin: int = 0, end: int | None = None) -> np.ndarray:
        """The ids from ``begin`` to ``end``; all of them if no end is given.

        Symbols are replaced by their parts level by level, and those outside are left out at
        every level by their lengths, so the work goes by the ids asked for and the depth.
        """
        if end is None:
            return self.all_ids()[begin:]
        if begin >= end:
            return np.zeros(0, np.uint32)
        if self.upto is None:
            self.upto = np.cumsum(self.length[self.sequence])
        first = int(np.searchsorted(self.upto, begin, side="right"))
        last = int(np.searchsorted(self.upto, end, side="left")) + 1
        symbols = self.sequence[first:last].astype(np.int64)
        start = int(self.upto[first - 1]) if first else 0
        while True:
            after = start + np.cumsum(self.length[symbols])
            inside = np.flatnonzero((after > begin) & (after - self.length[symbols] < end))
            start = int(after[inside[0]] - self.length[symbols[inside[0]]])
            symbols = symbols[inside]
            split = symbols >= self.terminals
            if not split.any():
                return symbols.astype(np.uint32)
            at = np.cumsum(1 + split) - 1 - split
            parts = np.repeat(symbols, 1 + split)
            rule = self.rules[symbols[split] - self.terminals]
            parts[at[split]], parts[at[split] + 1] = rule[:, 0], rule[:, 1]
            symbols = parts

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.at[i]), int(self.at[i + 1]))


class _Shards:
    """Gathers documents of one task and makes a row of every full shard."""

    def __init__(self, terminals: int):
        self.terminals, self.part = terminals, TaskContext.get().partitionId()
        self.number = self.begin = 0
        self.held: list[tuple] = []
        self.tokens = 0

    def add(self, ids, at, doc_ids, nulls) -> Iterator[pa.RecordBatch]:
        done = 0
        while done < len(doc_ids):
            room = at[done] + max(SHARD_TOKENS - self.tokens, 1)
            upto = max(int(np.searchsorted(at, room, side="left")), done + 1)
            upto = min(upto, len(doc_ids))
            self.held.append(
                (ids[at[done] : at[upto]], np.diff(at[done : upto + 1]), doc_ids[done:upto],
                 nulls[done:upto])
            )
            self.tokens += int(at[upto] - at[done])
            done = upto
            if self.tokens >= SHARD_TOKENS:
                yield self.flush()

    def flush(self) -> pa.RecordBatch:
        ids, count, doc_ids, nulls = (np.concatenate(x) for x in zip(*self.held, strict=True))
        at = np.concatenate([[0], np.cumsum(count)])
        known = doc_ids[~nulls]
        row = {
            "part": pa.array([self.part], pa.int32()),
            "number": pa.array([self.number], pa.int64()),
            "begin": pa.array([self.begin], pa.int64()),
            "n_tokens": pa.array([len(ids)], pa.int64()),
            "first_id": pa.array([int(known[0]) if len(known) else None], pa.int64()),
            "last_id": pa.array([int(known[-1]) if len(known) else None], pa.int64()),
            "payload": pa.array(
                [write_payload(ids, at, doc_ids, nulls, self.terminals)], pa.binary()
            ),
        }
        self.number += 1
        self.begin += len(ids)
        self.held, self.tokens = [], 0
        return pa.RecordBatch.from_arrays(list(row.values()), list(row))


def write_tokens(
    df: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode the texts with the tokenizer file and write them at ``path`` in order of their ids.

    One shuffle: the range sort of the texts. A task holds one slice of text and one shard.
    """
    kept = per_process(df.sparkSession)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept("encoder", lambda: Encoder(tokenizer))
        out = _Shards(max(encoder.size, end_id + 1))
        for batch in slices(batches, "text", SLICE_BYTES):
            ids, at = with_end(*encoder.encode(*utf8(batch.column("text"))), end_id)
            column = batch.column("id")
            nulls = column.is_null().to_numpy(zero_copy_only=False)
            yield from out.add(ids, at, column.fill_null(0).to_numpy(), nulls)
        if out.held:
            yield out.flush()

    given = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    placed, place = with_place(given, reads_files(given))
    order = ["id", "tie", *place]
    rows = placed.withColumn("tie", F.xxhash64("text")).repartitionByRange(*order)
    rows = rows.sortWithinPartitions(*order).select("id", "text")
    # A reader takes a row group's rows at once, so groups are kept small.
    rows.mapInArrow(shards, FILE_SCHEMA).write.option("parquet.block.size", 16 << 20).option(
        "compression", "zstd"
    ).parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before), n_tokens, ids_crc32, ids.

    The checksum is that of the ids as little-endian unsigned 32-bit numbers. ``with_ids`` adds
    the ids themselves.
    """
    kinds = "doc_id bigint, part int, begin bigint, n_tokens bigint, ids_crc32 bigint"
    kinds += ", ids array<int>" if with_ids else ""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, begin, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                shard = Payload(data)
                ids = shard.all_ids().astype("<u4")
                raw, at = memoryview(ids.tobytes()), shard.at
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1], at[1:])]
                columns = [
                    pa.array(shard.doc_ids, mask=shard.nulls),
                    pa.array(np.full(len(crc), part, np.int32)),
                    pa.array(begin + at[:-1]),
                    pa.array(np.diff(at)),
                    pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    columns.append(
                        pa.ListArray.from_arrays(at.astype(np.int32), ids.astype(np.int32))
                    )
                names = ["doc_id", "part", "begin", "n_tokens", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    shards = read_shards(spark, path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (  # one row per task that wrote
        shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    docs = shards.select("part", "begin", "payload").mapInArrow(decode, kinds)
    return docs.join(broadcast_if_small(parts), "part").select(
        "doc_id", (F.col("offset") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32",
        *(["ids"] if with_ids else []),
    )


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of the documents with this id; only shards that can hold it are read."""
    near = read_shards(spark, path).filter(
        (F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)
    )
    found = []
    for row in near.select("payload").toLocalIterator():  # one shard, or few if the id repeats
        shard = Payload(bytes(row.payload))
        at = np.flatnonzero((shard.doc_ids == doc_id) & ~shard.nulls)
        found += [shard.document(int(i)) for i in at]
    return found
