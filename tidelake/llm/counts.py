"""Token counts by a two-tier lookup at the map side.

A text is cut into pre-tokens such that its tokens are those of its pre-tokens, one after the
other. The lengths (in tokens) of the frequent pre-tokens are looked up in a compact hash table
that is broadcast; the others are looked up in a cache of the worker, and encoded by the
tokenizer's library when it has not got them either. No pre-token is shuffled.

The frequent pre-tokens are found by one pass over all texts: every task keeps a Misra-Gries
summary of ``FREQUENT`` counters, and the summaries are merged in a tree. A pre-token that makes up
more than 1/``FREQUENT`` of all is surely in the table. Which ones are there changes the time only,
never a count.

Where texts are cut. SentencePiece with a plain normalizer: before every run of spaces and before
every line feed, if no piece of the model reaches across. Byte-level files of the tokenizers
library: as ``tokens.chunk_bounds`` says; a text that holds the string of an added token is one
pre-token. With any other file a text is one pre-token. So the counts are always the library's.

Nulls and edge cases: a null or empty text has no bytes and no tokens. Null ids are carried
through, repeated rows are counted each for itself. Texts of any length are counted whole. An empty
table gives an empty result. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import json
import os
import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidelake.llm.common import per_process, ranges, slices, text_array, utf8
from tidelake.llm.tokens import chunk_bounds, uncut
from tidelake.llm.trees import merged_state

#: Counters of a summary, and so entries of the broadcast table at most.
FREQUENT = 1 << 15
#: Longer pre-tokens (in bytes) are neither in the table nor in a cache.
LONGEST = 256
#: A worker's cache is emptied when its keys have so many bytes.
CACHE_BYTES = 16 << 20
SLICE_BYTES = 2_000_000
MARK = "▁"
_FEED, _SPACE = 10, 32


class PieceUnits:
    """Pre-tokens of a SentencePiece model, each with the spaces in front of it."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        how, train = proto.normalizer_spec, proto.trainer_spec
        own = [p.piece for p in proto.pieces if p.type in (p.NORMAL, p.USER_DEFINED, p.UNUSED)]
        self.divisible = (
            not how.precompiled_charsmap
            and not how.normalization_rule_tsv
            and how.add_dummy_prefix
            and how.escape_whitespaces
            and not how.remove_extra_whitespaces
            and not train.treat_whitespace_as_suffix
            and train.byte_fallback
            and not any("\n" in p or " " in p for p in own)
            and not any(MARK in p.lstrip(MARK) for p in own)
            and not any(p.type == p.USER_DEFINED for p in proto.pieces)
        )

    def cut(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes, the bounds of the units in them, and each text's offset.

        A text that is not empty gets the space that the library puts in front of it.
        """
        if not self.divisible:
            return data, np.unique(at), at
        full = np.diff(at) > 0
        lead = at + np.concatenate([[0], np.cumsum(full)])
        spaced = np.full(int(lead[-1]), _SPACE, np.uint8)
        spaced[ranges(lead[:-1] + full, np.diff(at))] = data
        begins = spaced == _SPACE  # first bytes of spaces and space marks
        ends = begins.copy()
        if len(spaced) > 2:
            mark = (spaced[:-2] == 0xE2) & (spaced[1:-1] == 0x96) & (spaced[2:] == 0x81)
            begins[:-2] |= mark
            ends[2:] |= mark
        cut = np.zeros(len(spaced) + 1, bool)
        cut[:-1] = spaced == _FEED
        cut[1:-1] |= begins[1:] & ~ends[:-1]
        cut[lead] = True
        return spaced, np.flatnonzero(cut), lead

    def count(self, units: list[str]) -> list[int]:
        """Tokens of each unit.

        The line feed, one token in any place, keeps the space that the library puts in front
        alive: it stands for the unit's own first space.
        """
        if not self.divisible:
            return [len(x) for x in self.processor.encode(units, num_threads=1)]
        feeds = [u[0] == "\n" for u in units]
        given = [u if feed else u[1:] + "\n" for u, feed in zip(units, feeds)]
        return [len(x) - 1 for x in self.processor.encode(given, num_threads=1)]


class FileUnits:
    """Pre-tokens of a file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        how = spec.get("pre_tokenizer") or {}
        self.divisible = (
            spec.get("normalizer") is None
            and how.get("type") == "ByteLevel"
            and not how.get("add_prefix_space")
            and how.get("use_regex", True)
        )
        self.added = [t["content"].encode() for t in spec.get("added_tokens") or []]

    def cut(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.divisible:
            return data, np.unique(at), at
        return data, uncut(data, at, chunk_bounds(data, at), self.added), at

    def count(self, units: list[str]) -> list[int]:
        return [
            len(x.ids) for x in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)
        ]


def units_of(path: str) -> PieceUnits | FileUnits:
    return FileUnits(path) if path.endswith(".json") else PieceUnits(path)


def hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte string."""
    width = np.diff(at)
    found = np.zeros(len(width), np.uint64)
    if not len(data):
        return found
    place = ranges(np.zeros(len(width), np.int64), width).astype(np.uint64)
    mixed = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= (place + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    full = width > 0
    found[full] = np.add.reduceat(mixed, at[:-1][full])
    return found


class LengthTable:
    """A hash table with open addressing from byte strings to small numbers, in flat arrays."""

    def __init__(self, keys: list[bytes], values: list[int]):
        self.at = np.concatenate([[0], np.cumsum([len(k) for k in keys], dtype=np.int64)])
        self.data = np.frombuffer(b"".join(keys), np.uint8)
        self.values = np.array(values, np.int32)
        size = 1 << max(4, (2 * len(keys)).bit_length())
        self.mask = np.uint64(size - 1)
        self.slots = np.full(size, -1, np.int32)
        self.hashes = hashes(self.data, self.at)
        for i, place in enumerate((self.hashes & self.mask).tolist()):
            while self.slots[place] >= 0:
                place = (place + 1) % size
            self.slots[place] = i

    def look_up(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The value of each byte string, -1 for those that are not there."""
        found = np.full(len(at) - 1, -1, np.int64)
        width, code = np.diff(at), hashes(data, at)
        open_ = np.arange(len(width))
        place = code & self.mask
        while len(open_):
            entry = self.slots[place[open_]]
            open_, entry = open_[entry >= 0], entry[entry >= 0]
            alike = (self.hashes[entry] == code[open_]) & (
                self.at[entry + 1] - self.at[entry] == width[open_]
            )
            near, own = open_[alike], entry[alike]
            if len(near):
                upto = np.concatenate([[0], np.cumsum(width[near])])
                differ = data[ranges(at[near], width[near])] != self.data[
                    ranges(self.at[own], width[near])
                ]
                differ = np.concatenate([[0], np.cumsum(differ)])
                same = differ[upto[1:]] == differ[upto[:-1]]
                found[near[same]] = self.values[own[same]]
            open_ = open_[found[open_] < 0]
            place[open_] = (place[open_] + np.uint64(1)) & self.mask
        return found


def shrink(keys: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A Misra-Gries summary of at most so many counters."""
    if len(counts) <= most:
        return keys, counts
    counts = counts - np.partition(counts, -most - 1)[-most - 1]
    return keys[counts > 0], counts[counts > 0]


def merge_summaries(states: list[bytes]) -> bytes:
    total: dict[bytes, int] = {}
    for state in states:
        for key, n in pickle.loads(state):
            total[key] = total.get(key, 0) + n
    return _packed(total)


def _packed(total: dict[bytes, int]) -> bytes:
    keys = np.fromiter(total, object, len(total))
    keys, counts = shrink(keys, np.fromiter(total.values(), np.int64, len(total)), FREQUENT)
    return pickle.dumps(list(zip(keys.tolist(), counts.tolist())))


def _distinct(data: np.ndarray, bounds: np.ndarray) -> pa.DictionaryArray:
    return text_array(data, bounds).dictionary_encode()


def frequent_units(texts: DataFrame, tokenizer: str) -> list[str]:
    """The pre-tokens of a summary of the column ``_text``, in the order of their bytes."""
    kept = per_process(texts.sparkSession)

    def summarise(batches: Iterable[pa.RecordBatch]) -> bytes | None:
        units = kept("units", lambda: units_of(tokenizer))
        total: dict[bytes, int] = {}
        for batch in slices(batches, "_text", SLICE_BYTES):
            data, bounds, _ = units.cut(*utf8(batch.column("_text")))
            if len(bounds) < 2:
                continue
            found = _distinct(data, bounds)
            count = np.bincount(found.indices.to_numpy(), minlength=len(found.dictionary))
            raw = found.dictionary.cast(pa.large_binary())
            for key, n in zip(raw.to_pylist(), count.tolist()):
                if len(key) <= LONGEST:
                    total[key] = total.get(key, 0) + n
            if len(total) > 4 * FREQUENT:
                total = dict(pickle.loads(_packed(total)))
        return _packed(total) if total else None

    state = merged_state(texts.select("_text"), summarise, merge_summaries)
    return [k.decode() for k, _ in sorted(pickle.loads(state))] if state else []


class Counter:
    """Counts of texts: the table, then the cache, then the library."""

    def __init__(self, tokenizer: str, table: LengthTable):
        self.units, self.table = units_of(tokenizer), table
        self.cache: dict[str, int] = {}
        self.cached = 0

    def _missed(self, units: list[str]) -> list[int]:
        counts = [self.cache.get(u) for u in units]
        new = [i for i, n in enumerate(counts) if n is None]
        if new:
            for i, n in zip(new, self.units.count([units[i] for i in new])):
                counts[i] = n
                if len(units[i]) <= LONGEST:
                    self.cache[units[i]] = n
                    self.cached += len(units[i])
            if self.cached > CACHE_BYTES:
                self.cache, self.cached = {}, 0
        return counts

    def count(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and tokens of each text."""
        given, at = utf8(texts)
        n_bytes = np.diff(at)
        data, bounds, at = self.units.cut(given, at)
        if len(bounds) < 2:
            return n_bytes, np.zeros(len(n_bytes), np.int64)
        found = _distinct(data, bounds)
        own = self.table.look_up(*utf8(found.dictionary))
        missed = np.flatnonzero(own < 0)
        if len(missed):
            own[missed] = self._missed(found.dictionary.take(pa.array(missed)).to_pylist())
        upto = np.concatenate([[0], np.cumsum(own[found.indices.to_numpy()])])
        return n_bytes, np.diff(upto[np.searchsorted(bounds, at)])


def count_tokens(
    df: DataFrame, tokenizer: str, limit: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: the id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    ``tokenizer`` is the path of a file of the tokenizers library (.json) or of SentencePiece, the
    same on every machine. Texts are read twice and not shuffled.
    """
    chosen = df.select(F.col(id_col), F.col(text_col).alias("_text"))
    kind = chosen.schema[id_col].dataType.simpleString()
    frequent = frequent_units(chosen, tokenizer)
    values = units_of(tokenizer).count(frequent) if frequent else []
    table = LengthTable([u.encode() for u in frequent], values)
    shared = df.sparkSession.sparkContext.broadcast(table)
    kept = per_process(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = kept("counter", lambda: Counter(tokenizer, shared.value))
        for batch in slices(batches, "_text", SLICE_BYTES):
            n_bytes, n_tokens = counter.count(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes), pa.array(n_tokens)],
                [id_col, "n_bytes", "n_tokens"],
            )

    counted = chosen.mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
