"""Token ids of whole texts, fast where words repeat: each distinct chunk of a slice is encoded once,
and the ids of short chunks are kept for later slices.

A text is cut only where a byte-level tokenizer with the usual word pattern must begin a new
pre-token, so that the ids of the chunks, one after the other, are those of the whole text:
before a single space or line feed between two characters that are no white space, after such a
line feed, and between an ASCII letter and an ASCII punctuation mark other than the apostrophe.
"""

from __future__ import annotations

import os
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidelake.llm.common import ranges, text_array

_LETTER, _MARK, _DIGIT, _QUOTE, _SPACE, _FEED = 3, 4, 5, 6, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[ord("a") : ord("z") + 1] = _LETTER
_KIND[ord("A") : ord("Z") + 1] = _LETTER
_KIND[ord("'")] = _QUOTE
_KIND[ord(" ")], _KIND[ord("\n")] = _SPACE, _FEED


def solid(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes that surely begin, and that surely end, a character which is no white space.

    Characters U+00C0 to U+07FF (first byte C3 to DF) are never white space.
    """
    ascii_solid = _KIND[data] >= _LETTER
    lead = (data >= 0xC3) & (data <= 0xDF)
    last = ascii_solid.copy()
    last[1:] |= lead[:-1]
    return ascii_solid | lead, last


def chunk_bounds(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Offsets in ``data`` at which chunks of the texts (at offsets ``at``) begin and end."""
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 2:
        begins, ends = solid(data)
        kind = _KIND[data]
        alone = ((kind[1:-1] == _SPACE) | (kind[1:-1] == _FEED)) & ends[:-2] & begins[2:]
        cut[1:-2] |= alone
        cut[2:-1] |= alone & (kind[1:-1] == _FEED)
        cut[1:-1] |= (kind[:-1] == _LETTER) & (kind[1:] == _MARK)
    cut[at] = True
    return np.flatnonzero(cut)


def uncut(
    data: np.ndarray, at: np.ndarray, bounds: np.ndarray, strings: Iterable[bytes]
) -> np.ndarray:
    """The bounds without those inside texts that hold one of the strings."""
    raw = data.tobytes()
    inside = np.zeros(len(bounds), bool)
    for string in strings:
        place = raw.find(string)
        while place >= 0:
            text = int(np.searchsorted(at, place, side="right")) - 1
            if place + len(string) <= at[text + 1]:
                inside |= (bounds > at[text]) & (bounds < at[text + 1])
                place = raw.find(string, at[text + 1])
            else:
                place = raw.find(string, place + 1)
    return bounds[~inside]


class Encoder:
    """Ids of the texts of a slice, from a tokenizer file of the tokenizers library.

    The string of an added token inside a text is that token, as the library has it by default; so a
    text that holds one is not cut.
    """

    #: Chunks joined for one call of the tokenizer.
    JOINED = 1000
    #: Chunks whose ids are kept from slice to slice: this many, each of at most so many bytes.
    KEPT, KEPT_BYTES = 400_000, 40

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content.encode() for t in added]
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.width = np.zeros(self.size, np.int64)  # bytes of each token
        for token, number in vocabulary.items():
            self.width[number] = len(token)
        self.kept = text_array(np.zeros(0, np.uint8), np.zeros(1, np.int64))
        self.kept_ids, self.kept_count = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [x.ids for x in found]

    def _known_pool(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``_pool``, but chunks that an earlier slice had are not encoded again."""
        place = pc.fill_null(pc.index_in(chunks, self.kept), -1).to_numpy().astype(np.int64)
        fresh = np.flatnonzero(place < 0)
        if not len(fresh):
            begin = np.cumsum(self.kept_count) - self.kept_count
            own = self.kept_count[place]
            return self.kept_ids[ranges(begin[place], own)], own
        new = chunks.take(pa.array(fresh))
        new_ids, new_count = self._pool(new)
        ids, count = (
            np.concatenate([self.kept_ids, new_ids]), np.concatenate([self.kept_count, new_count])
        )
        place[fresh] = len(self.kept) + np.arange(len(fresh))
        begin = np.cumsum(count) - count
        room = self.KEPT - len(self.kept)
        if room > 0:
            short = np.flatnonzero(pc.binary_length(new).to_numpy() <= self.KEPT_BYTES)[:room]
            own, own_count = len(self.kept) + short, new_count[short]
            self.kept = pa.concat_arrays([self.kept, new.take(pa.array(short))])
            self.kept_ids = np.concatenate([self.kept_ids, ids[ranges(begin[own], own_count)]])
            self.kept_count = np.concatenate([self.kept_count, own_count])
        return ids[ranges(begin[place], count[place])], count[place]

    def _pool(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, one chunk after the other, and the number of ids of each."""
        _, offsets, data = chunks.buffers()
        at = np.frombuffer(offsets, np.int64)[chunks.offset : chunks.offset + len(chunks) + 1]
        data = np.frombuffer(data, np.uint8)
        width = np.diff(at)
        begins, ends = solid(data)
        joinable = width > 1
        joinable[joinable] = (
            (data[at[:-1][joinable]] == 32)
            & begins[at[:-1][joinable] + 1]
            & ends[at[1:][joinable] - 1]
        )
        count = np.zeros(len(chunks), np.int64)
        ids: list[np.ndarray] = []
        order: list[np.ndarray] = []
        # Chunks of one word with the space before it: joined, the spaces keep them apart.
        words = np.flatnonzero(joinable)
        joined = data[ranges(at[words], width[words])].tobytes()
        to = np.concatenate([[0], np.cumsum(width[words])])[:: self.JOINED].tolist()
        to += [len(joined)] if len(words) % self.JOINED else []
        groups = [joined[a:b].decode() for a, b in zip(to[:-1], to[1:])]
        loose = [np.flatnonzero(~joinable)]
        for k, found in enumerate(self._encode(groups)):
            own = words[k * self.JOINED : (k + 1) * self.JOINED]
            found = np.array(found, np.uint32)
            upto = np.cumsum(self.width[found])
            last = np.searchsorted(upto, np.cumsum(width[own]))
            if upto[-1] != width[own].sum() or (upto[last] != np.cumsum(width[own])).any():
                loose.append(own)  # a tokenizer with another pattern: take them one by one
                continue
            count[own] = np.diff(last, prepend=-1)
            ids.append(found)
            order.append(own)
        rest = np.concatenate(loose)
        for i, found in zip(rest, self._encode(chunks.take(pa.array(rest)).to_pylist())):
            count[i] = len(found)
            ids.append(np.array(found, np.uint32))
        order.append(rest)
        # Put the ids in the order of the chunks.
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        order = np.concatenate(order)
        begin = np.zeros(len(chunks), np.int64)
        begin[order] = np.cumsum(count[order]) - count[order]
        return flat[ranges(begin, count)], count

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts at offsets ``at`` of ``data``, and each text's offset in them."""
        bounds = uncut(data, at, chunk_bounds(data, at), self.added)
        if len(bounds) < 2:
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        chunks = text_array(data, bounds).dictionary_encode()
        pool, count = self._known_pool(chunks.dictionary)
        codes = chunks.indices.to_numpy()
        begin = np.cumsum(count) - count
        own = count[codes]
        ids = pool[ranges(begin[codes], own)]
        upto = np.concatenate([[0], np.cumsum(own)])
        return ids, upto[np.searchsorted(bounds, at)]


def with_end(ids: np.ndarray, at: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with ``end`` after each text."""
    out = np.full(len(ids) + len(at) - 1, end, np.uint32)
    count = np.diff(at)
    begin = at[:-1] + np.arange(len(at) - 1)
    out[ranges(begin, count)] = ids
    return out, np.concatenate([begin, [len(out)]])
