"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search finds the segmentation of a text into pieces with the largest sum of piece scores. It
reads the text once and keeps a window no longer than the longest piece: the best score of each
boundary in the window and a pointer back. Whenever the ways back from all boundaries of the window
meet in one boundary, what lies before it is decided, and its ids are given out.

The ways surely meet wherever no piece of the vocabulary spans two neighbouring characters. Texts
are cut there (in practice around words), and each distinct cut of a slice is searched once. The
search is there in two forms, with the same window and the same rule for what is decided: ``Lanes``
reads one character of many cuts at a time, ``Stream`` reads one cut that comes in parts, which is
the faster way for the longest few, where hardly any other cut is left to go along.

A file of pieces found by merging stores no probabilities but ranks. By Zipf's law the log
probability of the piece of rank r is near -log(r), and that is the score used here, in whole
millionths so that sums are exact. Equal sums prefer the longer last piece. A character without a
piece becomes its UTF-8 bytes.

Texts are encoded as they are: one space goes in front, spaces become the space mark, nothing else
is changed; a space mark that stands in the text is encoded as bytes. So decoding returns the text.

Nulls and edge cases: a null text counts as empty; an empty text has no ids. A null id is carried
through, repeated rows are encoded each for itself. Texts of any length are encoded whole. Columns
other than the id and the text are not read.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidelake.llm.common import ranges, slices, text_array, utf8

MARK = "▁"
#: Stands for a space mark of the text itself in a search: a surrogate, which no text can hold. It
#: is in no piece, and its bytes are those of the space mark.
OWN_MARK = "\ud800"
#: Cuts searched together.
LANES = 1 << 14
#: So many of the longest cuts of a slice are searched one by one.
ALONE = 64
SLICE_BYTES = 3_000_000
#: Score of a byte, in millionths; lower than that of any piece.
BYTE_SCORE = -20_000_000
#: Score of a boundary that no piece has reached yet.
LOWEST = np.iinfo(np.int64).min // 2


class Model:
    """Pieces of a model file, with ids, scores and the bytes they decode to."""

    def __init__(self, path: str):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = processor.get_piece_size()
        self.pieces: dict[str, tuple[int, int]] = {}  # piece -> (id, score)
        self.byte_ids = np.zeros(256, np.int32)
        self.decoded = [b""] * self.size
        ranks = []
        for i in range(self.size):
            piece = processor.id_to_piece(i)
            if processor.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.decoded[i] = bytes([int(piece[3:5], 16)])
            elif not (processor.is_control(i) or processor.is_unknown(i)):
                ranks.append((-processor.get_score(i), i, piece))
                self.decoded[i] = piece.replace(MARK, " ").encode()
        for rank, (_, i, piece) in enumerate(sorted(ranks)):
            self.pieces[piece] = (i, -round(1e6 * math.log(rank + 2)))
        self.longest = max(map(len, self.pieces))
        lengths: dict[str, set[int]] = {}
        for piece in self.pieces:
            lengths.setdefault(piece[-1], set()).add(len(piece))
        # Lengths of the pieces that end with a character, the longest first.
        self.lengths = {c: sorted(own, reverse=True) for c, own in lengths.items()}
        self._trie()
        self._joined()
        self.width = np.array([len(d) for d in self.decoded], np.int64)
        self.pool = np.frombuffer(b"".join(self.decoded), np.uint8)
        self.begin = np.cumsum(self.width) - self.width

    @classmethod
    def of(cls, state: dict) -> Model:
        """The model whose attributes these are."""
        model = cls.__new__(cls)
        model.__dict__.update(state)
        return model

    def _trie(self) -> None:
        """A trie of all pieces in two flat tables.

        The step from a node by a letter is at ``base[node] + letter``, if ``check`` there is the
        node. Letters are the characters that occur in pieces, from 1; others are 0 and match none.
        """
        letters = sorted({c for p in self.pieces for c in p})
        self.letters = np.zeros(0x110000, np.int32)
        self.letters[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        children: list[dict[int, int]] = [{}]
        accepts: list[tuple[int, int] | None] = [None]
        for piece, value in self.pieces.items():
            node = 0
            for c in piece:
                letter = int(self.letters[ord(c)])
                if letter not in children[node]:
                    children[node][letter] = len(children)
                    children.append({})
                    accepts.append(None)
                node = children[node][letter]
            accepts[node] = value
        # Every node gets the lowest base at which its letters' places are free. A node without
        # children needs none. The root comes first.
        width = len(letters) + 1
        size = 8 * len(children) + 4 * width
        free = np.ones(size, bool)
        place = np.zeros(len(children), np.int64)
        self.base = np.full(size, -1, np.int64)
        self.check = np.full(size, -1, np.int64)
        self.accept = np.full(size, -1, np.int32)
        self.score = np.zeros(size, np.int64)
        free[0], lowest = False, 1
        waiting = [0]
        for node in waiting:  # grows: level by level
            own = np.array(sorted(children[node]), np.int64)
            if not len(own):
                continue
            while not free[lowest]:
                lowest += 1
            base = max(lowest - int(own[0]), 0)
            while not free[base + own].all():
                base += 1
            at = place[node]
            self.base[at] = base
            for letter in own.tolist():
                child = children[node][letter]
                place[child] = base + letter
                free[base + letter] = False
                self.check[base + letter] = at
                if accepts[child]:
                    self.accept[base + letter], self.score[base + letter] = accepts[child]
                waiting.append(child)
        # A node without children must not step anywhere: its base leads to a place never taken.
        self.base[self.base < 0] = size - width
        self.root = 0

    def _joined(self) -> None:
        """Pairs of neighbouring bytes that some piece spans; any with a byte from 128 on."""
        self.joined = np.zeros((256, 256), bool)
        self.joined[128:, :] = self.joined[:, 128:] = True
        spaced = any(MARK in p[1:].lstrip(MARK) for p in self.pieces)
        for piece in self.pieces:
            text = piece.replace(MARK, " ")
            for a, b in zip(text[:-1], text[1:]):
                if ord(a) < 128 and ord(b) < 128:
                    self.joined[ord(a), ord(b)] = True
        if not spaced:
            # No piece has a character before a space mark, be it ASCII or not.
            self.joined[128:, 32] = False
            self.joined[[i for i in range(128) if i != 32], 32] = False

    def bytes_of(self, character: str) -> list[int]:
        return self.byte_ids[list(_octets(character))].tolist()


def _octets(character: str) -> bytes:
    return (MARK if character == OWN_MARK else character).encode()


class Stream:
    """A search over a text that comes in parts; ids are given out as they are decided.

    Scores are kept of the last ``longest + 1`` boundaries only. Whether the ways back from them
    share a boundary is looked for when so many characters are undecided, and again each time as
    many again have come, so the time is in proportion to the text also where nothing is decided
    for long, as in a run of one sign. What waits there is one pointer for each character.
    """

    def __init__(self, model: Model):
        self.model = model
        self.text = ""  # characters after the last decided boundary
        self.best = [0] * (model.longest + 1)  # a ring: of boundary b at b % (longest + 1)
        self.back = array("q", [0])  # begin of the last piece before each boundary
        self.piece = array("i", [-1])  # and its id; -1: bytes
        self.again = 2 * model.longest  # undecided characters at which to look again
        self.window = 0  # most characters that were ever undecided

    def push(self, text: str) -> list[int]:
        """Read more of the text, where spaces are space marks already and its own are OWN_MARK."""
        out: list[int] = []
        begin = 0
        while begin < len(text):
            step = max(self.model.longest, len(self.text))
            self._push(text[begin : begin + step])
            begin += step
            if len(self.text) >= self.again:
                out += self._commit()
        return out

    def _push(self, text: str) -> None:
        pieces, lengths, best = self.model.pieces, self.model.lengths, self.best
        ring, first = self.model.longest + 1, len(self.text) + 1
        self.text = whole = self.text + text
        for end in range(first, len(whole) + 1):
            sign = whole[end - 1]
            value = best[(end - 1) % ring] + BYTE_SCORE * len(_octets(sign))
            begin_of, id_of = end - 1, -1
            # A piece wins over bytes, the longer piece over the shorter.
            for length in lengths.get(sign, ()):
                begin = end - length
                piece = pieces.get(whole[begin:end]) if begin >= 0 else None
                if piece:
                    score = best[begin % ring] + piece[1]
                    if score > value or (score == value and id_of < 0):
                        value, begin_of, id_of = score, begin, piece[0]
            best[end % ring] = value
            self.back.append(begin_of)
            self.piece.append(id_of)
        self.window = max(self.window, len(whole))

    def _commit(self) -> list[int]:
        """Decide up to the last boundary that the ways back from the whole window share."""
        longest, end = self.model.longest, len(self.text)
        ways = bytearray(end + 1)
        ways[end - longest + 1 :] = b"\1" * longest
        left, at = longest, end
        while left > 1:  # the farthest boundary goes one piece back
            if ways[at]:
                begin = self.back[at]
                left -= ways[begin]
                ways[begin] = 1
            at -= 1
        shared = ways.rindex(1, 0, at + 1)
        if shared:
            out = self._ids(shared)
            ring = longest + 1
            kept = {b: self.best[b % ring] for b in range(max(shared, end - longest), end + 1)}
            for b, value in kept.items():
                self.best[(b - shared) % ring] = value
            self.text = self.text[shared:]
            self.back = array("q", [0, *(b - shared for b in self.back[shared + 1 :])])
            self.piece = array("i", [-1, *self.piece[shared + 1 :]])
        else:
            out = []
        self.again = max(2 * longest, 2 * len(self.text))
        return out

    def _ids(self, end: int) -> list[int]:
        found: list[list[int]] = []
        while end:
            begin, piece = self.back[end], self.piece[end]
            found.append([piece] if piece >= 0 else self.model.bytes_of(self.text[begin:end]))
            end = begin
        return [i for ids in reversed(found) for i in ids]

    def finish(self) -> list[int]:
        out = self._ids(len(self.text))
        self.__init__(self.model)
        return out


class Lanes:
    """The search over many texts of code points at once: a step reads one more character of each.

    A piece is met at its begin, so the ring holds the boundary of the step and, as far as pieces
    that have begun reach, those ahead of it. The ways of these boundaries are looked back on when
    ``longest`` more characters have come, later where nothing is decided for long; what they share
    is given out, and the pointers before it are dropped.
    """

    def __init__(self, model: Model, text: np.ndarray, at: np.ndarray):
        self.model, self.text = model, text
        self.letters = model.letters[text]
        self.octets = 1 + (text >= 0x80).astype(np.int64) + (text >= 0x800) + (text >= 0x10000)
        length = np.diff(at)
        self.lanes = np.argsort(-length, kind="stable")  # long ones first: the live are a prefix
        self.length, self.first = length[self.lanes], at[:-1][self.lanes]
        self.end = int(length.max())
        # How many texts have so many characters.
        self.live = np.searchsorted(-self.length, -np.arange(self.end + 2), side="right")
        n, ring = len(length), model.longest + 1
        self.best = np.full((ring, n), LOWEST, np.int64)  # of boundary b at b % (longest + 1)
        self.best[0] = 0
        self.begin = np.zeros((ring, n), np.int32)  # begin of the last piece before it
        self.piece = np.zeros((ring, n), np.int32)  # and its id; of bytes: -1 - code point
        self.base = 0  # the first boundary that a live text has not left behind
        self.done = np.zeros(n, np.int64)  # the last decided boundary of each text
        self.again = min(model.longest, self.end)  # boundary at which to look back
        self.begins = np.zeros((self.again, n), np.int32)  # of the boundaries after ``base``
        self.pieces = np.zeros((self.again, n), np.int32)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # text, end, id
        self.window = 0  # most boundaries that were ever undecided

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, one after the other, and the number for each.

        Bytes of a character have ids below zero, -1 - code point, here.
        """
        for t in range(self.end):
            self._step(t)
            if t + 1 == self.again:
                self._decide(t + 1)
        owner, end, ids = (np.concatenate(c) for c in zip(*self.found, strict=True))
        return ids[np.lexsort((end, owner))], np.bincount(owner, minlength=len(self.lanes))

    def _step(self, t: int) -> None:
        """All pieces that begin at boundary t. After that, the next boundary's way is known."""
        model, ring, now = self.model, self.model.longest + 1, self.live[t + 1]
        here, to = self.best[t % ring], (t + 1) % ring
        place = self.first[:now] + t
        value = here[:now] + BYTE_SCORE * self.octets[place]
        better = np.flatnonzero(value > self.best[to, :now])
        self.best[to, better] = value[better]
        self.begin[to, better] = t
        self.piece[to, better] = -1 - self.text[place[better]]
        lane, node = np.arange(now), np.zeros(now, np.int64)
        for last in range(t, min(t + model.longest, self.end)):
            if last > t:
                keep = lane < self.live[last + 1]
                lane, node = lane[keep], node[keep]
            at = model.base[node] + self.letters[self.first[lane] + last]
            keep = model.check[at] == node
            if not keep.all():
                lane, at = lane[keep], at[keep]
            if not len(lane):
                break
            node = at
            hit = model.accept[at] >= 0
            own, at = lane[hit], at[hit]
            value = here[own] + model.score[at]
            # Longer pieces come first; only a better one, or any against bytes, replaces.
            slot = (last + 1) % ring
            held = self.best[slot, own]
            wins = (value > held) | ((value == held) & (self.piece[slot, own] < 0))
            own, at = own[wins], at[wins]
            self.best[slot, own] = value[wins]
            self.begin[slot, own] = t
            self.piece[slot, own] = model.accept[at]
        here[:now] = LOWEST  # the place of boundary t + ring
        self.begins[t - self.base, :now] = self.begin[to, :now]
        self.pieces[t - self.base, :now] = self.piece[to, :now]

    def _decide(self, end: int) -> None:
        """Give out texts that end here or before, and what is decided of the others."""
        base, n = self.base, self.live[end + 1]
        shared = self._shared(end, n)
        self.window = max(self.window, end - base)
        place = np.concatenate([shared, self.length[n : len(self.done)]])
        lane = np.flatnonzero(place > self.done)
        while len(lane):
            row = place[lane] - 1 - base
            self.found.append((self.lanes[lane], place[lane], self.pieces[row, lane]))
            place[lane] = self.begins[row, lane]
            lane = lane[place[lane] > self.done[lane]]
        self.done, self.base = shared, int(shared.min()) if n else end
        wait = end - self.base
        self.again = min(end + max(self.model.longest, wait), self.end)
        kept = slice(self.base - base, end - base)
        for name in ("begins", "pieces"):
            rows = np.zeros((self.again - self.base, n), np.int32)
            rows[:wait] = getattr(self, name)[kept, :n]
            setattr(self, name, rows)

    def _shared(self, end: int, n: int) -> np.ndarray:
        """The last boundary of each of the first n texts that all its ways back share.

        Every way on goes through this boundary, or by a piece that has begun before it.
        """
        base, ring = self.base, self.model.longest + 1
        ways = np.zeros((end - base + 1, n), bool)
        if not n:
            return np.zeros(0, np.int64)
        ways[-1] = True
        for ahead in range(end + 1, end + ring - 1):
            own = np.flatnonzero(self.best[ahead % ring, :n] > LOWEST)
            ways[self.begin[ahead % ring, own] - base, own] = True
        left = ways.sum(axis=0)
        for at in range(end - base, 0, -1):  # the farthest boundary goes one piece back
            own = np.flatnonzero(ways[at] & (left > 1))
            to = self.begins[at - 1, own] - base
            ways[at, own] = False
            left[own] -= ways[to, own]
            ways[to, own] = True
        return base + ways.argmax(axis=0)


def _with_bytes(model: Model, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace -1 - code point by the ids of the character's bytes."""
    odd = np.flatnonzero(ids < 0)
    if not len(odd):
        return ids, count
    raw = [model.bytes_of(chr(-1 - int(i))) for i in ids[odd]]
    width = np.ones(len(ids), np.int64)
    width[odd] = [len(r) for r in raw]
    out = np.repeat(ids, width)
    begin = np.cumsum(width) - width
    out[ranges(begin[odd], width[odd])] = np.concatenate(raw)
    owner = np.repeat(np.arange(len(count)), count)
    return out, np.bincount(owner, weights=width, minlength=len(count)).astype(np.int64)


def search(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many texts, one text after the other, and the number for each."""
    data, at = utf8(texts)
    heads = (data & 0xC0) != 0x80  # bytes that begin a character
    upto = np.concatenate([[0], np.cumsum(heads)])
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int32)
    at = upto[at]
    # A space mark of the text has no piece of its own; a space is the space mark.
    own_mark = points == ord(MARK)
    points = np.where(points == 32, ord(MARK), points)
    points[own_mark] = ord(OWN_MARK)
    length = np.diff(at)
    count = np.zeros(len(length), np.int64)
    order, ids = [], []
    by_length = np.argsort(length, kind="stable")
    by_length = by_length[length[by_length] > 0]
    many = max(0, len(by_length) - ALONE)
    for i in range(0, many, LANES):
        lanes = by_length[i : min(i + LANES, many)]
        lane_at = np.concatenate([[0], np.cumsum(length[lanes])])
        found, n = Lanes(model, points[ranges(at[lanes], length[lanes])], lane_at).run()
        found, n = _with_bytes(model, found, n)
        count[lanes] = n
        order.append(lanes)
        ids.append(found)
    for i in by_length[many:].tolist():
        stream = Stream(model)
        text = points[at[i] : at[i + 1]].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        found = stream.push(text) + stream.finish()
        count[i] = len(found)
        order.append(np.array([i]))
        ids.append(np.array(found, np.int32))
    if not order:
        return np.zeros(0, np.int32), count
    order, flat = np.concatenate(order), np.concatenate(ids)
    begin = np.zeros(len(count), np.int64)
    begin[order] = np.cumsum(count[order]) - count[order]
    return flat[ranges(begin, count)], count


def encode(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts and each text's offset in them."""
    data, at = utf8(texts)
    full = np.diff(at) > 0
    # One space in front of every text that is not empty.
    lead = at + np.concatenate([[0], np.cumsum(full)])
    spaced = np.full(int(lead[-1]), 32, np.uint8)
    spaced[ranges(lead[:-1] + full, np.diff(at))] = data
    cut = np.zeros(len(spaced) + 1, bool)
    step = 1 << 18  # the index arrays of one step are small
    for i in range(0, len(spaced) - 1, step):
        own = spaced[i : i + step + 1]
        cut[i + 1 : i + len(own)] = ~model.joined[own[:-1], own[1:]]
    cut[lead] = True
    bounds = np.flatnonzero(cut)
    if len(bounds) < 2:
        return np.zeros(0, np.int32), np.zeros(len(at), np.int64)
    chunks = text_array(spaced, bounds).dictionary_encode()
    pool, count = search(model, chunks.dictionary)
    codes = chunks.indices.to_numpy()
    begin = np.cumsum(count) - count
    own = count[codes]
    upto = np.concatenate([[0], np.cumsum(own)])
    return pool[ranges(begin[codes], own)], upto[np.searchsorted(bounds, lead)]


def decode(model: Model, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts that the ids stand for, and each text's offset in them."""
    width = model.width[ids]
    data = model.pool[ranges(model.begin[ids], width)]
    upto = np.concatenate([[0], np.cumsum(width)])[at]
    keep = np.ones(len(data), bool)
    full = np.diff(upto) > 0
    keep[upto[:-1][full]] = False  # the space in front
    return data[keep], upto - np.concatenate([[0], np.cumsum(full)])


RESULT = "n_tokens bigint, ids_crc32 bigint, round_trip boolean, ids array<int>"


@lru_cache(maxsize=4)
def load_model(path: str) -> Model:
    return Model(path)


def encode_texts(
    df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: the id, n_tokens, ids_crc32, round_trip, ids.

    ``model`` is the path of a model file, read by the driver; the pieces, whose number is fixed,
    are broadcast.

    ``ids_crc32`` is the checksum of the ids as little-endian unsigned 32-bit numbers.
    ``round_trip`` says whether decoding the ids gave the text, byte by byte. No shuffle.
    """
    chosen = df.select(id_col, F.col(text_col).alias("_text"))
    kind = chosen.schema[id_col].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(vars(load_model(model)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Model.of(shared.value)
        for batch in slices(batches, "_text", SLICE_BYTES):
            texts = batch.column(1)
            ids, at = encode(pieces, texts)
            given, given_at = utf8(texts)
            data, data_at = decode(pieces, ids, at)
            same = np.diff(given_at) == np.diff(data_at)
            if same.all():
                differ = np.concatenate([[0], np.cumsum(given != data)])
                same = differ[given_at[1:]] == differ[given_at[:-1]]
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(np.diff(at)), pa.array(crc, pa.int64()),
                    pa.array(same), pa.ListArray.from_arrays(at.astype(np.int32), ids),
                ],
                [id_col, "n_tokens", "ids_crc32", "round_trip", "ids"],
            )

    return chosen.mapInArrow(run, f"`{id_col}` {kind}, {RESULT}")
