"""Jaccard self-join of documents' word n-grams by chosen paths.

A document is the set of its n-grams of words (runs of a-z, A-Z lowered, 0-9 and non-ASCII
characters; a shorter document has one gram, all its words). Documents with equal sets are one
copy class. Of each class a sketch of ``SKETCH`` minima under random orders of the grams is kept;
a minimum is a gram sampled from the set, and two sets share one with the probability of their
Jaccard similarity.

The join runs ``runs`` times. A run starts with all classes in one node. A node chooses ``FANOUT``
of the sketch's places by its own hash, and sends a class on to one child per chosen place, named
by the class's minimum there; so children hold sets which share sampled grams. A node with one
class ends. One with at most ``BUCKET`` classes, at depth ``LEAST_DEPTH`` or more, is compared pair
by pair on the sketches. Larger ones are split again until ``MOST_DEPTH``; what is then still large
holds sets alike in every sampled gram, and goes on as one group. The chance that a pair of the
threshold's similarity is lost in one run is the smallest root of s = (1 - J + J s)**FANOUT; there
are as many runs as bring it under 1 - recall.

Pairs whose sketches agree nearly enough join classes to candidate groups, and every group is then
checked exactly: all its pairs, by the whole gram sets, in one task if it is small, else in
tiles of blocks. Links are counted there, not listed; a spanning forest of them leaves each
tile, and connected components of it are the near-duplicate groups.

Nulls and edge cases: a document without words (null, empty or marks only) is in no group and has no links. Rows with
a null id take part; the class id of a group is its smallest id, null only if all are null. Rows
are told apart by their place in the files, so rows that repeat an id, or have none, are linked like
any others, and one row of each group stays. Texts are read whole, of any length. An empty table gives no rows. Other columns are not read. No pair is dropped
for the size of its group: a group of n alike sets costs n * n comparisons, spread over tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidelake.lake import stage
from tidelake.llm.common import slices, utf8, with_place

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.999
#: Columns that tell the rows apart: the place each was read from.
PLACE = ("place_file", "place_row")
SKETCH, FANOUT, LEAST_DEPTH, MOST_DEPTH, BUCKET = 64, 2, 2, 5, 256
#: Classes of a block in the exact check.
BLOCK = 512
#: Grams compared at once in the exact check, in bits.
COLUMNS = 1 << 14
SLICE_BYTES = 3_000_000
#: A pair goes to the exact check if so many standard deviations could hide the threshold.
DEVIATIONS = 4.0

_WORD_BYTES = np.array(
    [b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0
     for b in range(256)], np.uint8,
)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers without visible order."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    """1, b, b**2, … of the odd base b, modulo 2**64."""
    with np.errstate(over="ignore"):
        return np.concatenate(
            [[np.uint64(1)], np.multiply.accumulate(np.full(max(n - 1, 0), _BASE))]
        )[:n]


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def gram_sets(texts: pa.Array, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct gram hashes of the texts, one text after the other, and their offsets."""
    data, at = utf8(texts)
    rows = len(at) - 1
    kept = _WORD_BYTES[data]
    edge = np.zeros(len(kept) + 1, bool)
    edge[at] = True
    word = kept != 0
    before = np.concatenate([[False], word[:-1]])
    after = np.concatenate([word[1:], [False]])
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    with np.errstate(over="ignore"):
        # Hash of a word: its bytes as digits of a number in an odd base, shifted to its own start.
        power = _powers(len(kept))
        upto = np.concatenate(
            [[np.uint64(0)], np.cumsum((kept.astype(np.uint64) + np.uint64(1)) * power)]
        )
        inverse = np.concatenate(
            [[np.uint64(1)], np.multiply.accumulate(np.full(len(kept), _INVERSE))]
        )
        words = _mixed((upto[ends] - upto[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
        first = np.searchsorted(starts, at[:-1])
        last = np.searchsorted(starts, at[1:])
        count = last - first
        grams = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
        owner = np.repeat(np.arange(rows), grams)
        begin = np.cumsum(grams) - grams
        place = np.arange(int(grams.sum())) - begin[owner] + first[owner]
        held = np.minimum(count[owner], n)
        hashed = np.full(len(place), 0x243F6A8885A308D3, np.uint64)
        for k in range(n):
            here = k < held
            hashed[here] = _mixed(hashed[here] * _BASE + words[place[here] + k])
    order = np.lexsort((hashed, owner))
    hashed, owner = hashed[order], owner[order]
    new = np.ones(len(hashed), bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])
    hashed, owner = hashed[new], owner[new]
    return hashed, np.searchsorted(owner, np.arange(rows + 1))


def _set_keys(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """16 bytes that name each set: two sums of mixed hashes."""
    with np.errstate(over="ignore"):
        parts = []
        for salt in (1, 2):
            mixed = _mixed(grams ^ _mixed(np.full(1, salt, np.uint64)))
            upto = np.concatenate([[np.uint64(0)], np.cumsum(mixed)])
            parts.append(upto[at[1:]] - upto[at[:-1]] + np.diff(at).astype(np.uint64))
    return np.stack(parts, axis=1).astype("<u8")


def sketches(grams: np.ndarray, at: np.ndarray, size: int = SKETCH) -> np.ndarray:
    """Minima of each set that has grams, under ``size`` orders, as 32-bit numbers."""
    full = np.flatnonzero(np.diff(at))
    out = np.zeros((len(at) - 1, size), np.uint32)
    if not len(full):
        return out
    factors = _mixed(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    with np.errstate(over="ignore"):
        for i, factor in enumerate(factors):
            order = (grams * factor) >> np.uint64(32)
            out[full, i] = np.minimum.reduceat(order, at[full])
    return out


def loss_of_run(similarity: float, fanout: int = FANOUT) -> float:
    """Chance that a pair of this similarity never meets in the leaves of one run."""
    lost = 0.0
    for _ in range(1000):
        lost = (1 - similarity + similarity * lost) ** fanout
    return lost


def runs_for(recall: float, similarity: float, fanout: int = FANOUT) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(loss_of_run(similarity, fanout))))


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, node, sketch) to (class, child) for the places that the node chooses."""
    for batch in batches:
        node = batch.column("node").to_numpy().view(np.uint64)
        rows = len(node)
        if not rows:
            continue
        sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), "<u4").reshape(rows, -1)
        children = []
        with np.errstate(over="ignore"):
            chosen = np.zeros((FANOUT, rows), np.int64)
            for k in range(FANOUT):
                # Different places: each choice skips the ones before.
                place = (_mixed(node + np.uint64(k + 1)) % np.uint64(SKETCH - k)).astype(np.int64)
                for earlier in np.sort(chosen[:k], axis=0):
                    place += place >= earlier
                chosen[k] = place
                held = sketch[np.arange(rows), place].astype(np.uint64)
                children.append(_mixed((node ^ _mixed(place.astype(np.uint64))) * _BASE + held))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(children).view(np.int64)),
                pa.concat_arrays([batch.column("class").cast(pa.binary())] * FANOUT),
            ],
            ["node", "class"],
        )


def _roots(parent: np.ndarray, links: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Component of each item, named by its smallest item."""
    for a, b in links:
        while True:
            low = np.minimum(parent[a], parent[b])
            before = parent.copy()
            np.minimum.at(parent, parent[a], low)
            np.minimum.at(parent, parent[b], low)
            parent = parent[parent]
            if (parent == before).all():
                break
    while (parent != parent[parent]).any():
        parent = parent[parent]
    return parent


def _alike(sketch: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for i in range(len(sketch) - 1):
        near = np.flatnonzero((sketch[i + 1 :] == sketch[i]).sum(axis=1) >= least)
        if len(near):
            yield np.full(len(near), i), near + i + 1


def least_agreement(threshold: float) -> int:
    """Places in which sketches of two sets as similar as that surely enough agree."""
    spread = math.sqrt(threshold * (1 - threshold) * SKETCH)
    return max(1, math.floor(threshold * SKETCH - DEVIATIONS * spread))


def _compare_buckets(threshold: float):
    """Rows (node, class, sketch) of small nodes, sorted by node, to edges of candidate groups."""
    least = least_agreement(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, classes, held = None, [], []
        found: list[tuple[bytes, bytes]] = []

        def close() -> None:
            if len(classes) < 2:
                return
            sketch = np.frombuffer(b"".join(held), "<u4").reshape(len(held), -1)
            root = _roots(np.arange(len(classes)), list(_alike(sketch, least)))
            found.extend((classes[r], classes[i]) for i, r in enumerate(root) if r != i)

        def batch() -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [[], []]
            found.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary()) for c in columns], ["a", "b"]
            )

        for rows in batches:
            for node, own, sketch in zip(
                *(rows.column(c).to_pylist() for c in ("node", "class", "sketch")), strict=True
            ):
                if node != group:
                    close()
                    group, classes, held = node, [], []
                classes.append(own)
                held.append(sketch)
            yield batch()
        close()
        yield batch()

    return run


def _cell_links(
    grams: np.ndarray, at: np.ndarray, split: int, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), i < j, with at least the threshold. With ``split`` only i < split <= j."""
    n, size = len(at) - 1, np.diff(at)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(grams, kind="stable")
    values, owner = grams[order], owner[order]
    change = np.concatenate([[True], values[1:] != values[:-1]])
    column = np.cumsum(change) - 1
    shared = np.bincount(column) > 1  # a gram of one set links nothing
    column = (np.cumsum(shared) - 1)[column[shared[column]]]
    owner = owner[shared[np.cumsum(change) - 1]]
    common = np.zeros((split or n, n), np.int32)
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        own = slice(*np.searchsorted(column, [begin, begin + COLUMNS]))
        width = min(COLUMNS, int(column[-1]) + 1 - begin)
        bits = np.zeros((n, -(-width // 64) * 64), bool)
        bits[owner[own], column[own] - begin] = True
        words = np.packbits(bits, axis=1).view(np.uint64)
        for i in range(len(common)):
            after = split or i + 1
            common[i, after:] += np.bitwise_count(words[after:] & words[i]).sum(axis=1, dtype=np.int32)
    i, j = np.nonzero(common)
    both = common[i, j]
    # Jaccard >= threshold without a division.
    near = both >= threshold * (size[i] + size[j] - both) - 1e-9
    return i[near], j[near]


def _check_cells(threshold: float, n: int):
    """Rows (cell, group, left, right, class, copies, doc_id, text) sorted by cell, to edges and
    counts: (a, b, null) for a spanning forest, (a, null, links) for the links of a class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, {}
        found: list[tuple] = []

        def close() -> None:
            if len(held) < 2:
                return
            # In a tile of two blocks those of the left block come first.
            classes = sorted(held, key=lambda c: (held[c][1], c))
            left = sum(held[c][1] == 0 for c in classes)
            split = left if left < len(classes) else 0
            if not split and held[classes[0]][1]:
                return
            at = np.concatenate([[0], np.cumsum([len(held[c][2]) for c in classes])])
            grams = np.concatenate([held[c][2] for c in classes])
            i, j = _cell_links(grams, at, split, threshold)
            copies = np.array([held[c][0] for c in classes], np.int64)
            links = np.bincount(i, copies[j], len(classes)) + np.bincount(j, copies[i], len(classes))
            root = _roots(np.arange(len(classes)), [(i, j)])
            for k, own in enumerate(classes):
                if root[k] != k:
                    found.append((classes[root[k]], own, None))
                if links[k]:
                    found.append((own, None, int(links[k])))

        def batch() -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [[], [], []]
            found.clear()
            kinds = (pa.binary(), pa.binary(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["a", "b", "links"]
            )

        for rows in slices(batches, "text", SLICE_BYTES):
            grams, at = gram_sets(rows.column("text"), n)
            keys = _set_keys(grams, at)
            for k, (place, own, copies, side) in enumerate(
                zip(*(rows.column(c).to_pylist() for c in ("cell", "class", "copies", "side")))
            ):
                if place != cell:
                    close()
                    cell, held = place, {}
                # A row that shares the id of the class's document but has another text is not it.
                if keys[k].tobytes() == own:
                    held[own] = (copies, side, grams[at[k] : at[k + 1]])
            yield batch()
        close()
        yield batch()

    return run


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that each node is connected to, by the edges (a, b).

    Each round every node takes the smallest root among its neighbours and then the root of its
    root; rounds grow with the logarithm of the longest way.
    """
    both = stage(
        edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .filter("a <> b").distinct()
    )
    roots = stage(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")))
    while True:
        near = both.join(roots.withColumnsRenamed({"node": "b"}), "b").groupBy(
            F.col("a").alias("node")
        ).agg(F.min("root").alias("near"))
        pulled = roots.join(near, "node").select(
            "node", "root", F.least("root", "near").alias("low")
        )
        # The root of the old root may have learnt of a smaller one, too.
        hooks = pulled.filter("low < root").groupBy(F.col("root").alias("node")).agg(
            F.min("low").alias("hook")
        )
        hooked = stage(
            pulled.join(hooks, "node", "left").select(
                "node", F.col("root").alias("old"), F.least("low", "hook").alias("root")
            )
        )
        jumped = hooked.alias("h").join(
            hooked.select(F.col("node").alias("at"), F.col("root").alias("above")).alias("j"),
            F.expr("h.root = j.at"),
        ).select("h.node", "h.old", F.least("h.root", "j.above").alias("root"))
        jumped = stage(jumped)
        roots = jumped.select("node", "root")
        if jumped.filter("root <> old").isEmpty():
            return roots


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS,
    threshold: float = THRESHOLD, recall: float = RECALL, is_scan: bool = False,
) -> DataFrame:
    """One row per row of ``df``: doc_id, class_id, links, copies, n_grams, stays.

    ``copies`` are the rows with the same set of grams, ``links`` the other rows with a similarity
    of ``threshold`` or more, ``class_id`` the smallest id of the connected rows. ``stays`` is true
    for one row with that id, and for rows without any words. ``is_scan`` is that of
    ``with_place``.
    """
    placed, place = with_place(df, is_scan)
    return _near_duplicates(placed, place, id_col, text_col, n, threshold, recall).drop(*PLACE)


def _near_duplicates(
    placed: DataFrame, place: list[str], id_col: str = "doc_id", text_col: str = "text",
    n: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL,
) -> DataFrame:
    """The same with each row's ``PLACE``, by which rows are told apart and texts are found."""
    given = placed.select(
        *[F.col(own).alias(c) for own, c in zip(place, PLACE, strict=True)],
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"),
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            grams, at = gram_sets(batch.column("text"), n)
            size = np.diff(at)
            none = pa.array(size == 0)
            keys = _set_keys(grams, at)
            minima = sketches(grams, at).astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in (*PLACE, "doc_id")), pa.array(size.astype(np.int64)),
                    pa.array([k.tobytes() if s else None for k, s in zip(keys, size)], pa.binary()),
                    pa.array([m.tobytes() if s else None for m, s in zip(minima, size)], pa.binary()),
                ],
                [*PLACE, "doc_id", "n_grams", "class", "sketch"],
            )

    kinds = ", ".join(f"{c} bigint" for c in (*PLACE, "doc_id", "n_grams"))
    rows = stage(given.mapInArrow(sketch, f"{kinds}, class binary, sketch binary"))
    # The row that stands for others has the smallest id; null ids come last, places break ties.
    head = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *PLACE)
    classes = stage(
        rows.filter("class IS NOT NULL").groupBy("class").agg(
            F.min(head).alias("head"), F.count("*").alias("copies"),
            F.first("sketch").alias("sketch"),
        )
    )
    candidates = candidate_edges(classes.select("class", "sketch"), threshold, recall)
    groups = components(candidates)
    checked = stage(check_groups(groups, classes, given, threshold, n))
    links = checked.filter("links IS NOT NULL").groupBy(F.col("a").alias("class")).agg(
        F.sum("links").alias("links")
    )
    roots = components(checked.filter("b IS NOT NULL").select("a", "b"))
    named = roots.join(
        classes.select(F.col("class").alias("node"), "head"), "node"
    ).groupBy("root").agg(F.min("head").alias("first"))
    found = roots.join(named, "root").select(F.col("node").alias("class"), "first")
    # Written, so that the join with the rows can split a class of very many copies.
    known = classes.select("class", "copies", "head").join(found, "class", "left").join(
        links, "class", "left"
    ).select(
        "class", "copies", F.coalesce("first", "head").alias("first"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
    )
    known = stage(known)
    stays = F.lit(True)
    for c in PLACE:
        stays &= F.col(c) == F.col(f"first.{c}")
    worded = rows.filter("class IS NOT NULL").select(*PLACE, "doc_id", "n_grams", "class").join(
        known, "class"
    ).select(
        *PLACE, "doc_id", F.col("first.doc_id").alias("class_id"), "links", "copies", "n_grams",
        stays.alias("stays"),
    )
    silent = rows.filter("class IS NULL").select(
        *PLACE, "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("links"),
        F.lit(1).cast("bigint").alias("copies"), "n_grams", F.lit(True).alias("stays"),
    )
    return worded.unionAll(silent)


def candidate_edges(classes: DataFrame, threshold: float, recall: float) -> DataFrame:
    """Edges (a, b) that join classes which meet in a leaf and have sketches alike."""
    runs = runs_for(recall, threshold)
    starts = F.explode(F.array(*[F.lit(r * 0x1F123BB5).cast("bigint") for r in range(1, runs + 1)]))
    nodes = classes.withColumn("node", starts)
    edges: list[DataFrame] = []
    for depth in range(1, MOST_DEPTH + 1):
        split = stage(
            nodes.select("node", "class", "sketch")
            .mapInArrow(_children, "node bigint, class binary")
            # Two choices of one node may meet in one child; a class counts once.
        )
        sizes = split.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1")
        held = split.join(sizes, "node")
        if depth < LEAST_DEPTH:
            nodes = held.select("node", "class").join(classes, "class")
            continue
        held = stage(held)
        small = held.filter(F.col("n") <= BUCKET).select("node", "class").join(classes, "class")
        edges.append(
            small.repartition("node").sortWithinPartitions("node", "class")
            .mapInArrow(_compare_buckets(threshold), "a binary, b binary")
        )
        large = held.filter(F.col("n") > BUCKET)
        if large.isEmpty():
            break
        if depth == MOST_DEPTH:
            heads = large.groupBy("node").agg(F.min("class").alias("a"))
            edges.append(
                large.join(heads, "node").select("a", F.col("class").alias("b")).filter("a <> b")
            )
        nodes = large.select("node", "class").join(classes, "class")
    result = edges[0]
    for frame in edges[1:]:
        result = result.unionAll(frame)
    return stage(result.distinct())


def check_groups(
    groups: DataFrame, classes: DataFrame, given: DataFrame, threshold: float, n: int
) -> DataFrame:
    """Exact links within the groups (node, root): see ``_check_cells``.

    A group of at most ``BLOCK`` classes is one cell. A larger one is dealt into blocks, and every
    two blocks are a cell, so its classes are sent once per block.
    """
    sizes = groups.groupBy("root").agg(F.count("*").alias("n"))
    sized = groups.join(sizes, "root").withColumn(
        "blocks", F.ceil(F.col("n") / BLOCK).cast("int")
    ).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    own, other = F.col("block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = sized.select("root", F.col("node").alias("class"), "block", other.alias("other")).select(
        "class",
        F.concat("root", F.encode(F.concat_ws(
            " ", F.least("block", "other"), F.greatest("block", "other")
        ), "UTF-8")).alias("cell"),
        (own > F.col("other")).cast("int").alias("side"),
    )
    known = cells.join(
        classes.select("class", "copies", *[F.col(f"head.{c}").alias(c) for c in PLACE]), "class"
    )
    # Only the checked documents' texts go on; the places are few beside them.
    full = known.join(given.select(*PLACE, "text"), list(PLACE))
    return (
        full.select("cell", "class", "copies", "side", "text")
        .repartition("cell").sortWithinPartitions("cell")
        .mapInArrow(_check_cells(threshold, n), "a binary, b binary, links bigint")
    )


def one_of_each(df: DataFrame, is_scan: bool = False) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns: one row of each group.

    Rows are told apart by their place, so it does not matter whether ids are null or repeat.
    """
    placed, place = with_place(df, is_scan)
    staying = _near_duplicates(placed, place).filter("stays").select(
        *[F.col(c).alias(own) for c, own in zip(PLACE, place, strict=True)]
    )
    return placed.join(staying, place).select(*[f"`{c}`" for c in df.columns])
