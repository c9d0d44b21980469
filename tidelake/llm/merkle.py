"""A Merkle manifest of a dataset, with a proof for every row, by pointer jumping.

Rows become leaves: the SHA-256 of their fields, told apart by their lengths. The leaves of a source
are put in order; every 16 consecutive nodes (the last run may have fewer) become one, until one is
left, the source's subroot. Subroots, ordered by source, become the root in the same way. Digests
are lower-case hex text, and a node is the digest of its members' texts one after the other.

A run is one row that holds its up to 16 members, which all have the same way up. Every node above
the leaves starts with the run that it lies in and a pointer to that run's node. Self-joins then
append the segments of the node pointed at and take over its pointer, so the distance doubles each
time, until every pointer has passed the root. At last each run of leaves takes the segments of its
node, and each leaf leaves itself out of its run: its proof.

Sizes: a level has a sixteenth of the rows of the level below, so the segments of all nodes come to
some 400 bytes per leaf. Leaves are numbered by one range sort in which equal rows are told apart by
their place, so neither a hot source nor a repeated row lies in one task. Nodes high up, to which
very many nodes point, are few: they are broadcast if they are small, and dealt like any hot key if
not.

Nulls and edge cases: a null field counts as ``-``, other than an empty text. A null source is a
source of its own, the first one; a null id comes first in its source. Leaves with one id are ordered
by their digests; equal ones are separate leaves, next to each other. A source with one leaf has that
leaf as its subroot, one source's subroot is the root, and a dataset of one row has an empty proof.
An empty table has no root and no proofs. Texts of any length are hashed whole. Columns that are not
asked for are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidelake.lake import stage
from tidelake.operators.joins import join_dimension
from tidelake.operators.numbering import surrogate_key

#: Nodes that become one.
RUN = 16
#: Characters of a digest.
WIDTH = 64
#: The tree over the subroots, told apart from those of the sources.
TOP = -1
SEGMENTS = "array<struct<pos: int, run: string>>"


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row's fields: ``-`` for null, else the number of bytes, a colon and the text."""

    def part(field: Column) -> Column:
        text = field.cast("string")
        size = F.octet_length(text).cast("string")
        return F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-"))

    return sha256(F.concat(*[part(f) for f in fields]))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(path, leaf, lambda own, run: sha256(F.concat(_left(run), own, _right(run))))


def siblings(path: Column) -> Column:
    """The digests of a proof, level by level, left to right, as one text."""
    return F.array_join(F.transform(path, lambda run: F.concat(_left(run), _right(run))), "")


def _left(run: Column) -> Column:
    return F.substring(run["run"], F.lit(1), run["pos"] * WIDTH)


def _right(run: Column) -> Column:
    return F.substring(run["run"], run["pos"] * WIDTH + WIDTH + 1, F.lit(RUN * WIDTH))


def _key(tree: Column, level: int, place: Column) -> Column:
    """Name of a node."""
    return F.concat_ws(".", tree.cast("string"), F.lit(str(level)), place.cast("string"))


@dataclass(frozen=True)
class Manifest:
    """Root, sources, runs of leaves, and all nodes that are no leaves and not the root.

    ``nodes`` has key, up (the key of the node above), segments and low (the level of a node in its
    source's tree, null above it); ``depth`` is the longest way up from one of them.
    """

    root: str | None
    sources: DataFrame
    runs: DataFrame
    nodes: DataFrame
    depth: int


def _parents(nodes: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Runs of the nodes (tree, place, n, digest, …): tree, place, n, members, digest.

    n is the number of nodes of that tree in the level; a lone node makes a run that counts as it.
    """
    member = F.struct((F.col("place") % RUN).cast("int").alias("pos"), "digest", *carried)
    runs = nodes.groupBy("tree", F.floor(F.col("place") / RUN).alias("place")).agg(
        F.sort_array(F.collect_list(member)).alias("members"), F.first("n").alias("n")
    )
    text = F.array_join(F.transform("members", lambda m: m["digest"]), "")
    lone = F.col("n") == 1
    return runs.select(
        "tree", "place", F.ceil(F.col("n") / RUN).alias("n"), "members", lone.alias("lone"),
        text.alias("run"), F.when(lone, F.col("members")[0]["digest"]).otherwise(sha256(text)).alias("digest"),
    )


def _node_of(level: int, top: bool) -> Column:
    """Key of the node that a run of ``level`` makes."""
    if top:
        return _key(F.lit(TOP), level + 1, F.col("place"))
    own = _key(F.col("tree"), level + 1, F.col("place"))
    return F.when(F.col("n") == 1, _key(F.lit(TOP), 0, F.col("tree"))).otherwise(own)


def _rows_of(runs: DataFrame, level: int, top: bool) -> DataFrame:
    """The members of runs as nodes that start with their own run."""
    place = F.col("place") * RUN + F.col("m.pos")
    return runs.withColumn("m", F.explode("members")).select(
        _key(F.lit(TOP) if top else F.col("tree"), level, place).alias("key"),
        _node_of(level, top).alias("up"),
        F.array(F.struct(F.col("m.pos").alias("pos"), "run")).cast(SEGMENTS).alias("segments"),
        F.lit(None if top else level).cast("int").alias("low"),
    )


def _levels(nodes: DataFrame, most: int, top: bool) -> tuple[list[DataFrame], DataFrame, int]:
    """Nodes of all levels that lie in runs, the roots of the trees, and the number of levels.

    ``nodes`` has tree, place, n and digest, ``most`` is the largest n. In the trees of sources the
    first level is 1, as its nodes are runs of leaves.
    """
    rows, roots, level = [], [nodes.filter("n = 1")], 0 if top else 1
    first = level
    while most > 1:
        runs = stage(_parents(nodes.filter("n > 1")))
        rows.append(_rows_of(runs, level, top))
        nodes = runs.select("tree", "place", "n", "digest")
        roots.append(nodes.filter("n = 1"))
        most = -(-most // RUN)
        level += 1
    return rows, reduce(DataFrame.unionAll, roots), level - first


def build_manifest(
    leaves: DataFrame, order: str = "doc_id", source: str = "source", digest: str = "leaf"
) -> Manifest:
    """The trees over ``leaves``; its other columns are carried with the leaves."""
    carried = [c for c in leaves.columns if c not in (source, digest)]
    leaves = leaves.select(
        F.col(source).alias("_source"), F.col(digest).alias("digest"), *carried
    )
    numbered = surrogate_key(leaves, "_number", ["_source", order, "digest"])
    counted = numbered.groupBy("_source").agg(
        F.min("_number").alias("first"), F.count("*").alias("leaves")
    )
    sources = stage(
        surrogate_key(counted, "_rank", ["_source"], unique=True).select(
            (F.col("_rank") - 1).alias("tree"), "_source", "first", "leaves",
            _source_key().alias("_key"),
        )
    )
    n_sources, most = sources.agg(F.count("*"), F.max("leaves")).first()
    placed = join_dimension(
        numbered, sources, _source_key(), "_key",
        {"tree": "tree", "first": "_first", "leaves": "n"},
    ).select(
        "tree", (F.col("_number") - F.col("_first")).alias("place"), "n", "digest", *carried
    )
    runs = stage(_parents(placed, carried))
    above = runs.select("tree", "place", "n", "digest")
    rows, subroots, low = _levels(above, -(-(most or 0) // RUN), top=False)
    subroots = stage(subroots.select("tree", "digest"))
    sources = stage(sources.join(subroots.hint("merge"), "tree"))
    heads = sources.select(
        F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("place"),
        F.lit(n_sources).alias("n"), "digest",
    )
    more, root, high = _levels(heads, n_sources, top=True)
    found = root.first()
    empty = runs.sparkSession.createDataFrame(
        [], f"key string, up string, segments {SEGMENTS}, low int"
    )
    nodes = reduce(DataFrame.unionAll, [*rows, *more], empty)
    return Manifest(found.digest if found else None, sources, runs, nodes, low + high)


def _source_key() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("_source")), F.lit(""))


def jump(nodes: DataFrame, depth: int) -> DataFrame:
    """The nodes with all segments up to the root: the distance doubles with every self-join."""
    nodes, distance = stage(nodes), 1
    while distance < depth:
        # From the lowest nodes, those of level 1, nothing below this level can be pointed at.
        ahead = nodes.filter(F.col("low").isNull() | (F.col("low") > distance))
        joined = join_dimension(
            nodes, ahead.drop("low"), F.col("up"), "key",
            {"up": "_next", "segments": "_more"}, how="left", fact_is_table=True,
        )
        none = F.array().cast(SEGMENTS)
        nodes = stage(
            joined.select(
                "key", F.col("_next").alias("up"),
                F.concat("segments", F.coalesce("_more", none)).alias("segments"), "low",
            )
        )
        distance *= 2
    return nodes


def proofs(manifest: Manifest) -> DataFrame:
    """One row per leaf: the carried columns, source, leaf, subroot, root and path (its proof)."""
    ways = jump(manifest.nodes, manifest.depth).select(F.col("key"), "segments")
    none = F.array().cast(SEGMENTS)
    runs = manifest.runs.withColumn("key", _node_of(0, top=False)).join(
        ways.hint("merge"), "key", "left"
    )
    runs = join_dimension(
        runs.withColumn("segments", F.coalesce("segments", none)), manifest.sources,
        F.col("tree"), "tree", {"_source": "source", "digest": "subroot"},
    )
    carried = [f.name for f in manifest.runs.schema["members"].dataType.elementType][2:]
    own = F.array(F.struct(F.col("m.pos").alias("pos"), "run")).cast(SEGMENTS)
    return runs.withColumn("m", F.explode("members")).select(
        *[f"m.{c}" for c in carried], "source", F.col("m.digest").alias("leaf"), "subroot",
        F.lit(manifest.root).cast("string").alias("root"),
        F.concat(F.when(F.col("lone"), none).otherwise(own), "segments").alias("path"),
    )
