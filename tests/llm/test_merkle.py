"""The Merkle manifest against a plain tree in Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidelake.llm import merkle, queries
from tidelake.operators import joins

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    parts = ["-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in FIELDS]
    return sha("".join(parts))


def climb(nodes):
    """The root, and for each node its runs as (members, its place among them)."""
    ways = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        own = []
        for k, run in enumerate(runs):
            for p in range(len(run)):
                for i in under[16 * k + p]:
                    ways[i].append((run, p))
            own.append(sum(under[16 * k : 16 * k + 16], []))
        nodes, under = [sha("".join(r)) for r in runs], own
    return nodes[0], ways


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded root) of each row, tampered as the query does."""
    order = lambda v: (v is not None, v.encode() if isinstance(v, str) else v)
    sources = sorted({r["source"] for r in rows}, key=order)
    trees = []
    for source in sources:
        own = [r for r in rows if r["source"] == source]
        own.sort(key=lambda r: (order(r["doc_id"]), leaf_of(r)))
        trees.append((own, *climb([leaf_of(r) for r in own])))
    root, above = climb([subroot for _, subroot, _ in trees])
    out = []
    for (own, subroot, ways), top in zip(trees, above):
        for row, way in zip(own, ways):
            doc_id, text = row["doc_id"], row["text"]
            folded = leaf_of(row)
            if doc_id is not None and text and zlib.crc32(str(doc_id).encode()) % 5 == 0:
                lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
                folded = leaf_of({**row, "text": lowered})
            seen = ""
            for run, p in way + top:
                seen += "".join(run[:p] + run[p + 1 :])
                folded = sha("".join([*run[:p], folded, *run[p + 1 :]]))
            out.append((doc_id, leaf_of(row), subroot, root, sha(seen), folded, folded == root))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def check(spark, path, df):
    df.write.parquet(f"{path}/documents.parquet")
    found = queries.merkle_manifest(spark, path)
    assert found.columns == COLUMNS
    key = lambda r: tuple((v is not None, v) for v in r)
    got = sorted((tuple(r) for r in found.collect()), key=key)
    assert got == sorted(plain([r.asDict() for r in df.collect()]), key=key)
    return got


def sized(spark, sizes):
    """Sources of these sizes; texts of which some change when tampered with."""
    rows = [
        (i * 1000 + j, f"Text {j} Ä", "en", f"s{i}", j)
        for i, n in enumerate(sizes) for j in range(n)
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return spark.createDataFrame(rows, schema)


def test_odd_rows(spark, clashing, tmp_path):
    check(spark, str(tmp_path), clashing)


@pytest.mark.parametrize("sizes", [[1], [16], [17], [5, 1, 16, 17, 257, 300] + [2] * 14])
def test_trees_of_all_heights(spark, tmp_path, sizes):
    got = check(spark, str(tmp_path), sized(spark, sizes))
    assert len(got) < 300 or {r[-1] for r in got} == {True, False}


def test_large_trees_are_not_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins, "HOT_ROWS", 20)
    check(spark, str(tmp_path), sized(spark, [300, 1, 20]))


def test_repeated_rows_are_leaves_next_to_each_other(spark, tmp_path):
    df = sized(spark, [3]).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("n")
    assert len(check(spark, str(tmp_path), df)) == 60


def test_empty_table(spark, tmp_path, no_docs):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.merkle_manifest(spark, str(tmp_path))
    assert found.columns == COLUMNS and found.count() == 0


def test_other_columns_and_proofs(spark):
    """The operator on a table of its own: any id, any fields, carried columns."""
    df = spark.createDataFrame(
        [(f"k{i:03d}", i % 3, float(i)) for i in range(70)], "k string, part int, v double"
    )
    leaves = df.select(
        "k", F.col("part").cast("string").alias("part"),
        merkle.leaf_digest([F.col("k"), F.col("v")]).alias("d"), "v",
    )
    manifest = merkle.build_manifest(leaves, order="k", source="part", digest="d")
    rows = merkle.proofs(manifest).withColumn("up", merkle.fold(F.col("leaf"), F.col("path")))
    assert {r.up for r in rows.collect()} == {manifest.root}
    assert rows.count() == 70 and {"k", "v", "source", "subroot"} <= set(rows.columns)


def test_digest_tells_null_empty_and_moved_bounds_apart(spark):
    rows = [(None, ""), ("", None), ("a", "b1"), ("ab", "1"), (None, "-"), ("-", None)]
    df = spark.createDataFrame(rows, "a string, b string")
    found = df.select(merkle.leaf_digest([F.col("a"), F.col("b")]).alias("d")).distinct()
    assert found.count() == len(rows)
