"""Languages, mixing, search, near and exact copies, chats, and the pipeline."""

import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_texts import best_ids

import corpus_pipeline
from check import compare
from tidelake.lake import scratch_path
from tidelake.llm import langid, mixing, pieces, setjoin
from tidelake.llm.chat import CONTROLS, escape, format_chats, linear_replies, read_chats, unescape
from tidelake.llm.digests import DigestIndex, mark_copies, without_copies
from tidelake.llm.queries import ORACLES, QUERIES, tokenizer_file
from tidelake.llm.topk import exact_top_k

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    import glob
    import os

    import duckdb

    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path)[:-8]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, con, name):
    ok, _, note = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert ok, note


# Languages


def test_op2_held_out_accuracy(spark, docs):
    found = QUERIES["op2_language"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert held and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_odd_rows(spark, tricky, clashing, no_docs, docs):
    models = langid.fit(docs)
    rows = {r.text: r for r in langid.predict(tricky, models, "text").collect()}
    for text in (None, "", "--- 123 !!!"):
        assert (rows[text].lang_pred, rows[text].score) == ("und", 0.0)
    kept = langid.known_language(clashing)
    assert kept.columns == clashing.columns
    assert kept.filter("doc_id IN (3, 4, 5, 6)").count() == 0
    assert kept.filter("doc_id = 8").count() == 2
    assert langid.identify(no_docs).count() == 0
    assert {r.lang_pred for r in langid.predict(tricky, langid.fit(no_docs)).collect()} == {"und"}
    one = langid.fit(docs.filter("lang = 'en'"))
    assert {r.lang_pred for r in langid.predict(docs, one).collect()} <= {"en", "und"}


def test_prediction_depends_on_the_text_alone(spark, docs):
    models = langid.fit(docs)
    a = langid.predict(docs, models).orderBy("doc_id").drop("doc_id").collect()
    other = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("zz"))
    b = langid.predict(other, models).orderBy("doc_id").drop("doc_id").collect()
    assert a == b


def test_every_label_is_learnt(spark, monkeypatch):
    pick = random.Random(7)
    words = {
        f"x{i}": ["".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(4)]
        for i in range(510)
    }
    rows = [(i, " ".join(w * 3), lang) for i, (lang, w) in enumerate(sorted(words.items()))]
    rows += [(1000 + i, text, lang) for i, text, lang in rows[:250]]  # some labels are rarer
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    models = langid.fit(df)
    want = {text: lang for _, text, lang in rows}
    found = langid.predict(df, models, "text").collect()
    assert len(found) == len(rows) and {r.text: r.lang_pred for r in found} == want
    monkeypatch.setattr(langid, "MODEL_BYTES", 200 * 8 * langid.FEATURES)
    models = langid.Models.of(models.rows)
    assert len(list(models.blocks())) == 3
    again = {r.text: r for r in langid.predict(df, models, "text").collect()}
    for r in found:
        assert again[r.text].lang_pred == r.lang_pred
        assert again[r.text].score == pytest.approx(r.score, abs=1e-9)


def test_labels_of_other_forms_have_families(spark, docs, clashing, monkeypatch):
    names = {"en": "eng_Latn", "de": "de-AT", "fr": "zh-Hans", "es": "zh-Hant"}
    other = docs.replace(names, subset=["lang"])
    models = langid.fit(other)
    block = next(models.blocks())
    assert block.languages == {
        "germanic": ["de-AT", "eng_Latn"], "only zh": ["zh-Hans", "zh-Hant"]
    }
    assert {f: len(m) for f, m in block.machines.items()} == {"germanic": 1, "only zh": 1}
    found = {r.doc_id: r for r in langid.predict(docs, models).collect()}
    one = langid.fit(docs, {"all": ("en", "de", "fr", "es")})
    many = {r.doc_id: r for r in langid.predict(docs, one).collect()}
    kept = sorted(map(repr, langid.known_language(clashing).collect()))
    monkeypatch.setattr(langid, "MODEL_BYTES", 2 * 8 * langid.FEATURES)
    one = langid.Models.of(one.rows)  # seven rows: a family's machines are in several blocks
    assert len(list(one.blocks())) == 4
    again = {r.doc_id: r for r in langid.predict(docs, one).collect()}
    for r in docs.collect():
        assert found[r.doc_id].lang_pred == names[r.lang]
        assert many[r.doc_id].lang_pred == again[r.doc_id].lang_pred == r.lang
        assert many[r.doc_id].score == pytest.approx(again[r.doc_id].score, abs=1e-9)
    monkeypatch.setattr(langid, "MODEL_BYTES", 1)
    assert sorted(map(repr, langid.known_language(clashing).collect())) == kept


# Mixing


def water_level(sizes):
    """Targets by resharing what is over the limit until nothing is."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, left = {}, set(names), sum(sizes.values())
    while free:
        whole = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / whole > 3 * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / whole for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
        left -= sum(3 * sizes[s] for s in over)
        free -= set(over)
    return target


def check_mix(rows, docs, near):
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(r)
    sizes = {}
    for own in texts.values():
        for r in own:
            n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
            sizes[r.source] = sizes.get(r.source, 0) + n
    target = water_level(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source], rel=1e-9, abs=1e-9)
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 3
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= near * max(target[s], 1)


def test_op3_on_the_table(spark, docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    few = 0.35  # ten documents a source
    check_mix(rows, docs, few)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(rows) == sorted(again)


def test_mixing_in_many_blocks(spark):
    pick = random.Random(4)
    rows = [(i, "w " * pick.randint(0, 60), f"s{min(i % 9, 3)}") for i in range(3000)]
    rows += [(i, "w", "tiny") for i in range(5000, 5003)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = mixing.mix(df, block_rows=200).collect()
    assert len(found) == len(rows)
    check_mix(found, df, 0.02)
    # Documents are balanced as well as words: within one of the expected number.
    for source in ("s0", "s3"):
        own = [r for r in found if r.source == source]
        want = len(own) * own[0].target / own[0].source_size
        assert abs(sum(r.copies for r in own) - want) < 1 + 1e-6


@pytest.mark.parametrize("ids", [None, 7])
def test_mixing_rows_without_ids_of_their_own(spark, ids):
    """Rows of one id and size are dealt over the blocks, and each is taken for itself."""
    rows = [(ids, "w w", f"s{i % 4 % 3}") for i in range(2400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = mixing.mix(df, block_rows=200).collect()
    assert len(found) == 2400
    check_mix(found, df, 0.02)
    taken = {}
    for r in mixing.mixed_rows(df).collect():
        taken[r.source] = taken.get(r.source, 0) + 2
    for r in found:
        assert abs(taken[r.source] - r.target) <= 0.02 * r.target


@pytest.mark.parametrize("small", [True, False])
def test_mixing_of_many_sources(spark, monkeypatch, small):
    """Sizes over five powers of ten, so that the level rises several times."""
    if not small:
        monkeypatch.setattr("tidelake.operators.joins.BROADCAST_BYTES", 1)
        monkeypatch.setattr("tidelake.operators.joins.HOT_ROWS", 20)
    rows = [(i, "w " * int(2 ** (i % 17)), f"s{i % 400:03}" if i % 400 else None) for i in range(400)]
    rows += [(1000 + i, "w w", "s007") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = mixing.mix(df).collect()
    assert sorted(r.doc_id for r in found) == sorted(r[0] for r in rows)
    sizes = {}
    for r in found:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = water_level(sizes)
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9)
        assert abs(r.copies - r.target / r.source_size) < 1 or r.source == "s007"


def test_mixing_odd_rows(spark, tricky, clashing, no_docs):
    rows = mixing.mix(tricky).collect()
    assert len(rows) == tricky.count()
    check_mix(rows, tricky, 1.0)
    assert mixing.mix(no_docs).count() == 0
    mixed = mixing.mixed_rows(clashing)
    assert mixed.columns == clashing.columns
    assert mixed.groupBy(*clashing.columns).count().filter("count > 6").count() == 0
    assert mixing.mixed_rows(no_docs).count() == 0


def test_a_flight_keeps_documents_and_words():
    pick = np.random.default_rng(3)
    size, chance = pick.integers(0, 50, 500), pick.random(500) * 0.98 + 0.01
    flight, decided = mixing.Flight(), {}
    for i in range(500):
        decided |= dict(flight.add(i, int(size[i]), float(chance[i]), float(pick.random())))
    left = {u[0]: u[2] for u in flight.open}
    final = np.array([left.get(i, decided.get(i, 0)) for i in range(500)], float)
    assert len(left) <= 2
    assert final.sum() == pytest.approx(chance.sum(), abs=1e-5)
    assert final @ size == pytest.approx(chance @ size, abs=1e-3)


# Search


def test_top_k_of_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, [1.0, None]),
        (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0]), (None, [9.0, 9.0]), (8, []), (10, [-0.5, 3.0]),
        (20, [1e18, 1e18]), (30, [0.01, -0.01]), (10, [-0.5, 3.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    df = df.withColumn("score", F.lit(1)).withColumn("rank", F.lit("x"))
    found = exact_top_k(df, F.col("vec_id") % 10 == 0, 3, 4, shard_rows=3, block_rows=2)
    given = [
        (i, [int(np.floor(4 * x)) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    want = set()
    for q, v in given:
        if q % 10 == 0:
            # Rows that repeat an id are two candidates, and ask once.
            scored = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in given
                      if i != q and len(w) == len(v)]
            scored = sorted((max(s, -(2**63) + 1), i) for s, i in scored)[:3]
            want |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored)}
    assert sorted(map(tuple, found.collect())) == sorted(want)
    empty = exact_top_k(df.limit(0), F.col("vec_id") % 10 == 0, 3, 4)
    assert empty.count() == 0


# Near copies


def grams(text, n=5):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def near_groups(texts, threshold=0.8):
    """Of texts by unique id: the number of links of each, and the first id of its group."""
    sets = {i: grams(t) for i, t in texts.items()}
    links, root = dict.fromkeys(texts, 0), {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(texts), 2):
        both = len(sets[a] & sets[b])
        if both and both >= threshold * (len(sets[a] | sets[b])) - 1e-9:
            links[a] += 1
            links[b] += 1
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return links, {i: find(i) for i in texts}


def check_near(rows, texts):
    links, first = near_groups(texts)
    for r in rows:
        assert (r.links, r.class_id) == (links[r.doc_id], first[r.doc_id])
        assert r.stays == (r.class_id == r.doc_id)


def test_op6_on_the_table(spark, docs):
    rows = QUERIES["op6_near_duplicates"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    check_near(rows, texts)


def test_near_copies_in_a_large_group(spark, monkeypatch):
    """A group larger than a bucket and a block, one that shares a passage, and a chain."""
    monkeypatch.setattr(setjoin, "BUCKET", 8)
    monkeypatch.setattr(setjoin, "BLOCK", 16)
    pick = random.Random(5)
    word = lambda: "".join(pick.choice("abcdefgh") for _ in range(6))
    base, passage = [word() for _ in range(200)], [word() for _ in range(40)]
    texts = {}
    for i in range(60):
        own = list(base)
        own[pick.randrange(200)] = word()
        texts[i] = " ".join(own)
    for i in range(100, 140):
        texts[i] = " ".join([word() for _ in range(120)] + passage)
    chain = [word() for _ in range(100)]
    for i in range(200, 212):
        chain = chain[3:] + [word() for _ in range(3)]
        texts[i] = " ".join(chain)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    check_near(setjoin.near_duplicates(df).collect(), texts)


def test_near_copies_of_odd_rows(spark, tricky, clashing, no_docs):
    rows = setjoin.near_duplicates(tricky).collect()
    assert len(rows) == tricky.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[2][0].class_id == 1 and by_id[2][0].copies == 2
    assert {r.class_id for r in by_id[8]} == {7} and {r.links for r in by_id[8]} == {2}
    assert all(r.stays and not r.links for i in (3, 4, 5) for r in by_id[i])
    stay = setjoin.one_of_each(clashing)
    assert stay.columns == clashing.columns
    assert sorted(r.doc_id or 0 for r in stay.collect()) == [0, 0, 1, 3, 4, 5, 6, 7, 9, 10, 11]
    assert setjoin.near_duplicates(no_docs).count() == 0
    assert setjoin.one_of_each(no_docs).count() == 0


def test_rows_without_an_id_are_told_apart(spark):
    """Many null ids: each text is checked once, and one row of each group stays."""
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(30))
    texts = [words(k) for k in range(40)] * 2 + [words(k) + " tail" for k in range(40)]
    texts += [None, "", "!!"]
    df = spark.createDataFrame([(None, t) for t in texts], "doc_id bigint, text string")
    rows = setjoin.near_duplicates(df).collect()
    assert len(rows) == len(texts) and sum(r.stays for r in rows) == 43
    assert sorted(r.links for r in rows) == [0] * 3 + [2] * 120
    for given in (df, df.withColumn("doc_id", F.lit(7).cast("bigint"))):
        kept = [r.text for r in setjoin.one_of_each(given).collect()]
        assert len(kept) == 43 and len({(t or "")[:6] for t in kept}) == 42


def test_runs_reach_the_recall():
    assert setjoin.loss_of_run(0.8) == pytest.approx(0.0625)
    assert setjoin.loss_of_run(0.8) ** setjoin.runs_for(0.999, 0.8) < 0.001


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame(
        [(f"{i:04}".encode(), f"{i + 1:04}".encode()) for i in range(n)], "a binary, b binary"
    )
    found = setjoin.components(edges).collect()
    assert len(found) == n + 1 and {bytes(r.root) for r in found} == {b"0000"}


# Exact copies


def test_digest_index_persists(spark, tricky):
    path = scratch_path(spark)
    first = DigestIndex(spark, path, 4)
    old = tricky.filter("doc_id <= 7")
    mark_copies(old, index=first)
    n = first.rows().count()
    spark.sql(f"DROP TABLE `{first.name}`")
    index = DigestIndex(spark, path, 4)
    assert index.rows().count() == n
    rows = {(r.doc_id, r.keep_id) for r in mark_copies(tricky, index=index).collect()}
    assert (2, 2) in rows and (1, 2) in rows and (8, 7) in rows and (7, 7) in rows
    n = index.rows().count()
    mark_copies(tricky, index=index)
    assert index.rows().count() == n
    plan = index.rows().groupBy("digest").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_indexes_of_alike_paths_are_apart(spark):
    root = scratch_path(spark)
    rows = {"a-b": [(1, "x")], "a_b": [(2, "x")], "A-B": [(3, "x")], "it's": [(4, "x")]}
    for name, batch in rows.items():
        index = DigestIndex(spark, f"{root}/{name}", 2)
        found = mark_copies(spark.createDataFrame(batch, "doc_id bigint, text string"), index=index)
        assert [(r.keep_id, r.group_size) for r in found.collect()] == [(batch[0][0], 1)]
    for name, batch in rows.items():
        index = DigestIndex(spark, f"{root}/{name}", 2)
        assert [r.keep_id for r in index.rows().collect()] == [batch[0][0]]
        index.close()
    tables = {t.name for t in spark.catalog.listTables()}
    assert not any(t.startswith("digest_index_") and t == index.name for t in tables)


def test_a_batch_given_again_counts_once(spark):
    index = DigestIndex(spark, scratch_path(spark), 2)
    batch = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id bigint, text string")
    for _ in range(2):
        found = mark_copies(batch, index=index, batch="monday").collect()
        assert {(r.doc_id, r.keep_id, r.group_size) for r in found} == {(1, 2, 2), (2, 2, 2), (3, 3, 1)}
    found = mark_copies(batch, index=index, batch="tuesday").collect()
    assert {r.group_size for r in found} == {4, 2}


def test_several_batches_at_once(spark, tricky, no_docs):
    later = F.coalesce(F.col("doc_id") > 5, F.lit(False))
    once = {(r.doc_id, r.keep_id, r.group_size, bytes(r.digest)) for r in mark_copies(tricky).collect()}
    found = mark_copies(tricky, batches=[later, ~later])
    assert {(r.doc_id, r.keep_id, r.group_size, bytes(r.digest)) for r in found.collect()} == once
    assert mark_copies(no_docs, batches=[later, ~later]).count() == 0


def test_group_sizes_cover_all_batches(spark):
    index = DigestIndex(spark, scratch_path(spark), 4)
    batches = [
        [(5, "a"), (6, "a"), (7, "b"), (None, "n")],
        [(9, "A"), (8, "c"), (1, "n")],
        [(2, "a"), (3, "b"), (4, "d"), (4, "d"), (10, "c")],
    ]
    want = [
        {(5, 6, 2), (6, 6, 2), (7, 7, 1), (None, None, 1)},
        {(9, 6, 3), (8, 8, 1), (1, None, 2)},
        {(2, 6, 4), (3, 7, 2), (4, 4, 2), (10, 8, 2)},
    ]
    for rows, expected in zip(batches, want):
        batch = spark.createDataFrame(rows, "doc_id bigint, text string")
        found = mark_copies(batch, index=index).collect()
        assert len(found) == len(rows)
        assert {(r.doc_id, r.keep_id, r.group_size) for r in found} == expected
    assert index.rows().count() == 5


def test_exact_copies_of_odd_rows(spark, tricky, clashing, no_docs):
    rows = mark_copies(tricky).collect()
    groups = {}
    for r in tricky.collect():
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or "")
        groups.setdefault(hashlib.sha256(text.encode()).digest(), []).append(r.doc_id)
    assert len(rows) == tricky.count()
    for r in rows:
        own = groups[bytes(r.digest)]
        best = max((i for i in own if i is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (best, len(own), r.doc_id == best)
    kept = without_copies(clashing)
    assert kept.columns == clashing.columns and kept.count() == len(groups)
    assert mark_copies(no_docs).count() == 0 and without_copies(no_docs).count() == 0


# Chats


def test_escaping_is_reversible(spark):
    pick = random.Random(6)
    signs = [*CONTROLS, "<", "|", "[", "\\", "s>", "INST]", "a", "\n", "🙂", "<\\s>"]
    texts = ["".join(pick.choice(signs) for _ in range(pick.randint(0, 12))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t and not any(c in r.e for c in CONTROLS)


def test_reply_trees(spark):
    rows = [
        ("t", 1, None, "user", "hi", 0.0), ("t", 2, 1, "assistant", "good", 5.0),
        ("t", 3, 1, "assistant", "bad", 1.0), ("t", 4, 2, "user", None, None),
        ("t", 5, 4, "assistant", "end </s>", 2.0), ("t", 6, 3, "user", "hm", 0.0),
        ("o", 1, 99, "user", "its parent is missing", 1.0),
        ("c", 1, 2, "user", "round", 1.0), ("c", 2, 1, "user", "round", 1.0),
        ("c", 3, 2, "user", "off the circle", 1.0),
        (None, 1, None, None, "no tree", 1.0),
    ]
    kinds = "tree string, message bigint, parent bigint, role string, text string, score double"
    df = spark.createDataFrame(rows, kinds)
    read = read_chats(format_chats(df, per_tree=2)).collect()
    found = {(r.tree, r.branch): ([(t.role, t.text) for t in r.turns], r.learnt) for r in read}
    assert found == {
        ("t", 1): ([("user", "hi"), ("assistant", "good"), ("user", ""), ("assistant", "end </s>")],
                   ["good", "end </s>"]),
        ("t", 2): ([("user", "hi"), ("assistant", "bad"), ("user", "hm")], ["bad"]),
        ("o", 1): ([("user", "its parent is missing")], []),
        (None, 1): ([("", "no tree")], []),
    }
    assert format_chats(df.limit(0)).count() == 0


def test_repeated_messages_count_once(spark):
    rows = [
        ("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "a", 1.0),
        ("t", 2, 1, "assistant", "a", 1.0), ("t", 2, 1, "assistant", "b", 9.0),
        ("t", 3, 2, "user", "more", 0.0), ("t", 1, None, "user", "q", 0.0),
        ("t", None, 3, "assistant", "without an id", 9.0),
        (None, 1, None, "user", "x", 0.0), (None, 1, None, "user", "x", 0.0),
        (None, 2, 1, None, None, None), (None, 2, 1, None, None, None),
    ]
    kinds = "tree string, message bigint, parent bigint, role string, text string, score double"
    df = spark.createDataFrame(rows, kinds).withColumn("branch", F.lit("x"))
    read = read_chats(format_chats(df, per_tree=9)).collect()
    found = {(r.tree, r.branch): ([(t.role, t.text) for t in r.turns], r.learnt) for r in read}
    assert len(read) == len(found) and found == {
        ("t", 1): ([("user", "q"), ("assistant", "a"), ("user", "more")], ["a"]),
        (None, 1): ([("user", "x"), ("", "")], []),
    }


def test_long_and_repeated_conversations(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"turn {i} \\ <s>") for i in range(70)]
    rows += [(2, 0, "a\nb", "x" * 200_000), (2, 0, "a\nb", "x" * 200_000), (2, None, "[INST]", None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    read = {r.tree: r for r in read_chats(
        format_chats(linear_replies(df, "conv_id", "turn", "role", "text"))).collect()}
    assert [(t.role, t.text) for t in read[1].turns] == [(r[2], r[3]) for r in rows[:70]]
    assert [t.role for t in read[2].turns] == ["[INST]", "a\nb", "a\nb"]
    assert [len(t.text) for t in read[2].turns] == [0, 200_000, 200_000]


# Pipeline


def test_pipeline(spark, docs):
    """What each stage makes of its input is what brute force makes of it."""
    table, outs = docs, {}
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, table, SF).cache()
        if name != "tokens":
            assert out.columns == docs.columns
        outs[name], table = out.collect(), out
    texts = {r.doc_id: r.text for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert sorted(r.doc_id for r in outs["language"]) == sorted(texts)
    last = {}
    for i, t in texts.items():
        key = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
        last[key] = max(i, last.get(key, i))
    assert sorted(r.doc_id for r in outs["exact_dedup"]) == sorted(last.values())
    _, first = near_groups({i: texts[i] for i in last.values()})
    assert sorted(r.doc_id for r in outs["near_dedup"]) == sorted(set(first.values()))
    sizes, taken = {}, {}
    words = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    for stage, found in (("near_dedup", sizes), ("mixing", taken)):
        for r in outs[stage]:
            found[r.source] = found.get(r.source, 0) + words(r)
    for source, target in water_level(sizes).items():
        assert abs(taken.get(source, 0) - target) <= 0.35 * target  # ten documents a source
    copies = Counter(r.doc_id for r in outs["mixing"])
    assert set(copies) <= set(first.values()) and max(copies.values()) <= 3
    assert Counter(r.doc_id for r in outs["tokens"]) == copies
    model = pieces.load_model(tokenizer_file("piece_bpe_32k.model"))
    for row in {r.doc_id: r for r in outs["tokens"]}.values():
        assert row.ids == best_ids(model, " " + texts[row.doc_id])
    assert corpus_pipeline.run(spark, SF).count() == len(outs["tokens"])


def test_pipeline_of_odd_rows(spark, clashing, no_docs):
    for docs in (clashing, no_docs):
        table, counts = docs, []
        for name, function in corpus_pipeline.STAGES:
            out = function(spark, table, SF)
            if name != "tokens":
                assert out.columns == docs.columns
                table = out
            counts.append(out.count())
        if docs is no_docs:
            assert counts == [0] * 5
            continue
        known, kept, apart = counts[:3]
        assert known >= kept > 0 and apart <= kept and counts[3] == counts[4] <= 3 * apart
        texts = {(r.text or "").lower() for r in clashing.collect() if re.search("[a-z]", r.text or "")}
        assert kept <= len(texts)
