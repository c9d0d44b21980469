"""Token files, SentencePiece, licences, shards: operators that read every text."""

import random
import re
import time
import zlib
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelake.lake import scratch_path
from tidelake.llm import pieces, repair
from tidelake.llm.hilbert import curve_column, hilbert_index, write_shards
from tidelake.llm.licenses import BASE_PHRASES, evaluate, postfix, scan_licenses
from tidelake.llm.queries import QUERIES
from tidelake.llm.tokens import Encoder

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


def encoded(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    found = tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [x.ids + [2] for x in found]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def random_texts(n, seed=0):
    pick = random.Random(seed)
    signs = ["a", "b", "'s", "don't", "The", " ", "  ", "\n", "\n\n", "\t", ".", ",", "é", "È", "ß",
             "日本", "🙂", " ", " ", "　", "\x1f", "123", "<|endoftext|>", "▁", "x.y", "!"]
    return ["".join(pick.choice(signs) for _ in range(pick.randint(0, 40))) for _ in range(n)]


def test_chunked_ids_are_those_of_whole_texts():
    texts = [*random_texts(400), None, "", " ", LONG_WORD]
    data, at = repair.utf8(pa.array(texts, pa.string()))
    ids, bounds = Encoder(BPE).encode(data, at)
    for i, want in enumerate(encoded(texts)):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == want[:-1]


LONG_WORD = "x" * 5000 + " " + "y" * 3000


def check_tokens(rows, texts):
    """rows: (doc_id, start, n_tokens, ids_crc32, ids) in the order of their start."""
    start = 0
    for row, want in zip(rows, encoded(texts), strict=True):
        assert row.start == start and row.n_tokens == len(want)
        assert row.ids_crc32 == crc(want)
        start += len(want)


def test_token_files(spark, tricky, no_docs):
    path = scratch_path(spark)
    repair.write_tokens(tricky, path, BPE, 2)
    rows = repair.read_tokens(spark, path).orderBy("start").collect()
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    by_text = {}
    for r in tricky.collect():
        by_text.setdefault(r.doc_id, []).append(crc(encoded([r.text])[0]))
    for r in rows:
        by_text[r.doc_id].remove(r.ids_crc32)
        assert crc(r.ids) == r.ids_crc32
    assert not any(by_text.values())
    found = repair.read_document(spark, path, 10)
    assert [f.tolist() for f in found] == encoded([tricky.filter("doc_id = 10").first().text])
    assert len(repair.read_document(spark, path, 8)) == 2
    empty = scratch_path(spark)
    repair.write_tokens(no_docs, empty, BPE, 2)
    assert repair.read_tokens(spark, empty).count() == 0


def test_op1_on_the_table(spark, docs):
    rows = QUERIES["op1_repair_tokens"](spark, SF).orderBy("doc_id").collect()
    check_tokens(rows, [r.text for r in docs.orderBy("doc_id").collect()])


@pytest.mark.parametrize("terminals", [50_000, 70_000])
def test_repair_round_trip_and_random_access(terminals):
    pick = np.random.default_rng(1)
    for ids in (
        pick.integers(0, 30, 20_000), np.zeros(1000, int), np.array([5]), np.zeros(0, int),
        np.tile([1, 2, 3, 4, 0, 0, 0], 500),
    ):
        ids = ids.astype(np.uint32)
        at = np.array([0, len(ids) // 3, len(ids)])
        data = repair.write_payload(ids, at, np.array([1, 2]), np.array([False, True]), terminals)
        shard = repair.Payload(data)
        assert (shard.ids() == ids).all()
        assert (shard.document(1) == ids[at[1] :]).all()
        for _ in range(20):
            a, b = sorted(pick.integers(0, len(ids) + 1, 2).tolist())
            assert (shard.ids(a, b) == ids[a:b]).all()
        if len(ids) >= 1000:
            assert len(data) < 4 * len(ids)


def test_token_files_of_repeated_rows_and_clashing_columns(spark, tmp_path, clashing):
    rows = [(None, "one and the same text")] * 3000 + [(1, None)] * 1000
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    merge = "spark.sql.adaptive.coalescePartitions.enabled"  # it would join these small tasks
    spark.conf.set(merge, "false")
    try:
        repair.write_tokens(df, str(tmp_path / "equal"), BPE, 2)
    finally:
        spark.conf.unset(merge)
    found = repair.read_tokens(spark, str(tmp_path / "equal")).orderBy("start").collect()
    assert [tuple(r.ids) for r in found] == [tuple(x) for x in encoded([t for _, t in rows])]
    shards = repair.read_shards(spark, str(tmp_path / "equal"))
    assert shards.select("part").distinct().count() > 2  # a group of equal rows is spread
    named = clashing.withColumns({c: F.lit("x") for c in ("id", "tie", "part", "place_file", "begin")})
    repair.write_tokens(named, str(tmp_path / "named"), BPE, 2)
    found = repair.read_tokens(spark, str(tmp_path / "named")).collect()
    want = Counter((r.doc_id, *ids) for r, ids in zip(
        clashing.select("doc_id", "text").collect(),
        encoded([r.text for r in clashing.select("doc_id", "text").collect()]), strict=True))
    assert Counter((r.doc_id, *r.ids) for r in found) == want


def test_grammar_goes_on_until_no_pair_is_frequent():
    equal = np.zeros(1 << 20, np.uint32)
    sequence, rules, _ = repair.compress(equal, 50_257)
    assert len(sequence) + len(rules) <= 40
    pick = np.random.default_rng(3)
    ids = np.concatenate([np.tile(pick.integers(0, 60_000, 400), 30) for _ in range(60)])
    for terminals in (60_000, 65_530):  # the second one has room for six rules of 16 bits
        sequence, rules, rounds = repair.compress(ids, terminals)
        pairs = Counter(zip(sequence[:-1].tolist(), sequence[1:].tolist()))
        assert max(pairs.values(), default=0) < repair.LEAST_COUNT
        assert sum(rounds) == len(rules) > 6


def test_a_long_expansion_is_read_in_part():
    ids = np.tile(np.arange(1000), 1000).astype(np.uint32)
    at = np.arange(0, len(ids) + 1, 1000)
    data = repair.write_payload(
        ids, at, np.arange(1000), np.zeros(1000, bool), 65_530
    )
    shard = repair.Payload(data)
    assert (shard.ids() == ids).all() and len(data) < len(ids)
    shard._expansions = None  # what is asked for must not need the whole shard
    pick = random.Random(4)
    for _ in range(200):
        a = pick.randrange(len(ids))
        b = min(len(ids), a + pick.randrange(1500))
        assert (shard.ids(a, b) == ids[a:b]).all()
    assert (shard.document(999) == np.arange(1000)).all()


@pytest.fixture(scope="module")
def model():
    return pieces.load_model(PIECES)


def best_ids(model, text):
    """Search over the whole text without cuts or windows."""
    marks = ["bytes" if c == pieces.MARK else pieces.MARK if c == " " else c for c in text]
    best, back = [0], [None]
    for end in range(1, len(marks) + 1):
        own = marks[end - 1]
        raw = (pieces.MARK if own == "bytes" else own).encode()
        found = (best[end - 1] + pieces.BYTE_SCORE * len(raw), False, end - 1, raw)
        for begin in range(max(0, end - model.longest), end):
            if "bytes" not in marks[begin:end]:
                piece = model.pieces.get("".join(marks[begin:end]))
                if piece and (best[begin] + piece[1], True) > found[:2]:
                    found = (best[begin] + piece[1], True, begin, piece[0])
        best.append(found[0])
        back.append(found[1:])
    out, end = [], len(marks)
    while end:
        known, begin, what = back[end]
        out.append([what] if known else model.byte_ids[list(what)].tolist())
        end = begin
    return [i for ids in reversed(out) for i in ids]


def test_streaming_search_finds_the_best_pieces(model):
    pick = random.Random(2)
    texts = random_texts(150, 3) + [None, "", " ", "  a", LONG_WORD[:300]]
    texts += ["".join(pick.choice("etainos") for _ in range(150)) for _ in range(30)]
    ids, at = pieces.encode(model, pa.array(texts, pa.string()))
    data, data_at = pieces.decode(model, ids, at)
    for i, text in enumerate(texts):
        want = best_ids(model, " " + text) if text else []
        assert ids[at[i] : at[i + 1]].tolist() == want
        assert data[data_at[i] : data_at[i + 1]].tobytes() == (text or "").encode()


@pytest.mark.parametrize(
    "text",
    ["\ue000", "a \ue000 b\ue000▁", "▁" * 60, "x " + "▁" * 60 + "\ue000" * 60 + " y",
     "日本▁\ue000語" * 30],
)
def test_space_marks_and_private_characters_come_back(model, text):
    ids, at = pieces.encode(model, pa.array([text, "a", text]))
    data, data_at = pieces.decode(model, ids, at)
    for i in (0, 2):
        assert ids[at[i] : at[i + 1]].tolist() == best_ids(model, " " + text)
        assert data[data_at[i] : data_at[i + 1]].tobytes() == text.encode()


@pytest.mark.parametrize("sign", ["=", "-", "a", "_", ".", "*", "é", "日"])
def test_runs_of_one_sign_take_time_in_proportion(model, sign):
    short = pieces.Stream(model)
    ids = short.push(sign * 300) + short.finish()
    assert ids == best_ids(model, sign * 300)
    steps = []
    for n in (4_000, 32_000):
        stream, start = pieces.Stream(model), time.perf_counter()
        out = stream.push(sign * n) + stream.finish()
        steps.append((time.perf_counter() - start) / n)
        assert sum(model.width[i] for i in out) == len((sign * n).encode())
    assert steps[1] < 4 * steps[0]


def test_parts_of_a_run_may_come_in_any_size(model):
    text = "=" * 700 + "a-" * 200 + "=" * 90
    whole = pieces.Stream(model)
    want = whole.push(text) + whole.finish()
    for size in (1, 7, 100):
        stream, out = pieces.Stream(model), []
        for i in range(0, len(text), size):
            out += stream.push(text[i : i + size])
        assert out + stream.finish() == want


def test_stream_keeps_a_short_window(model):
    text = "thenationalrestorationofthe" * 500
    stream, out = pieces.Stream(model), []
    for i in range(0, len(text), 7):
        out += stream.push(text[i : i + 7])
    assert stream.window <= 4 * model.longest
    out += stream.finish()
    assert out == best_ids(model, text)


@pytest.mark.parametrize("alone", [0, 5, 1 << 30])
def test_both_forms_of_the_search_agree(model, monkeypatch, alone):
    monkeypatch.setattr(pieces, "ALONE", alone)
    monkeypatch.setattr(pieces, "LANES", 40)  # several groups of cuts
    pick = random.Random(6)
    texts = ["".join(pick.choice("etainos日é=\ue000▁") for _ in range(pick.randrange(200))) for _ in range(90)]
    texts += ["=" * n for n in (1, 15, 16, 17, 33, 300)] + ["-=" * 90, "a" * 100 + "=" * 100, "▁" * 50]
    texts += random_texts(30, 9)
    ids, at = pieces.encode(model, pa.array(texts))
    for i, text in enumerate(texts):
        want = best_ids(model, " " + text) if text else []
        assert ids[at[i] : at[i + 1]].tolist() == want


def test_lanes_keep_a_short_window(model):
    pick = random.Random(8)
    words = ["the", "national", "restoration", "of", "town"]
    texts = ["".join(pick.choice(words) for _ in range(pick.randrange(1, 300))) for _ in range(70)]
    points = np.array([ord(c) for t in texts for c in t], np.int32)
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    lanes = pieces.Lanes(model, points, at)
    ids, count = lanes.run()
    assert lanes.end > 1000 and lanes.window <= 4 * model.longest
    begin = np.cumsum(count) - count
    for i, text in enumerate(texts):
        assert ids[begin[i] : begin[i] + count[i]].tolist() == best_ids(model, text)


def test_encode_texts(spark, clashing, no_docs):
    rows = pieces.encode_texts(clashing, PIECES).collect()
    assert len(rows) == clashing.count() and all(r.round_trip for r in rows)
    assert all(crc(r.ids) == r.ids_crc32 and len(r.ids) == r.n_tokens for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 5)} == {0}
    assert pieces.encode_texts(no_docs, PIECES).count() == 0


def test_op9_on_the_table(spark, docs, model):
    rows = QUERIES["op9_sentencepiece"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts) and all(r.round_trip for r in rows)
    for r in rows:
        text = texts[r.doc_id]
        assert r.ids == (best_ids(model, " " + text) if text else [])


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def base_places(text):
    words, found = words_of(text), []
    for phrase, label in BASE_PHRASES.items():
        parts = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return len(words), sorted(found)


def check_base(rows, texts):
    for row in rows:
        n, places = base_places(texts[row.doc_id])
        assert (row.n_words, row.n_base) == (n, len(places))
        assert row.first_word == (places[0][0] if places else None)
        assert row.last_word == (places[-1][0] if places else None)
        labels = {label for _, label in places}
        assert row.base_labels == ",".join(sorted(labels))
        assert labels <= set(row.labels.split(",")) and 0 <= row.score <= 1


def test_licenses(spark, no_docs):
    texts = {
        1: "MIT License MIT LICENSE", 2: None, 3: "", 4: "the GNU General\n Public  License, v3",
        5: "// SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0 */\nÉ mit license",
        6: "SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0",
        7: "SPDX-License-Identifier: MIT OR", 8: "xmit license mit licenses",
        9: "Released under the MIT License. " * 2000, 10: "general public license apache license",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    rows = scan_licenses(df.selectExpr("*", "'x' AS labels", "1 AS score")).collect()
    check_base(rows, texts)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[5].labels == "apache,gpl,mit" and by_id[5].permissive
    assert by_id[6].labels == "gpl" and by_id[6].permissive and by_id[6].score == 1.0
    assert not by_id[4].permissive and by_id[7].score == 0.3
    assert by_id[8].labels == "" and by_id[9].n_base == 2000
    assert all(s.word is not None for s in by_id[9].spans)
    assert scan_licenses(no_docs).count() == 0


@pytest.mark.parametrize(
    "tag, labels, score",
    [
        ("MIT-->", "mit", 1.0), ("BSD-3-Clause*/", "bsd", 1.0), ("GPL-2.0+", "gpl", 1.0),
        ("see", "unknown", 0.5), ("banana", "unknown", 0.5), ("LicenseRef-Foo", "unknown", 0.5),
        ("NONE", "", 0.0), ("NOASSERTION", "", 0.0), ("MIT OR banana", "mit,unknown", 1.0),
    ],
)
def test_identifiers_are_looked_up(spark, tag, labels, score):
    texts = {1: f"<!-- SPDX-License-Identifier: {tag}\nrest", 2: "mit license\n" * 3}
    rows = scan_licenses(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"))
    found = sorted(rows.collect())
    check_base(found, texts)
    assert (found[0].labels, found[0].score) == (labels, score)
    assert (found[1].labels, found[1].score) == ("mit", 0.8)
    listed = scan_licenses(rows.select("doc_id", F.lit(texts[1]).alias("text")),
                           identifiers=["banana", "see", "mit", "licenseref-foo"])
    assert all("unknown" not in r.labels for r in listed.collect() if "GPL" not in tag and "BSD" not in tag)


def test_op5_on_the_table(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    check_base(QUERIES["op5_licenses"](spark, SF).collect(), texts)


@pytest.mark.parametrize(
    "text, order",
    [
        ("MIT", "mit"),
        ("a or b and c", "a b c and or"),
        ("(a or b) and c", "a b or c and"),
        ("a with b or c", "a b with c or"),
        ("a and", None), ("(a", None), ("a b", None), (")", None), ("or a", None), ("", None),
        ("mit */ rest", "mit"),
    ],
)
def test_shunting_yard(text, order):
    found = postfix(text)
    assert (found and " ".join(found)) == order


def test_evaluation():
    names, met = evaluate(postfix("(gpl-2.0-only or mit) and gpl-3.0-or-later"))
    assert names == {"gpl", "mit"} and not met


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_neighbours(dims, bits):
    points = np.array(list(product(range(1 << bits), repeat=dims)))
    index = hilbert_index(list(points.T), bits)
    assert sorted(index) == list(range(len(points)))
    steps = np.abs(np.diff(points[np.argsort(index)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def check_shards(rows, texts, shards=8):
    sizes = {}
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        sizes.setdefault(r.shard, []).append((r.slot, r.size))
    for own in sizes.values():
        assert sorted(s for s, _ in own) == list(range(len(own)))
    assert set(sizes) <= set(range(shards))
    total, most = sum(r.size for r in rows), max(r.size for r in rows)
    for shard in range(shards):
        assert abs(sum(s for _, s in sizes.get(shard, [])) - total / shards) <= most
    order = [r.curve for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)


def test_op10_on_the_table(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = QUERIES["op10_hilbert_shards"](spark, SF).collect()
    assert len(rows) == len(texts)
    check_shards(rows, texts)


def test_shards_of_odd_rows(spark, clashing, no_docs):
    layout = write_shards(clashing, ["source", "lang", "n_chars"], 4)
    back = layout.rows(clashing)
    assert sorted(map(repr, back.select(*clashing.columns).collect())) == sorted(
        map(repr, clashing.collect())
    )
    assert write_shards(no_docs, ["source", "n_chars"], 4).rows(no_docs).count() == 0


def test_equal_rows_are_cut(spark, monkeypatch):
    rows = [(7, "x" * 99, "a")] * 4000 + [(i, "y" * i, "b") for i in range(400)]
    rows += [(None, None, None)] * 50
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 1
    for piece_bytes in (32 << 20, 4000):
        monkeypatch.setattr("tidelake.llm.hilbert.PIECE_BYTES", piece_bytes)
        layout = write_shards(df, ["source", ("size", size)], 8)
        back = layout.rows(df).select("doc_id", "text", "source", "shard", "slot", "curve")
        found = back.collect()
        assert Counter(tuple(r)[:3] for r in found) == Counter(rows)
        total = Counter()
        for r in found:
            total[r.shard] += len(r.text or "") + 1
        assert max(total.values()) - min(total.values()) <= 2 * 400
        assert len({(r.shard, r.slot) for r in found}) == len(rows)
        assert all(r.slot < 10_000 for r in found)
        files = back.inputFiles()
    # No file has much more than a piece: many files, though most rows are equal.
    assert len(files) >= sum(len(t or "") + 1 for _, t, _ in rows) / 4000


def test_an_outlier_leaves_the_steps_to_the_others(spark):
    rows = [(i, "t", f"https://site{i % 40:02d}.example/") for i in range(4000)]
    rows += [(4000, "t", "!odd one"), (4001, "t", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = df.select("source", curve_column(df, ["source", "doc_id"], 8).alias("curve")).collect()
    layout = write_shards(df, ["source", ("none", F.lit(0))], 8)
    held = layout.rows(df).groupBy("shard").agg(F.collect_set("source").alias("held")).collect()
    assert len({r.curve for r in found}) > 1000
    assert all(len(r.held) <= 40 // 8 + 3 for r in held)


def test_slots_of_files_cut_by_a_record_limit(spark):
    rows = [(i, "t" * (i % 50), "ab"[i % 2]) for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "9")
    try:
        layout = write_shards(df, ["source", "doc_id"], 4)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    check_shards(
        layout.rows(df).select(
            "*", (F.octet_length("text") + 1).alias("size"), F.crc32("text").alias("text_crc32")
        ).collect(),
        {i: t for i, t, _ in rows}, 4,
    )


@pytest.mark.parametrize("most", [400_000, 5, 0])
def test_chunks_of_earlier_slices_are_not_encoded_again(monkeypatch, most):
    slices = [["the same words, again and again", "", "ünïcode words " + "x" * 100, "12 34\n\n ab"],
              ["again the same words", "new ones, 12 and " + "x" * 100], random_texts(50)]
    monkeypatch.setattr(Encoder, "KEPT", most)
    encoder, given = Encoder(BPE), []
    encode = encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda own: given.extend(own) or encode(own))
    for texts in slices + slices:
        given.clear()
        ids, bounds = encoder.encode(*repair.utf8(pa.array(texts)))
        found = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
        assert found == [want[:-1] for want in encoded(texts)]
        assert len(encoder.kept) <= most
    if most > 5:  # nothing is new any more but what is too long to be kept
        given.clear()
        encoder.encode(*repair.utf8(pa.array(slices[0])))
        assert {t for t in given if t} == {" " + "x" * 100}
