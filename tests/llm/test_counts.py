"""Token counts against the libraries."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tidelake.llm import counts
from tidelake.llm.queries import QUERIES

PIECES = public_tokenizers.path("piece_bpe_32k.model")
FILES = [public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json")]
SF = "/root/testdata/sf0.001"
SIGNS = ["a", "b", "'s", "don't", "The", " ", "  ", "   ", "\n", "\n\n", "\t", "\r\n", ".", ",", "é",
         "é", "ß", "日本", "🙂", "\xa0", " ", "　", "\x00", "\x1f", "123",
         "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x0A>", "▁", "▁▁", "", "x.y", "!"]


def random_texts(n, seed=0):
    pick = random.Random(seed)
    return ["".join(pick.choice(SIGNS) for _ in range(pick.randint(0, 40))) for _ in range(n)]


def library(path, texts):
    texts = [t or "" for t in texts]
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return [len(x.ids) for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
    import sentencepiece

    return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]


ODD = [None, "", " ", "  ", "▁", "\n", " \n ", "x" * 5000, "=" * 3000 + " " + "- " * 500, "a  "]


@pytest.mark.parametrize("path", [PIECES, *FILES])
@pytest.mark.parametrize("known", [0, 50])
def test_counts_are_the_librarys(path, known):
    texts = [*SIGNS, *random_texts(400), *ODD]
    units = counts.units_of(path)
    data, bounds, _ = units.cut(*counts.utf8(pa.array(texts, pa.string())))
    found = sorted(set(counts.text_array(data, bounds).to_pylist()))[:known]
    table = counts.LengthTable([u.encode() for u in found], units.count(found) if found else [])
    counter = counts.Counter(path, table)
    for _ in range(2):  # the second time from the cache
        n_bytes, n_tokens = counter.count(pa.array(texts, pa.string()))
        assert n_tokens.tolist() == library(path, texts)
        assert n_bytes.tolist() == [len((t or "").encode()) for t in texts]


def test_texts_are_cut():
    """Only the files whose rules are known are cut, so the test above is not of whole texts."""
    assert [counts.units_of(p).divisible for p in (PIECES, *FILES)] == [True, True, False]


def test_table_tells_alike_keys_apart(monkeypatch):
    keys = [f"k{i}".encode() for i in range(300)]
    monkeypatch.setattr(counts, "hashes", lambda data, at: np.diff(at).astype(np.uint64))
    table = counts.LengthTable(keys, list(range(300)))
    asked = pa.array([*keys, b"", b"k300", b"x"], pa.binary())
    found = table.look_up(*counts.utf8(asked))
    assert found.tolist() == [*range(300), -1, -1, -1]


def test_summary_keeps_the_frequent(monkeypatch):
    monkeypatch.setattr(counts, "FREQUENT", 10)
    pick = random.Random(1)
    parts = [{f"w{pick.randint(0, 500)}".encode(): 1 for _ in range(100)} for _ in range(20)]
    for part in parts:
        part[b"often"] = 40
    state = counts.merge_summaries([counts._packed(p) for p in parts])
    kept = dict(counts.pickle.loads(state))
    assert b"often" in kept and len(kept) <= 10


def test_small_cache(monkeypatch):
    monkeypatch.setattr(counts, "CACHE_BYTES", 20)
    counter = counts.Counter(PIECES, counts.LengthTable([], []))
    texts = random_texts(100, 3)
    for text in texts:
        assert counter.count(pa.array([text]))[1].tolist() == library(PIECES, [text])
        assert counter.cached <= 20


def check(df, rows):
    got = sorted((r.doc_id is not None, r.doc_id, r.n_bytes, r.n_tokens, r.over_limit)
                 for r in df.collect())
    want = [
        (r.doc_id is not None, r.doc_id, len((r.text or "").encode()), n, n > 4096)
        for r, n in zip(rows, library(PIECES, [r.text for r in rows]))
    ]
    assert got == sorted(want)


def test_odd_rows(spark, tricky, clashing, no_docs):
    for docs in (tricky, clashing):
        found = counts.count_tokens(docs, PIECES, 4096)
        assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        check(found, tricky.collect())
    assert counts.count_tokens(no_docs, PIECES, 4096).count() == 0
    nulls = tricky.withColumn("text", counts.F.lit(None).cast("string"))
    assert counts.count_tokens(nulls, PIECES, 4096).agg({"n_tokens": "sum"}).first()[0] == 0


def test_query(spark, docs):
    check(QUERIES["op12_token_counts"](spark, SF), docs.collect())
