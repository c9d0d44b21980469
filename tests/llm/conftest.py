import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators use themselves.
CLASHING = ["digest", "keep_id", "kept_digest", "own_digest", "shard", "curve", "slot", "_crc",
            "staying_id", "mix_id", "mix_size", "mix_copy", "size", "class"]

LONG = "the quick brown fox jumps over the lazy dog again and again " * 4000
TRICKY = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a"),
    (2, "THE quick brown fox jumps over the lazy dog near the old river bank today", "en", "a"),
    (3, None, None, None),
    (4, "", "en", "b"),
    (5, "", None, "b"),
    (6, "--- 123 !!!", "de", "a"),
    (7, "ein kurzer Satz über die Straße und den Fluß", "de", None),
    (8, "ein kurzer Satz über die Straße und den Fluß", "de", "c"),
    (8, "ein kurzer Satz über die Straße und den Fluß", "de", "c"),
    (9, LONG, "en", "a"),
    (10, "日本語 🙂 <|endoftext|> \x00 \x1f ▁ tail ", "xx", "a"),
    (None, "a row without an id but with words", "en", "a"),
    (None, None, None, None),
    (11, "a\tb\n\nc \r\n d e f", "en", "d"),
]


@pytest.fixture(scope="session")
def tricky(spark):
    """Nulls, empty and very long texts, copies, a repeated row, odd signs."""
    rows = [(*r, len(r[1] or "")) for r in TRICKY]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="session")
def clashing(tricky):
    """The same with further columns named like the operators' own."""
    from pyspark.sql import functions as F

    return tricky.withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(tricky):
    return tricky.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
