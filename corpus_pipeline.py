"""A corpus from documents to token ids: each stage reads what the one before it wrote.

The stages, in order: documents in a known language stay; of exact copies one stays; of near
duplicates one of each group stays; sources are mixed to their target weights, so that a document
is dropped, kept or repeated; the texts are encoded to SentencePiece ids.

Every stage takes (spark, docs, sf_dir) and returns all columns of ``docs``; the last one returns a
row of ids for each row. Nulls, empty tables and clashing columns are handled as the operators'
modules say; a null or wordless text has no language and leaves in the first stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelake.lake import stage
from tidelake.llm.common import reads_files, table
from tidelake.llm.digests import without_copies
from tidelake.llm.langid import known_language
from tidelake.llm.mixing import mixed_rows
from tidelake.llm.pieces import encode_texts
from tidelake.llm.queries import tokenizer_file
from tidelake.llm.setjoin import one_of_each

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is found."""
    return known_language(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of equal texts the document with the largest id."""
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    return one_of_each(docs, reads_files(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as the mix of sources does."""
    return mixed_rows(docs, is_scan=reads_files(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of each row's text."""
    return encode_texts(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("tokens", tokens),
]

# SQL can express neither the trained models nor the sampling.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES:
        docs = stage(function(spark, docs, sf_dir))
    return docs
