"""One query per operator over its whole table, and its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelake.lake import scratch_path, stage
from tidelake.llm.chat import format_chats, linear_replies, read_chats
from tidelake.llm.common import table
from tidelake.llm.counts import count_tokens
from tidelake.llm.digests import mark_copies, normal_text
from tidelake.llm.hilbert import write_shards
from tidelake.llm.langid import identify
from tidelake.llm.licenses import scan_licenses
from tidelake.llm.merkle import build_manifest, fold, leaf_digest, proofs, sha256, siblings
from tidelake.llm.mixing import mix
from tidelake.llm.pieces import encode_texts
from tidelake.llm.repair import read_tokens, write_tokens
from tidelake.llm.setjoin import near_duplicates
from tidelake.llm.topk import exact_top_k
from tidelake.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql.strip()
        return function

    return register


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: The id that ends each document in the token files.
END_ID = 2


@query("op1_repair_tokens")
def repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark)
    docs = table(spark, sf_dir, "documents")
    write_tokens(docs, path, tokenizer_file("byte_bpe_50k.json"), END_ID)
    return read_tokens(spark, path, with_ids=False)


@query("op2_language")
def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@query("op3_cube_mix")
def cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies"
    )


TOP_K, SCALE, EVERY = 20, 64, 20


@query(
    "op4_exact_top_k",
    f"""
    WITH given AS (
      SELECT CAST(vec_id AS BIGINT) AS vec_id,
        list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
      SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM given q JOIN given c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
      WHERE q.vec_id % {EVERY} = 0
    )
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
      FROM scored
    ) WHERE rank <= {TOP_K}
    """,
)
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return exact_top_k(vectors, F.col("vec_id") % EVERY == 0, TOP_K, SCALE)


@query("op5_licenses")
def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


@query("op6_near_duplicates")
def near_duplicate_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), is_scan=True)


# The turns of conversation -1.
PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


@query(
    "op7_chats",
    r"""
    WITH given AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
      FROM conversations
      UNION ALL
      SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'),
                            (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
    ),
    numbered AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
        replace(replace(replace(replace(replace(replace(replace(text, '\', '\\'),
          '<|im_start|>', '<\|im_start|>'), '<|im_end|>', '<\|im_end|>'), '<s>', '<\s>'),
          '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]') AS body,
        replace(replace(replace(replace(replace(replace(replace(replace(role, '\', '\\'),
          '<|im_start|>', '<\|im_start|>'), '<|im_end|>', '<\|im_end|>'), '<s>', '<\s>'),
          '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'),
          chr(10), '\' || chr(10)) AS head
      FROM given
    )
    SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
      CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), ''))
        AS loss_sha256,
      CAST(sum(12 + length(head) + 1 + length(body) + 10 + 1) AS BIGINT) AS formatted_chars
    FROM numbered GROUP BY conv_id
    """,
)
def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    given = given.unionByName(spark.createDataFrame(PROBE, given.schema))
    written = stage(format_chats(linear_replies(given, "conv_id", "turn", "role", "text")))
    read = read_chats(written)
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learnt = F.array_join("learnt", "")
    return read.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.encode(F.array_join(said, ""), "UTF-8"), 256).alias("turns_sha256"),
        F.char_length(learnt).cast("bigint").alias("loss_chars"),
        F.sha2(F.encode(learnt, "UTF-8"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query(
    "op8_exact_dedup",
    """
    WITH hashed AS (
      SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
      FROM documents
    ),
    groups AS (
      SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size
      FROM hashed GROUP BY text_sha256
    )
    SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
    FROM hashed JOIN groups USING (text_sha256)
    """,
)
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the larger ids first, so that the second one meets digests of the first.

    Of equal texts the first batch's document stays, so it is the one with the largest id.
    """
    docs = table(spark, sf_dir, "documents")
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = 0 if low is None else (low + high) // 2
    later = F.coalesce(F.col("doc_id") > middle, F.lit(False))
    return mark_copies(docs, batches=[later, ~later]).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


@query("op9_sentencepiece")
def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return encode_texts(docs, tokenizer_file("piece_bpe_32k.model"))


SHARDS = 8


@query("op10_hilbert_shards")
def hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    size = (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("bigint")
    layout = write_shards(docs, ["source", "lang", ("size", size)], SHARDS)
    return layout.rows(docs).select(
        "doc_id",
        size.alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


@query("op12_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return count_tokens(docs, tokenizer_file("piece_bpe_32k.model"), limit=4096)


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def manifest_sql(low: int = 8, high: int = 4) -> str:
    """The manifest level by level; levels beyond the last one needed change nothing."""

    def leaf(**changed: str) -> str:
        parts = [
            f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')"
            for v in (changed.get(c, c) for c in FIELDS)
        ]
        return f"sha256({' || '.join(parts)})"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = (
        "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),"
        " lambda c: list_transform(range(8), lambda b: (ord(c) >> b) & 1)))"
    )
    # CRC-32 bit by bit: the polynomial is a fixed value.
    crc = (
        f"xor(list_reduce({bits}, lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)),"
        " 4294967295), 4294967295)"
    )
    steps = [
        f"""docs AS (
          SELECT doc_id, source, {leaf()} AS leaf,
            CASE WHEN {crc} % 5 = 0 THEN {leaf(text=lower)} ELSE {leaf()} END AS given
          FROM documents)""",
        """low0 AS (
          SELECT *, row_number() OVER (
              PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
            count(*) OVER (PARTITION BY source) AS n, leaf AS h
          FROM docs)""",
    ]
    for k in range(low):
        steps += [
            f"""lowruns{k} AS (
              SELECT source, i // 16 AS i, (any_value(n) + 15) // 16 AS n,
                string_agg(h, '' ORDER BY i) AS run
              FROM low{k} WHERE n > 1 GROUP BY source, i // 16)""",
            f"low{k + 1} AS (SELECT source, i, n, sha256(run) AS h FROM lowruns{k})",
        ]
    tops = " UNION ALL ".join(f"SELECT source, h FROM low{k} WHERE n = 1" for k in range(low + 1))
    steps += [
        f"subroots AS ({tops})",
        """high0 AS (
          SELECT *, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i,
            count(*) OVER () AS n
          FROM subroots)""",
    ]
    for k in range(high):
        steps += [
            f"""highruns{k} AS (
              SELECT i // 16 AS i, (any_value(n) + 15) // 16 AS n,
                string_agg(h, '' ORDER BY i) AS run
              FROM high{k} WHERE n > 1 GROUP BY i // 16)""",
            f"high{k + 1} AS (SELECT i, n, sha256(run) AS h FROM highruns{k})",
        ]
    roots = " UNION ALL ".join(f"SELECT h FROM high{k} WHERE n = 1" for k in range(high + 1))
    steps.append(f"root AS ({roots})")
    before = "SELECT l.*, s.h AS subroot, s.i AS place, l.given AS own, '' AS seen"
    steps.append(
        f"way0 AS ({before} FROM low0 l JOIN high0 s ON l.source IS NOT DISTINCT FROM s.source)"
    )
    runs = [(f"lowruns{k}", "l.source IS NOT DISTINCT FROM r.source AND", "i", k) for k in range(low)]
    runs += [(f"highruns{k}", "", "place", k) for k in range(high)]
    for at, (name, same, place, k) in enumerate(runs):
        size = 16**k
        pos = f"64 * ((l.{place} // {size}) % 16)"
        left, right = f"substr(r.run, 1, {pos})", f"substr(r.run, {pos} + 65)"
        steps.append(
            f"""way{at + 1} AS (
              SELECT l.* REPLACE (
                CASE WHEN r.run IS NULL THEN own ELSE sha256({left} || own || {right}) END AS own,
                CASE WHEN r.run IS NULL THEN seen ELSE seen || {left} || {right} END AS seen)
              FROM way{at} l LEFT JOIN {name} r ON {same} l.{place} // {16 * size} = r.i)"""
        )
    return f"""
    WITH {", ".join(steps)}
    SELECT doc_id, leaf, subroot, root.h AS root, sha256(seen) AS proof_sha256,
      own AS folded_root, own = root.h AS verified
    FROM way{len(runs)}, root
    """


@query("op13_merkle_manifest", manifest_sql())
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth document or so is tampered with after the manifest was made."""
    text = F.col("text")
    lowered = F.when(text.isNotNull(), normal_text(text))
    changed = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    leaves = table(spark, sf_dir, "documents").select(
        "doc_id", "source", leaf_digest([F.col(c) for c in FIELDS]).alias("leaf"),
        F.when(changed, leaf_digest([*[F.col(c) for c in FIELDS[:-1]], lowered])).alias("tampered"),
    )
    folded = fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return proofs(build_manifest(leaves)).select(
        "doc_id", "leaf", "subroot", "root", sha256(siblings(F.col("path"))).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query("op11_whitening")
def whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), scale=1024, offset=100_000, components=8)
