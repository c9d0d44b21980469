"""Language identification in two steps: the family first, then the language within it.

A text's features are its letter pairs and triples (bytes of the lower-cased UTF-8 text, everything
that is no letter as one space), hashed to ``FEATURES`` places. The family is the one with the
largest likelihood under a multinomial model of its languages' features. Within the family every
two languages have a linear support vector machine; the language with the most votes wins, then
the one with the larger sum of margins, then the first by name.

Models are fitted on a bounded sample: of each language ``SAMPLE_ROWS`` labelled rows at most, those
with the smallest hash of their id. Features are counted by all executors, each machine is trained
in a task of its own from the rows of its two languages.

Every label is learnt, however many there are. Labels and models are rows of tables; if the models
fit into ``MODEL_BYTES`` they are broadcast and a table is read once, else they are applied block by
block of that size, each in a pass over the table. So time grows with texts times labels, and in a
family with the square of its labels.

A label's family is the one that names it, or else that names its language: the part before the
first ``-`` or ``_`` in lower case, with three-letter codes as two-letter ones (``eng_Latn`` and
``en-GB`` are Germanic like ``en``). Other labels of one language are a family (``zh-Hans`` and
``zh-Hant``); a label without any of these is a family of its own, unless ``families`` names it.

Nulls and edge cases: a null text, or one without a letter, is ``und`` with score 0. Rows with a
null label, text or id are not learnt from; a null id is predicted all the same. Texts are read
whole, of any length. Repeated rows are learnt and predicted each for itself. Without any labelled
row all texts are ``und``; with one language all texts with a letter are of that language. Other
columns are not read, and a prediction depends on the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from tidelake.lake import remove_folders, scratch_path, stage
from tidelake.llm.common import free_name, slices, utf8
from tidelake.operators.joins import join_dimension
from tidelake.operators.numbering import surrogate_key

FEATURES = 1 << 13
SAMPLE_ROWS = 1_000
#: Models of so many bytes are broadcast and applied at once.
MODEL_BYTES = 64 * 1024 * 1024
#: Families whose likelihoods are compared at once.
COMPARED = 16
SLICE_BYTES = 3_000_000
UNKNOWN = "und"

#: Families of closely related languages; a language not named here is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ca", "ro", "gl"),
    "west and south slavic": ("pl", "cs", "sk", "sl", "hr", "bs"),
    "cyrillic slavic": ("ru", "uk", "be", "bg", "sr", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indo-aryan": ("hi", "mr", "ne", "bn", "gu", "pa", "ur"),
    "malay": ("id", "ms"),
}

#: Three-letter codes of the languages above, and of Chinese.
CODES = {
    "eng": "en", "deu": "de", "ger": "de", "nld": "nl", "dut": "nl", "swe": "sv", "dan": "da",
    "nor": "no", "nob": "nb", "nno": "nn", "isl": "is", "ice": "is", "afr": "af", "fra": "fr",
    "fre": "fr", "spa": "es", "ita": "it", "por": "pt", "cat": "ca", "ron": "ro", "rum": "ro",
    "glg": "gl", "pol": "pl", "ces": "cs", "cze": "cs", "slk": "sk", "slo": "sk", "slv": "sl",
    "hrv": "hr", "bos": "bs", "rus": "ru", "ukr": "uk", "bel": "be", "bul": "bg", "srp": "sr",
    "mkd": "mk", "mac": "mk", "fin": "fi", "est": "et", "ekk": "et", "hun": "hu", "tur": "tr",
    "aze": "az", "azj": "az", "kaz": "kk", "uzb": "uz", "uzn": "uz", "hin": "hi", "mar": "mr",
    "nep": "ne", "npi": "ne", "ben": "bn", "guj": "gu", "pan": "pa", "urd": "ur", "ind": "id",
    "msa": "ms", "may": "ms", "zsm": "ms", "zho": "zh", "chi": "zh",
}

# a-z and bytes from 128 on stay, all others become a space.
_LETTERS = np.array([b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The features of the texts, one text after the other, and each text's offset in them."""
    data, at = utf8(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")))
    kept = _LETTERS[data]
    first = np.zeros(len(kept) + 1, bool)
    first[at] = True
    # Of neighbouring spaces one stays, and each text begins with one.
    space = kept == 32
    keep = np.ones(len(kept), bool)
    keep[1:] = ~(space[1:] & space[:-1] & ~first[1:-1])
    lead = np.concatenate([[0], np.cumsum(keep)])[at] + np.arange(len(at))
    out = np.full(int(lead[-1]) + 2, 32, np.uint32)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))[keep]
    out[np.arange(len(owner)) + owner + 1] = kept[keep]
    pair = (out[:-2] << 8) | out[1:-1]
    triple = (pair << 8) | out[2:]
    factor, shift = np.uint32(0x9E3779B1), np.uint32(32 - FEATURES.bit_length() + 1)
    both = np.empty(2 * len(pair), np.uint16)
    both[0::2] = ((pair + np.uint32(1 << 24)) * factor) >> shift
    both[1::2] = (triple * factor) >> shift
    # The last letters' pair and triple reach into the next text's leading space: an end mark.
    return both, 2 * lead


def has_letter(texts: pa.Array) -> np.ndarray:
    found = pc.fill_null(pc.match_substring_regex(texts.cast(pa.large_string()), "[A-Za-z]"), False)
    found = found.to_numpy(zero_copy_only=False).copy()
    for i in np.flatnonzero(~found).tolist():
        found[i] = any(c.isalpha() for c in texts[i].as_py() or "")
    return found


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return upto[at[1:]] - upto[at[:-1]]


def train_pair(x: np.ndarray, y: np.ndarray, rounds: int = 30, cost: float = 1.0) -> np.ndarray:
    """Weights and bias of a linear machine with squared hinge loss, by dual coordinate descent."""
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)
    alpha, weights = np.zeros(len(x)), np.zeros(x.shape[1])
    diagonal = 0.5 / cost
    square = np.einsum("ij,ij->i", x, x) + diagonal
    order = np.random.default_rng(0)
    for _ in range(rounds):
        for i in order.permutation(len(x)):
            slope = y[i] * (x[i] @ weights) - 1 + diagonal * alpha[i]
            new = max(alpha[i] - slope / square[i], 0.0)
            if new != alpha[i]:
                weights += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return weights


def _counts(rows: pd.DataFrame) -> np.ndarray:
    x = np.zeros((len(rows), FEATURES), np.float32)
    for i, (place, count) in enumerate(zip(rows["place"], rows["n"], strict=True)):
        x[i, place] = count
    return x


def _train(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Weights of one model: feature counts of a language, or the machine of two."""
    family, one, two = key
    rows = rows.sort_values(["lang", "draw", "size"], kind="stable")
    x = _counts(rows)
    x /= np.maximum(x.sum(axis=1, keepdims=True), 1)
    if two < 0:
        weights = x.sum(axis=0, dtype=np.float64)
    else:
        scale = 1 / np.sqrt(x.mean(axis=0) + 1e-6)
        y = np.where(rows["own"].to_numpy() == one, 1.0, -1.0)
        weights = train_pair(x * scale, y)
        weights[:-1] *= scale
    return pd.DataFrame(
        {
            "family": [family], "one": [one], "two": [two],
            "languages": [[rows["lang"].iloc[0]] if two < 0 else None],
            "weights": [weights.astype("<f8").tobytes()],
        }
    )


def _likelihood(rows: pd.DataFrame) -> pd.DataFrame:
    """Log likelihood of each feature in a family, and the family's languages in order."""
    rows = rows.sort_values("one", kind="stable")
    usage = np.sum([np.frombuffer(w, "<f8") for w in rows["weights"]], axis=0)
    usage = usage / usage.sum() + 1e-6
    return pd.DataFrame(
        {
            "family": [rows["family"].iloc[0]], "one": [-1], "two": [-1],
            "languages": [[own[0] for own in rows["languages"]]],
            "weights": [np.log(usage / usage.sum()).astype("<f8").tobytes()],
        }
    )


#: What is known of a row between two blocks: the family so far, the language so far, the family's
#: mean likelihood, the odds of all families against it, the chance of the language within it, and,
#: in the midst of a family's machines, each language's votes, margins and chances.
STATE = StructType(
    [StructField(c, StringType()) for c in ("family", "lang")]
    + [StructField(c, DoubleType()) for c in ("best", "odds", "sure")]
    + [StructField(c, ArrayType(DoubleType())) for c in ("votes", "margins", "chances")]
)


class _State:
    """``STATE`` of some rows, as columns."""

    def __init__(self, rows: int):
        self.family, self.lang = np.full(rows, None, object), np.full(rows, None, object)
        self.best, self.odds, self.sure = np.full(rows, -np.inf), np.zeros(rows), np.ones(rows)
        self.votes, self.margins, self.chances = (np.full(rows, None, object) for _ in range(3))

    @classmethod
    def of(cls, column: pa.StructArray) -> _State:
        state = cls(len(column))
        for name, values in zip(STATE.names, column.flatten(), strict=True):
            if name in ("best", "odds", "sure"):
                setattr(state, name, values.to_numpy(zero_copy_only=False).copy())
            else:
                getattr(state, name)[:] = pd.Series(values.to_pylist(), dtype=object)
        return state

    def column(self) -> pa.StructArray:
        kinds = [pa.string()] * 2 + [pa.float64()] * 3 + [pa.list_(pa.float64())] * 3
        return pa.StructArray.from_arrays(
            [pa.array(list(getattr(self, n)), k) for n, k in zip(STATE.names, kinds, strict=True)],
            STATE.names,
        )


@dataclass(frozen=True)
class Block:
    """Some of the models: families with their likelihoods, then machines by family."""

    families: list[tuple[str, str, np.ndarray]]  # name, first language, likelihood
    machines: dict[str, list[tuple[int, int, np.ndarray]]]
    languages: dict[str, list[str]]  # of the families that have machines here

    def apply(self, texts: pa.Array, state: _State) -> None:
        """Compare these families with the best so far, then let these machines vote."""
        place, at = features(texts)
        n = np.maximum(np.diff(at), 1)
        # The odds of a whole text are far too sure: neighbouring features depend on each other.
        most = np.minimum(n, 60)
        for i in range(0, len(self.families), COMPARED):
            some = self.families[i : i + COMPARED]
            mean = np.stack([_sums(own[place], at) / n for _, _, own in some])
            best = np.maximum(state.best, mean.max(axis=0))
            state.odds *= np.exp((state.best - best) * most)
            state.odds += np.exp((mean - best) * most).sum(axis=0)
            won = np.flatnonzero(best > state.best)
            chosen = mean.argmax(axis=0)[won]
            state.family[won] = np.array([f[0] for f in some], object)[chosen]
            state.lang[won] = np.array([f[1] for f in some], object)[chosen]
            state.best = best
        for family, machines in self.machines.items():
            own = np.flatnonzero(state.family == family)
            if len(own):
                self._vote(family, machines, own, place, at, n, state)

    def _vote(
        self, family: str, machines: list[tuple[int, int, np.ndarray]], own: np.ndarray,
        place: np.ndarray, at: np.ndarray, n: np.ndarray, state: _State,
    ) -> None:
        languages = self.languages[family]
        if machines[0][:2] == (0, 1):
            votes = np.zeros((len(languages), len(own)))
            margins, sure = np.zeros_like(votes), np.ones_like(votes)
        else:
            held = (state.votes, state.margins, state.chances)
            votes, margins, sure = (np.array(h[own].tolist(), np.float64).T.copy() for h in held)
        for a, b, weights in machines:
            margin = (_sums(weights[place], at) / n)[own] + weights[-1]
            votes[a] += margin >= 0
            votes[b] += margin < 0
            margins[a] += margin
            margins[b] -= margin
            chance = 1 / (1 + np.exp(-4 * np.clip(margin, -50, 50)))
            sure[a], sure[b] = np.minimum(sure[a], chance), np.minimum(sure[b], 1 - chance)
        if machines[-1][:2] == (len(languages) - 2, len(languages) - 1):
            order = votes + np.tanh(margins / 1e3) / 2  # margins only part equal votes
            winner = order.argmax(axis=0)
            state.lang[own] = np.array(languages, dtype=object)[winner]
            state.sure[own] = sure[winner, np.arange(len(own))]
            votes = margins = sure = None
        for held, values in ((state.votes, votes), (state.margins, margins), (state.chances, sure)):
            for i, row in enumerate(own.tolist()):
                held[row] = None if values is None else values[:, i].tolist()


def _found(texts: pa.Array, state: _State) -> tuple[list[str], np.ndarray]:
    """The languages and scores of texts to which all models were applied."""
    lang, known = state.lang.copy(), has_letter(texts)
    score = np.zeros(len(texts))
    known &= state.odds > 0  # without any model nothing is known
    lang[~known] = UNKNOWN
    score[known] = state.sure[known] / state.odds[known]
    return lang.tolist(), np.clip(score, 0.0, 1.0)


@dataclass(frozen=True)
class Models:
    """Rows of models, ``vectors`` of them, each of ``FEATURES`` weights; numbered if many.

    A family's row has its languages and no machine (``two`` is -1); the others are the machines of
    the languages at the places ``one`` and ``two`` of their family.
    """

    rows: DataFrame | None
    vectors: int = 0

    @classmethod
    def of(cls, rows: DataFrame) -> Models:
        vectors = rows.count()
        if vectors > _block_vectors():
            order = ["machine", "family", "one", "two"]
            rows = rows.withColumn("machine", F.col("two") >= 0)
            rows = stage(surrogate_key(rows, "number", order, unique=True))
        return cls(rows, vectors)

    def blocks(self) -> Iterator[Block]:
        """The models in their order, families first; one block if they are few, even none."""
        step = _block_vectors()
        if self.vectors <= step:
            yield self._block(self.rows.collect() if self.rows is not None else [])
            return
        for i in range(0, self.vectors, step):
            yield self._block(self.rows.filter(F.col("number").between(i + 1, i + step)).collect())

    def _block(self, rows: list) -> Block:
        rows = sorted(rows, key=lambda r: (r.two >= 0, r.family, r.one, r.two))
        machines: dict[str, list[tuple[int, int, np.ndarray]]] = {}
        families, languages = [], {}
        for r in rows:
            weights = np.frombuffer(bytes(r.weights), "<f8")
            if r.two >= 0:
                machines.setdefault(r.family, []).append((r.one, r.two, weights))
            else:
                families.append((r.family, r.languages[0], weights))
                languages[r.family] = r.languages
        missing = sorted(set(machines) - set(languages))
        if missing:
            named = self.rows.filter((F.col("two") < 0) & F.col("family").isin(missing))
            languages |= {r.family: r.languages for r in named.select("family", "languages").collect()}
        return Block(families, machines, {f: languages[f] for f in machines})


def _block_vectors() -> int:
    return max(1, MODEL_BYTES // (8 * FEATURES))


def _families(families: Mapping[str, tuple[str, ...]]) -> Column:
    """The family of a label ``lang``."""

    def looked_up(key: Column, values: Mapping[str, str]) -> Column:
        if not values:
            return F.lit(None).cast("string")
        return F.create_map(*[F.lit(v) for pair in values.items() for v in pair])[key]

    named = {lang: name for name, own in families.items() for lang in own}
    code = F.lower(F.element_at(F.split("lang", "[-_]"), 1))
    code = F.coalesce(looked_up(code, CODES), code)
    return F.coalesce(
        looked_up(F.col("lang"), named), looked_up(code, named), F.concat(F.lit("only "), code)
    )


def fit(
    labelled: DataFrame, families: Mapping[str, tuple[str, ...]] = FAMILIES,
    sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang",
) -> Models:
    """Fit on at most ``sample_rows`` rows of each language; every language is learnt."""
    rows = labelled.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).filter("id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    labels = stage(
        rows.groupBy("lang").agg(F.count("*").alias("n")).withColumn("family", _families(families))
        .withColumn("own", F.row_number().over(Window.partitionBy("family").orderBy("lang")) - 1)
    )
    if labels.isEmpty():
        return Models(None)

    # About one and a half times the sample passes the first filter, so no task sees much more.
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(7), "id"), 11) / F.lit(2.0**53)
    part = 1.5 * sample_rows / F.col("n") + 1e-9
    bounds = labels.withColumn("part", part).filter("part < 1")
    place = Window.partitionBy("lang").orderBy("draw", "id", F.xxhash64("text"))
    sample = (
        join_dimension(
            rows.withColumn("draw", draw), bounds, F.col("lang"), "lang", {"part": "part"},
            how="left", fact_is_table=True,
        )
        .filter(F.col("draw") < F.coalesce("part", F.lit(1.0)))
        .withColumn("number", F.row_number().over(place)).filter(F.col("number") <= sample_rows)
        .select("lang", "draw", "text")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            place, at = features(batch.column("text"))
            found = [np.unique(place[a:b], return_counts=True) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang"), batch.column("draw"),
                    pa.array(np.diff(at).astype(np.int64)),
                    pa.array([p.astype(np.int32) for p, _ in found], pa.list_(pa.int32())),
                    pa.array([n.astype(np.int32) for _, n in found], pa.list_(pa.int32())),
                ],
                ["lang", "draw", "size", "place", "n"],
            )

    counts = stage(
        sample.mapInArrow(
            count, "lang string, draw double, size bigint, place array<int>, n array<int>"
        )
    )
    # Each language has a model of its own, and one with each other language of its family.
    other = labels.select("family", F.col("own").alias("other"))
    pairs = labels.join(other, "family").select(
        "lang", "family", "own", F.least("own", "other").alias("one"),
        F.when(F.col("own") == F.col("other"), -1).otherwise(F.greatest("own", "other")).alias("two"),
    )
    take = {c: c for c in ("family", "own", "one", "two")}
    schema = "family string, one int, two int, languages array<string>, weights binary"
    trained = stage(
        join_dimension(counts, stage(pairs), F.col("lang"), "lang", take, fact_is_table=True)
        .groupBy("family", "one", "two").applyInPandas(_train, schema)
    )
    likelihood = trained.filter("two < 0").groupBy("family").applyInPandas(_likelihood, schema)
    return Models.of(stage(likelihood.unionByName(trained.filter("two >= 0"))))


def _in_passes(df: DataFrame, models: Models, text_col: str, state: str) -> DataFrame:
    """``df`` with the column ``state`` after all models, each block applied in a pass."""
    spark = df.sparkSession
    kind = StructType([*df.schema.fields, StructField(state, STATE)])
    last = None
    for block in models.blocks():
        shared, first = spark.sparkContext.broadcast(block), last is None

        def run(
            batches: Iterator[pa.RecordBatch], shared=shared, first=first
        ) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, text_col, SLICE_BYTES):
                held = _State(batch.num_rows) if first else _State.of(batch.column(state))
                shared.value.apply(batch.column(text_col), held)
                columns = batch.columns if first else batch.columns[:-1]
                yield pa.RecordBatch.from_arrays([*columns, held.column()], kind.names)

        path = scratch_path(spark)
        df = stage(df.mapInArrow(run, kind), path)
        shared.destroy()
        if last:
            remove_folders(spark, [last])
        last = path
    return df


def _apply(
    df: DataFrame, models: Models, text_col: str, schema: StructType | str, make
) -> DataFrame:
    """``make`` of each batch of ``df`` with its texts' languages and scores; no shuffle."""
    state = free_name(df, "_state")
    many = models.vectors > _block_vectors()
    if many:
        df = _in_passes(df, models, text_col, state)
    shared = df.sparkSession.sparkContext.broadcast(None if many else next(models.blocks()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, SLICE_BYTES):
            texts = batch.column(text_col)
            held = _State.of(batch.column(state)) if many else _State(batch.num_rows)
            if many:
                batch = batch.drop_columns([state])
            else:
                shared.value.apply(texts, held)
            yield make(batch, *_found(texts, held))

    return df.mapInArrow(run, schema)


def predict(
    df: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The id, lang_pred and score of every row; no shuffle."""
    chosen = df.select(id_col, F.col(text_col).alias("_text"))
    kind = chosen.schema[id_col].dataType.simpleString()

    def make(batch: pa.RecordBatch, lang: list[str], score: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
            [id_col, "lang_pred", "score"],
        )

    return _apply(chosen, models, "_text", f"`{id_col}` {kind}, lang_pred string, score double", make)


def held_out(id_col: str = "doc_id") -> Column:
    """The fold of rows that are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def identify(df: DataFrame, families: Mapping[str, tuple[str, ...]] = FAMILIES) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, learnt from the other folds."""
    models = fit(df.filter(~held_out()), families)
    return predict(df, models).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def known_language(
    df: DataFrame, families: Mapping[str, tuple[str, ...]] = FAMILIES
) -> DataFrame:
    """The rows of ``df`` whose language is found, with all their columns."""
    models = fit(df.filter(~held_out()), families)

    def make(batch: pa.RecordBatch, lang: list[str], score: np.ndarray) -> pa.RecordBatch:
        return batch.filter(pa.array([found != UNKNOWN for found in lang]))

    return _apply(df, models, "text", df.schema, make)
