"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

Features are densities of lexicon words (stated ones and ones learned from labelled texts), how near they stand to the
second person, and rates of capitals, punctuation and obfuscation. Nothing but the text makes a feature.

The model is fitted on at most ``TRAIN_ROWS`` labelled documents, chosen by a hash of their id. Everything else
covers all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsift.llm.common import fresh, slices, text_buffers
from reelsift.session import durable

TRAIN_ROWS = 20_000
LEXICON_SIZE = 1_000
#: A learned word stands in this many toxic texts at least, and this many standard deviations above chance.
LEAST_TOXIC, LEAST_DEVIATIONS = 3, 6.5
THRESHOLD = 0.3
NEAR_WORDS = 5
TREES, DEPTH, STEP = 25, 3, 0.2

LEXICON = tuple(
    """idiot idiots moron morons stupid dumb fool loser losers scum trash garbage worthless pathetic disgusting clown
    imbecile cretin jerk bastard hate kill
    idiote imbécile crétin connard salaud débile ordure minable
    dumm dummkopf idiotisch trottel arschloch abschaum wertlos
    idiota estúpido imbécil basura asqueroso patético inútil""".split()
)
SECOND_PERSON = tuple(
    "you your yours yourself u ur tu toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer te ti usted ustedes vosotros".split()
)
FEATURES = (
    "log_words", "stated_density", "learned_density", "any_density", "distinct_hits", "near_second_person", "second_person_density",
    "hidden_density", "obfuscated_rate", "stretched_rate", "capitals_rate", "capital_words_rate", "exclamation_rate", "punctuation_rate", "symbol_rate", "digit_rate",
)

_TO_SPACE = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
_DECODED = bytes.maketrans(b"013457@$!", b"oieastasi")
_OBFUSCATED = re.compile(rb"[A-Za-z][0-9@$*]+[A-Za-z]")
_STRETCHED = re.compile(rb"([A-Za-z])\1\1")
_CAPITAL_WORD = re.compile(rb"\b[A-Z]{2,}\b")


def _classes() -> np.ndarray:
    kinds = np.zeros((256, 6), np.int32)
    for c in range(128):
        ch = chr(c)
        kinds[c] = (ch.isupper(), ch.isalpha(), ch == "!" or ch == "?", ch in ".,;:'\"()-", not ch.isalnum() and ch not in ".,;:'\"()-!? \t\n\r\v\f", ch.isdigit())
    return kinds


_KINDS = _classes()


def feature_matrix(texts: pa.Array, learned: frozenset[bytes]) -> np.ndarray:
    """One row of ``FEATURES`` per text; a null is an empty text, whose features are all 0."""
    data, offsets = text_buffers(texts)
    stated, second = frozenset(w.encode() for w in LEXICON), frozenset(w.encode() for w in SECOND_PERSON)
    every = stated | learned
    counts = np.zeros((len(texts), 6))
    for k in range(6):
        sums = np.concatenate(([0], np.cumsum(_KINDS[data, k])))
        counts[:, k] = sums[offsets[1:]] - sums[offsets[:-1]]
    out = np.zeros((len(texts), len(FEATURES)))
    whole = data.tobytes()
    for i in range(len(texts)):
        raw = whole[offsets[i] : offsets[i + 1]]
        lower = raw.decode().lower().encode()
        words = lower.translate(_TO_SPACE).split()
        if not words:
            continue
        n, size = len(words), len(raw)
        there = set(words)
        hits = there & every
        at = [k for k, w in enumerate(words) if w in hits] if hits else []
        n_stated = sum(words[k] in stated for k in at)
        n_learned = sum(words[k] in learned for k in at)
        you = there & second
        near = sum(not second.isdisjoint(words[max(0, k - NEAR_WORDS) : k + NEAR_WORDS + 1]) for k in at) if you else 0
        odd = _OBFUSCATED.findall(lower)
        hidden = 0
        if odd:
            plain = lower.translate(_DECODED, b"*._-").translate(_TO_SPACE).split()
            hidden = max(0, sum(w in every for w in plain) - len(at))
        upper, letters, shout, marks, symbols, digits = counts[i]
        out[i] = (
            np.log1p(n), n_stated / n, n_learned / n, len(at) / n, min(len(hits), 10), near / max(len(at), 1),
            sum(w in second for w in words) / n if you else 0.0, hidden / n, len(odd) / n, len(_STRETCHED.findall(raw)) / n,
            upper / max(letters, 1), len(_CAPITAL_WORD.findall(raw)) / n if upper else 0.0, shout / size, marks / size, symbols / size, digits / size,
        )
    return out


def with_features(docs: DataFrame, learned: list[str], keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` and ``_features``, an array in the order of ``FEATURES``."""
    known = frozenset(w.encode() for w in learned)
    inner = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(keep)]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            values = feature_matrix(part.column("_text"), known)
            at = pa.array(np.arange(0, values.size + 1, len(FEATURES), dtype=np.int32))
            lists = pa.ListArray.from_arrays(at, pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([part.column(k) for k in range(len(keep))] + [lists], [*(f"c{k}" for k in range(len(keep))), "_features"])

    rows = docs.select(*inner, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    kinds = [f"c{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(keep)]
    measured = rows.mapInArrow(measure, ", ".join([*kinds, "_features array<double>"]))
    return measured.toDF(*keep, "_features")


def id_remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; -1 without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4, F.lit(-1))


def learned_words(texts: DataFrame, size: int = LEXICON_SIZE) -> list[str]:
    """Words of ``texts`` (``text, label``) that stand in toxic ones far more often than chance allows, most telling first."""
    words = F.explode(F.array_distinct(F.split(F.lower("text"), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")))
    n, toxic = (texts.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()) if texts is not None else (0, 0)
    if not 0 < toxic < n:
        return []
    p = toxic / n
    told = texts.select(words.alias("word"), "label").where("word != ''").groupBy("word").agg(F.count("*").alias("n"), F.sum("label").alias("t"))
    deviations = (F.col("t") - F.col("n") * p) / F.sqrt(F.col("n") * p * (1 - p))
    best = told.where(F.col("t") >= LEAST_TOXIC).select("word", deviations.alias("z")).where(F.col("z") >= LEAST_DEVIATIONS)
    return [r.word for r in best.orderBy(F.desc("z"), "word").limit(size).collect()]


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: list[str]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    prior: float

    def scores(self, docs: DataFrame, keep: list[str], name: str = "score") -> DataFrame:
        """``keep`` columns of every row of ``docs`` and ``name``, the calibrated probability of label 1."""
        inner = [f"_kept{k}" for k in range(len(keep))]  # so that no kept column is called as the model's own are
        rows = with_features(docs, self.lexicon, keep).toDF(*inner, "_features")
        kept = [F.col(i).alias(c) for i, c in zip(inner, keep, strict=True)]
        if self.trees is None:
            return rows.select(*kept, F.lit(self.prior).alias(name))
        raw = self.trees.transform(rows.withColumn("_features", array_to_vector("_features")))
        scored = self.calibration.transform(raw.withColumn("_raw", vector_to_array("probability")[1]).select(*inner, "_raw"))
        return scored.select(*kept, F.greatest(F.least("_score", F.lit(1.0)), F.lit(0.0)).alias(name))


def train_toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, trees: int = TREES) -> ToxicityModel:
    """Fit on the labelled documents whose id's crc32 is not 2 modulo 4; ``rows`` bounds how many.

    Rows without an id or a label are left out, a document with several labels has the highest. The learned words that
    measure a training text come from the other half of the training texts, those that measure new texts from all.
    With no labelled rows, or one class only, every score is the share of label 1.
    """
    known = labels.where((id_remainder(F.col("doc_id")) != 2) & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("double")).alias("label"))
    chosen = known.orderBy(F.xxhash64(F.lit(1), "doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")  # `rows` rows at most
    texts = durable(texts.withColumn("_half", F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.lit(2))).withColumn("_fifth", F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(5))).repartition(8, "doc_id"))
    n, toxic = texts.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    halves = [texts.where(F.col("_half") == k) for k in (0, 1)]
    lexicon = learned_words(texts)
    if not 0 < toxic < n:
        return ToxicityModel(lexicon, None, None, float(toxic / n) if n else 0.0)
    parts = [with_features(halves[k], learned_words(halves[1 - k]), ["label", "_fifth"]) for k in (0, 1)]
    measured = durable(parts[0].unionByName(parts[1]))
    rows_in = measured.withColumn("_features", array_to_vector("_features"))
    booster = GBTClassifier(featuresCol="_features", labelCol="label", maxIter=trees, maxDepth=DEPTH, stepSize=STEP, minInstancesPerNode=5, maxBins=64, seed=1)
    fitted, held = rows_in.where("_fifth != 0"), rows_in.where("_fifth = 0")
    if fitted.agg(F.countDistinct("label")).first()[0] < 2 or held.agg(F.countDistinct("label")).first()[0] < 2:
        fitted = held = rows_in
    model = booster.fit(fitted)
    raw = model.transform(held).select("label", vector_to_array("probability")[1].alias("_raw"))
    calibration = IsotonicRegression(featuresCol="_raw", labelCol="label", predictionCol="_score").fit(raw)
    return ToxicityModel(lexicon, model, calibration, float(toxic / n))


def score_toxicity(docs: DataFrame, labels: DataFrame, keep: list[str], rows: int = TRAIN_ROWS) -> DataFrame:
    """Every row of ``docs`` with its ``keep`` columns, ``score`` and ``predicted`` (1 from ``THRESHOLD`` on).

    Null and empty texts are scored as texts without words; repeated rows get equal scores; an empty table gives none.
    """
    scored = train_toxicity(docs, labels, rows).scores(docs, keep)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their columns, whatever these are called."""
    score = fresh(docs, "score")
    scored = train_toxicity(docs, labels, rows).scores(docs, docs.columns, score)
    return scored.where(F.col(score) < THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])
