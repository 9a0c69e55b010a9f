"""Toxicity: boosted trees over dense features of a text, with isotonic calibration.

The lexicon is learned: words and word beginnings that are much more frequent in texts marked toxic.
Training uses a bounded sample of labelled rows; scoring is one pass over the texts without a
shuffle, and the trees and the calibration are applied by the ML library's own expressions.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagemill.llm.common import drop_cache, id_crc32, labelled_sample, text_list, worker_cache
from passagemill.llm.tokenizing import PieceCache, batches_of
from passagemill.session import stage

#: At most about so many labelled rows are learned from; they are chosen by a hash of their key.
LABELLED_ROWS = 20_000

#: Texts that a worker holds as strings at once.
PART_ROWS = 1_000

#: Texts score at least this much to be predicted toxic.
THRESHOLD = 0.3

#: A term enters the lexicon if so many toxic texts hold it, this much more often than others.
MIN_TEXTS = 4
MIN_ODDS = 12.0

#: Lengths of word beginnings that are terms besides the word itself.
BEGINNINGS = (3, 4, 5, 6)

#: How near to a second-person word a lexicon word must be to count as addressed.
NEAR = 5

#: The calibrated share counts this much, the rest is the trees' own probability, which keeps order
#: among texts of one calibrated step.
CALIBRATED = 0.95

FEATURES = (
    "hits",
    "hit_density",
    "weight_density",
    "greatest_weight",
    "distinct_hits",
    "addressed_density",
    "second_person",
    "capitals",
    "shouted",
    "exclamations",
    "mixed_signs",
    "repeated_signs",
    "spaced_letters",
    "length",
)

SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine deiner "
    "ihr euch euer eure tú usted ustedes vosotros ti tus vuestro vuestra".split()
)

_LOOKALIKE = str.maketrans("013457@$!", "oieastasi")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_INSIDE = re.compile(r"[\W_]+")
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_SHOUTED = re.compile(r"(?<!\S)[A-ZÀ-ÖØ-Þ]{3,}(?![^\s!?.,;:])")
_MIXED = re.compile(r"[^\W\d_][0-9@$*#!]+[^\W\d_]")
_REPEATED = re.compile(r"([^\W\d_!?])\1\1")
_SPACED = re.compile(r"(?<!\S)[^\W\d_](?:[ .\-_*][^\W\d_]){3,}(?!\S)")


def plain_word(word: str) -> str:
    """A word as the lexicon knows it: lower case, without signs around or inside, digits and signs
    that stand for letters read as those letters."""
    word = _EDGES.sub("", word.lower())
    if word.isalpha():
        return word
    if any(sign.isalpha() for sign in word):
        word = word.translate(_LOOKALIKE)
    return _INSIDE.sub("", word)


def terms_of(word: str) -> list[str]:
    """The word and its beginnings; ``=`` marks the whole word."""
    word = plain_word(word)
    if not word:
        return []
    return ["=" + word, *(word[:size] for size in BEGINNINGS if len(word) >= size)]


class Lexicon(NamedTuple):
    """Texts per class in which each term occurs, and texts per class."""

    terms: dict[str, tuple[int, int]]
    toxic: int
    clean: int

    def weight(self, term: str, label: int | None = None) -> float:
        """Log-odds of a term, 0 unless it speaks clearly for toxic.

        With ``label`` the text itself is left out of the counts: a learned text must not know its
        own label.
        """
        if term not in self.terms:
            return 0.0
        with_toxic, with_clean = self.terms[term]
        toxic, clean = self.toxic, self.clean
        if label == 1:
            with_toxic, toxic = with_toxic - 1, toxic - 1
        elif label == 0:
            with_clean, clean = max(with_clean - 1, 0), clean - 1
        if with_toxic < MIN_TEXTS:
            return 0.0
        odds = ((with_toxic + 0.5) / (toxic + 1)) / ((with_clean + 0.5) / (clean + 1))
        return math.log(odds) if odds >= MIN_ODDS else 0.0

    def word_weight(self, word: str, label: int | None = None) -> float:
        return max((self.weight(term, label) for term in terms_of(word)), default=0.0)

    def digest(self) -> str:
        return hashlib.md5(repr(sorted(self.terms.items())).encode()).hexdigest()


def features_of(text: str, words: list[str], weights: list[float]) -> list[float]:
    """The dense features of one text, in the order of ``FEATURES``."""
    n_words = max(len(words), 1)
    n_signs = max(len(text), 1)
    hits = [at for at, weight in enumerate(weights) if weight]
    second = [at for at, word in enumerate(words) if word in SECOND_PERSON]
    addressed = 0
    if hits and second:
        places, at = np.array(second), np.array(hits)
        right = np.minimum(np.searchsorted(places, at), len(places) - 1)
        left = np.maximum(right - 1, 0)
        gap = np.minimum(np.abs(places[right] - at), np.abs(places[left] - at))
        addressed = int((gap <= NEAR).sum())
    return [
        math.log1p(len(hits)),
        len(hits) / n_words,
        sum(weights) / n_words,
        max(weights, default=0.0),
        math.log1p(len({words[at] for at in hits})),
        addressed / n_words,
        len(second) / n_words,
        len(_CAPITAL.findall(text)) / n_signs,
        len(_SHOUTED.findall(text)) / n_words,
        (text.count("!") + text.count("?")) / n_words,
        len(_MIXED.findall(text)) / n_words,
        len(_REPEATED.findall(text)) / n_words,
        len(_SPACED.findall(text)) / n_words,
        math.log1p(len(words)),
    ]


def _distinct_terms(text: str) -> set[str]:
    return {term for word in set(text.split()) for term in terms_of(word)}


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Count the terms of both classes over the learned sample ``text, toxic``.

    All terms are counted and held against the odds where they lie; only those that speak for toxic, with or
    without the text itself, reach the driver.
    """

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counters: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(text_list(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                counters[toxic].update(_distinct_terms(text))
            for toxic, counter in enumerate(counters):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(counter), pa.string()),
                        pa.array(list(counter.values() if toxic else [0] * len(counter)), pa.int64()),
                        pa.array(list([0] * len(counter) if toxic else counter.values()), pa.int64()),
                    ],
                    ["term", "toxic", "clean"],
                )

    counts = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = counts.get(1, 0), counts.get(0, 0)
    # the most that a term's odds can be: a clean text that holds it is left out
    others = F.greatest(F.col("clean") - 1, F.lit(0))
    odds = ((F.col("toxic") + 0.5) / (n_toxic + 1)) / ((others + 0.5) / (n_clean + 1))
    found = (
        sample.select("text", "toxic")
        .mapInArrow(terms, "term string, toxic long, clean long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((F.col("toxic") >= MIN_TEXTS) & (odds >= 0.99 * MIN_ODDS))
    )
    lexicon = Lexicon(
        {row["term"]: (row["toxic"], row["clean"]) for row in found.collect()}, n_toxic, n_clean
    )
    return lexicon._replace(
        terms={
            term: both
            for term, both in lexicon.terms.items()
            if lexicon.weight(term) or lexicon.weight(term, 0)
        }
    )


def with_features(rows: DataFrame, lexicon: Lexicon, learned: bool = False) -> DataFrame:
    """``text`` replaced by ``features``; with ``learned``, column ``toxic`` is left out of the
    lexicon's counts for its own row."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)
    digest = lexicon.digest()
    kept = [name for name in rows.columns if name != "text"]

    def vectors(texts: list[str], labels: Iterable) -> Iterator[list[float]]:
        known = shared.value
        # a learned text is left out of the counts later; as one of the others it weighs most
        assumed = 0 if learned else None
        cache = worker_cache("toxicity", (digest, assumed)).setdefault("words", PieceCache())
        for begin, end in batches_of(texts):
            cut = [text.lower().split() for text in texts[begin:end]]
            cache.fill(
                set().union(*cut),
                lambda missing: [known.word_weight(word, assumed) for word in missing],
            )
            for text, words, label in zip(texts[begin:end], cut, labels[begin:end], strict=True):
                weights = [cache[word] for word in words]
                if learned:
                    weights = [
                        weight and known.word_weight(word, label)
                        for word, weight in zip(words, weights, strict=True)
                    ]
                yield features_of(text, words, weights)

    def parts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        return (batch.slice(begin, PART_ROWS) for begin in range(0, batch.num_rows, PART_ROWS))

    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in parts_of(whole)):
            texts = text_list(batch.column("text"))
            labels = batch.column("toxic").to_pylist() if learned else [None] * len(texts)
            found = pa.array(list(vectors(texts, labels)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in kept), found], [*kept, "features"]
            )
        # Spark takes its idle workers in turn: each of them would keep a cache
        drop_cache()

    fields = [field for field in rows.schema.fields if field.name != "text"]
    schema = T.StructType([*fields, T.StructField("features", T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(computed, schema).withColumn("features", array_to_vector("features"))


class ToxicityModel(NamedTuple):
    """Lexicon, trees and calibration; without trees, every text scores ``share``."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    share: float

    def score(self, rows: DataFrame) -> DataFrame:
        """``row, text`` to ``row, score``."""
        if self.trees is None:
            return rows.select("row", F.lit(self.share).alias("score"))
        scored = _probability(self.trees.transform(with_features(rows, self.lexicon)))
        score = F.col("probability")
        if self.calibration is not None:
            scored = self.calibration.transform(scored)
            score = CALIBRATED * F.col("calibrated") + (1 - CALIBRATED) * score
        return scored.select("row", F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)).alias("score"))


def _probability(scored: DataFrame) -> DataFrame:
    return scored.withColumn("probability", F.get(vector_to_array("probability"), F.lit(1)))


def learned_rows(documents: DataFrame, labels: DataFrame, limit: int = LABELLED_ROWS) -> DataFrame:
    """``doc_id, text, toxic`` of the sample that is learned from, and its ``fold``.

    Rows whose key has CRC-32 remainder 2 by 4 are never learned from. The chosen labels have a
    bounded count, so that the documents are not shuffled to find their texts.
    """
    marked = labels.where(F.col("toxic").isin(0, 1) & (id_crc32(F.col("doc_id")) % 4 != 2)).select(
        "doc_id", F.col("toxic").cast("int").alias("toxic")
    )
    sample = labelled_sample(documents, marked, "toxic", limit)
    return sample.withColumn("fold", id_crc32(F.col("doc_id")) % 4)


def fit_toxicity(documents: DataFrame, labels: DataFrame, limit: int = LABELLED_ROWS) -> ToxicityModel:
    """Learn from ``labels(doc_id, toxic)`` of at most about ``limit`` rows.

    The lexicon uses all of the sample, the trees its folds 0 and 1, the calibration its fold 3.
    If the sample lacks one of the classes, the model scores every text with the share of toxic.
    """
    sample = stage(learned_rows(documents, labels, limit), "toxicity-sample")
    lexicon = learn_lexicon(sample)
    total = lexicon.toxic + lexicon.clean
    share = lexicon.toxic / total if total else 0.0
    if not lexicon.toxic or not lexicon.clean:
        return ToxicityModel(lexicon, None, None, share)
    vectors = with_features(
        sample.select("text", "toxic", "fold"), lexicon, learned=True
    ).withColumn("label", F.col("toxic").cast("double"))
    stored = stage(vectors.withColumn("features", vector_to_array("features")), "toxicity-features")
    stored = stored.withColumn("features", array_to_vector("features"))
    parts = {
        fold: {row["toxic"] for row in stored.where(where).select("toxic").distinct().collect()}
        for fold, where in (("trees", "fold <> 3"), ("calibration", "fold = 3"))
    }
    if len(parts["trees"]) < 2:
        return ToxicityModel(lexicon, None, None, share)
    trees = GBTClassifier(maxDepth=3, maxIter=20, stepSize=0.3, minInstancesPerNode=5, seed=1).fit(
        stored.where("fold <> 3")
    )
    if len(parts["calibration"]) < 2:
        return ToxicityModel(lexicon, trees, None, share)
    steps = (
        _probability(trees.transform(stored.where("fold = 3")))
        .groupBy(F.round("probability", 3).alias("probability"))
        .agg(F.avg("label").alias("label"), F.count("*").cast("double").alias("weight"))
    )
    calibration = IsotonicRegression(
        featuresCol="probability", labelCol="label", weightCol="weight", predictionCol="calibrated"
    ).fit(steps)
    return ToxicityModel(lexicon, trees, calibration, share)


def score_toxicity(
    documents: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``row`` (a struct of the document's own columns), ``score`` (0 to 1), ``predicted`` (0 or 1).

    Null and empty texts are scored as texts without words. Repeated rows get equal scores; an empty
    table gives an empty table; columns of any name pass inside ``row``.
    """
    own = F.struct(*[F.col(f"`{name}`") for name in documents.columns])
    rows = documents.select(own.alias("row"), F.col(f"`{text}`").alias("text"))
    return model.score(rows).select("row", "score", predicted(F.col("score"), threshold))


def predicted(score: Column, threshold: float) -> Column:
    return F.when(score >= threshold, 1).otherwise(0).alias("predicted")


def drop_toxic(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not predicted toxic, with their own columns."""
    scored = score_toxicity(documents, fit_toxicity(documents, labels), threshold=threshold)
    return scored.where("predicted = 0").select("row.*")


def read_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
