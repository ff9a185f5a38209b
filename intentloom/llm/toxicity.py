"""Toxicity scores: boosted trees over dense text features, calibrated by isotonic steps.

The labelled texts are dealt into three lots by a hash of the text, so copies stay
together. Words and word beginnings that mark toxic texts are learned from the
first lot, the trees from the second, the calibration from the third: what the
trees see of the lexicon is as fresh as it will be for new texts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentloom.llm.shared import release, slices, unused
from intentloom.session import settle

#: Labelled rows that a fit uses at most, in expectation; beyond it a hash picks them.
FIT_ROWS = 40_000
#: Entries of each learned lexicon at most.
LEXICON = 5_000
#: A word is learned from this many toxic texts at least, and this share of them.
LEAST_TEXTS, LEAST_SHARE = 3, 0.004
#: And if it is this many times (as a logarithm) more frequent in toxic texts.
LEAST_LOG_ODDS = 2.5
BEGINNING = 4
NEAR = 5
TREES, DEPTH, STEP, SEED = 20, 4, 0.2, 42

# Common insults, and pronouns of the second person in en, de, fr, es.
SEED_WORDS = "clown disgusting idiot loser moron pathetic scum stupid trash worthless".split()
SECOND_PERSON = frozenset(
    """you your yours yourself youre du dich dir dein deine deinen euch euer ihr
    tu te toi ton ta tes vous votre vos ti tus usted ustedes vosotros""".split()
)
# Characters that stand for letters in disguised words.
DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"})

_WORDS = re.compile(r"[\w@$*]+").findall
_RUN = re.compile(r"(\w)\1{2,}")

FEATURES = (
    "log_words", "word_hits", "word_density", "word_weight", "most_weight",
    "begin_hits", "begin_density", "begin_weight", "hits_near_second_person",
    "second_person_density", "capitals", "capital_words", "exclamations",
    "questions", "symbols", "digits", "disguised", "disguised_hits", "long_runs",
    "mean_word",
)


@dataclass(frozen=True)
class Lexicon:
    """Weights of words and of word beginnings; at most LEXICON of each."""

    words: dict[str, float]
    beginnings: dict[str, float]


def text_features(text: str, lexicon: Lexicon) -> list[float]:
    """The dense features of one whole text, in the order of FEATURES."""
    lower = text.lower()
    words = _WORDS(lower)
    n = max(1, len(words))
    known, begins = lexicon.words, lexicon.beginnings
    hits = [k for k, w in enumerate(words) if w in known]
    weights = [known[words[k]] for k in hits]
    begun = [begins[w[:BEGINNING]] for w in words if w[:BEGINNING] in begins]
    addressed = [k for k, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if hits and addressed:
        places = np.array(addressed)
        at = np.array(hits)
        right = np.minimum(np.searchsorted(places, at), len(places) - 1)
        left = np.maximum(right - 1, 0)
        distance = np.minimum(abs(places[right] - at), abs(places[left] - at))
        near = int((distance <= NEAR).sum())
    odd = [w for w in words if not w.isalpha() and any(map(str.isalpha, w))]
    revealed = sum(w.replace("*", "").translate(DISGUISE) in known for w in odd)
    counts = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    upper, small = int(counts[65:91].sum()), int(counts[97:123].sum())
    n_bytes = max(1, len(lower))
    loud = sum(map(str.isupper, text.split())) if upper > 0.2 * (upper + small) else 0
    return [
        float(np.log1p(len(words))),
        float(len(hits)),
        len(hits) / n,
        sum(weights) / n,
        max(weights, default=0.0),
        float(len(begun)),
        len(begun) / n,
        sum(begun) / n,
        float(near),
        len(addressed) / n,
        upper / max(1, upper + small),
        loud / n,
        int(counts[33]) / n,
        int(counts[63]) / n,
        int(counts[[35, 36, 37, 38, 42, 60, 62, 64, 94, 124, 126]].sum()) / n_bytes,
        int(counts[48:58].sum()) / n_bytes,
        len(odd) / n,
        float(revealed),
        len(_RUN.findall(lower)) / n,
        n_bytes / n,
    ]


def features_udf(lexicon: Lexicon) -> Callable:
    """Arrow UDF: text -> array<double> of features. Null texts count as empty.

    The lexicon is bounded by LEXICON, so it travels with the function.
    """

    @F.arrow_udf("array<double>")
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        for part in slices(batches):
            rows = [text_features(text or "", lexicon) for text in part.to_pylist()]
            yield pa.array(rows, pa.list_(pa.float64()))

    return features.asNondeterministic()  # else a filter on the score would run it twice


def _marking(texts: DataFrame, terms: Column) -> dict[str, float]:
    """Terms that are much more frequent in toxic texts, with their log odds."""
    toxic, all_texts = texts.agg(F.sum("toxic"), F.count("*")).first()
    toxic = toxic or 0
    clean = all_texts - toxic
    if not toxic:
        return {}
    counted = (
        texts.select("toxic", F.explode(F.array_distinct(terms)).alias("term"))
        .groupBy("term")
        .agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
    )
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log(
        (F.col("n") - F.col("t") + 0.5) / (clean + 1)
    )
    least = max(LEAST_TEXTS, LEAST_SHARE * toxic)
    found = (
        counted.where(F.col("t") >= least)
        .select("term", F.round(odds, 6).alias("odds"))
        .where(F.col("odds") >= LEAST_LOG_ODDS)
        .orderBy(F.desc("odds"), "term")
        .limit(LEXICON)
    )
    return {r["term"]: r["odds"] for r in found.collect()}


def learn_lexicon(texts: DataFrame) -> Lexicon:
    """Lexicon from the columns text and toxic, one row per distinct text."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}_@$*]+)"), F.lit(1))
    long = F.filter(words, lambda w: F.length(w) >= BEGINNING)
    begins = F.transform(long, lambda w: F.substring(w, 1, BEGINNING))
    learned = _marking(texts, words)
    seeds = dict.fromkeys(SEED_WORDS, LEAST_LOG_ODDS)
    return Lexicon(seeds | learned, _marking(texts, begins))


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    steps: IsotonicRegressionModel | None
    prior: float


def labelled_texts(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(text, toxic) once per distinct text, stored; at most FIT_ROWS rows in expectation.

    Labels with a null id or a null or other value than 0 and 1 are left out, and so
    are rows without a text. Where a document or text has several labels, toxic wins.
    """
    marks = (
        labels.where("toxic in (0, 1)")
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.max("toxic").alias("toxic"))
    )
    n = marks.count()
    if n > FIT_ROWS:
        share = int(FIT_ROWS / n * 2**31)
        marks = marks.where(F.pmod(F.xxhash64("id"), F.lit(2**31)) < share)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # bounded by FIT_ROWS rows of two numbers
    joined = texts.join(F.broadcast(marks), "id").where("text is not null")
    distinct = joined.groupBy("text").agg(F.max("toxic").alias("toxic"))
    return settle(distinct, "labelled")


def fit_toxicity(texts: DataFrame) -> ToxicityModel:
    """Lexicon, trees and calibration from `labelled_texts`.

    Without toxic or without clean texts in a lot there is nothing to learn: the
    score is then the share of toxic texts (0 for none) for every text.
    """
    lot = F.pmod(F.xxhash64("text", F.lit(SEED)), F.lit(10))
    prior = texts.agg(F.avg("toxic")).first()[0] or 0.0
    lexicon = learn_lexicon(texts.where(lot < 5))
    rest = texts.where(lot >= 5).select(
        F.col("toxic").cast("double").alias("label"),
        features_udf(lexicon)(F.col("text")).alias("values"),
        (lot >= 8).alias("calibrates"),
    )
    rest = settle(rest, "features").withColumn("features", array_to_vector("values"))
    fit, check = rest.where("not calibrates"), rest.where("calibrates")
    kinds = {
        (r["calibrates"], r["label"])
        for r in rest.groupBy("calibrates", "label").count().collect()
    }
    if len(kinds) < 4:
        return ToxicityModel(lexicon, None, None, prior)
    trees = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED, maxBins=64
    ).fit(fit.select("label", "features"))
    raw = trees.transform(check).select("label", vector_to_array("probability")[1].alias("margin"))
    steps = IsotonicRegression(featuresCol="margin", labelCol="label").fit(
        raw.select("label", array_to_vector(F.array("margin")).alias("margin"))
    )
    return ToxicityModel(lexicon, trees, steps, prior)


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, out: str, text_col: str = "text"
) -> DataFrame:
    """`docs` with the column `out`: 0 to 1, higher where toxic is likelier.

    Null texts are scored as empty ones. All columns and repeated rows stay; columns
    with the names that the model uses are not touched.
    """
    if model.trees is None:
        return docs.withColumn(out, F.lit(float(model.prior)))
    names = {n: unused(docs, f"_{n}") for n in ("features", "raw", "probability", "label", "step", "margin")}
    trees, steps = model.trees.copy(), model.steps.copy()
    trees.setFeaturesCol(names["features"]).setPredictionCol(names["label"])
    trees.setRawPredictionCol(names["raw"]).setProbabilityCol(names["probability"])
    steps.setFeaturesCol(names["margin"]).setPredictionCol(names["step"])
    scored = docs.withColumn(
        names["features"], array_to_vector(features_udf(model.lexicon)(F.col(text_col)))
    )
    scored = trees.transform(scored)
    margin = vector_to_array(names["probability"])[1]
    scored = steps.transform(scored.withColumn(names["margin"], array_to_vector(F.array(margin))))
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(names["step"])))
    return scored.withColumn(out, score).drop(*names.values())
