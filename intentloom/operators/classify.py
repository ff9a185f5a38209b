"""Text classifiers: training, saving and batch scoring."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.functions.text import normalize_text, strip_message
from intentloom.operators.scale import (
    SMALL_BYTES,
    fetch_small,
    is_small,
    lookup_join,
    numbered,
    spread_join,
    use_all_cores,
)
from intentloom.session import settle

FEW_CLASSES = 128
# Classes whose scores are bounded together, where there are more than FEW_CLASSES.
CLASS_BLOCK = 64
# Above what rounding and the order of a sum can change in a score.
BOUND_SLACK = 1e-5
WORD_BREAK = "[^a-z]+"
SCORE_DIGITS = 6
# A word model up to this size is broadcast (see also scale.SMALL_BYTES).
SMALL_WORDS = 500_000


@dataclass
class WordModel:
    """A word-count classifier with add-one smoothing, as two tables.

    words:   (label, word, n), only what was seen in training
    classes: (label, docs, tokens, vocabulary, log_prior, log_norm)
    """

    words: DataFrame
    classes: DataFrame

    def table(self) -> DataFrame:
        """(label, word, n, log_likelihood) of the words seen per class."""
        seen = self.words.join(self.classes.select("label", "log_norm"), "label")
        likelihood = F.log(F.col("n") + 1) - F.col("log_norm")
        return seen.select("label", "word", "n", likelihood.alias("log_likelihood"))


def train_classifier_nb(df: DataFrame, text: str, label: str) -> WordModel:
    """Count words per class; the counts are written to the shared folder once."""
    return model_of_counts(word_counts(df, text, label))


def word_counts(df: DataFrame, text: str, label: str) -> DataFrame:
    """(label, word, n, first): words per class, and texts by their first part; stored."""
    labelled = df.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    texts = labelled.select(F.col(label).alias("label"), F.col(text).alias("text"))
    # splitting gives every text a first part, so the first parts count the texts
    parts = use_all_cores(texts).select("label", F.posexplode(_words("text")).alias("pos", "word"))
    return settle(
        parts.groupBy("label", "word").agg(
            F.count("*").alias("n"), F.count_if(F.col("pos") == 0).alias("first")
        ),
        "word-counts",
    )


def model_of_counts(stored: DataFrame) -> WordModel:
    """The model that stored counts make; counts of several inputs may be added up before."""
    words = stored.where("word != ''").select("label", "word", "n")
    vocabulary = words.select("word").distinct().count()
    counted = settle(
        stored.groupBy("label").agg(
            F.sum("first").alias("docs"),
            F.sum(F.when(F.col("word") != "", F.col("n")).otherwise(0)).alias("tokens"),
        ),
        "classes",
    )
    all_docs = counted.agg(F.sum("docs").alias("docs")).first()["docs"] or 0
    classes = counted.select(
        "label",
        "docs",
        "tokens",
        F.lit(vocabulary).cast("bigint").alias("vocabulary"),
        F.log(F.col("docs") / F.lit(all_docs)).alias("log_prior"),
        F.log(F.col("tokens") + F.lit(vocabulary)).alias("log_norm"),
    )
    return WordModel(words, classes)


def score_classifier_nb(df: DataFrame, id: str, text: str, model: WordModel) -> DataFrame:
    """(id, label): the most likely class of each row; ties go to the first name."""
    texts = use_all_cores(df.select(F.col(id).alias("id"), F.col(text).alias("text")), "id")
    tokens = texts.select("id", F.explode_outer(_words("text")).alias("word"))
    constants = model.classes.select("label", "log_prior", "log_norm", "vocabulary")
    few = fetch_small(constants, FEW_CLASSES)
    classes = [] if few is None else few.sort_by("label").to_pylist()
    if few is not None and not classes:  # nothing was learned
        kind = model.classes.schema["label"].dataType
        return texts.select("id", F.lit(None).cast(kind).alias("label"))
    words_fit = is_small(model.words, SMALL_WORDS)
    # one weight of 8 bytes per word and class
    columns_fit = sum(c["vocabulary"] for c in classes) * 8 <= SMALL_BYTES
    if classes and (columns_fit or not words_fit):
        return _score_all_classes(tokens, model, classes, words_fit and columns_fit)
    return _score_class_blocks(tokens, model, words_fit)


def _with_model(tokens: DataFrame, by_word: DataFrame, fits: bool) -> DataFrame:
    """Left join of the tokens with the model's words; `fits` allows a broadcast."""
    if fits:
        return tokens.join(F.broadcast(by_word), "word", "left")
    return spread_join(tokens, by_word, "word", "left", ["id"])


def _score_all_classes(
    tokens: DataFrame, model: WordModel, classes: list[dict], fits: bool
) -> DataFrame:
    """One weight column per class: a single sum per text, all inside codegen."""
    columns = {f"w{i}": c["label"] for i, c in enumerate(classes)}
    weight = F.log(F.col("n") + 1)
    by_word = model.words.groupBy("word").agg(
        *[
            F.coalesce(F.max(F.when(F.col("label") == label, weight)), F.lit(0.0)).alias(column)
            for column, label in columns.items()
        ]
    )
    sums = (
        _with_model(tokens, by_word, fits)
        .groupBy("id")
        .agg(
            F.count("w0").alias("known"),
            *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in columns],
        )
    )
    scores = [
        F.struct(
            F.round(
                F.col(f"w{i}") - F.col("known") * F.lit(c["log_norm"]) + F.lit(c["log_prior"]),
                SCORE_DIGITS,
            ).alias("score"),
            F.lit(-i).alias("place"),
        )
        for i, c in enumerate(classes)
    ]
    names = F.array(*[F.lit(c["label"]) for c in classes])
    best = F.array_max(F.array(*scores)).getField("place")
    return sums.select("id", F.get(names, -best).alias("label"))


def _score_class_blocks(tokens: DataFrame, model: WordModel, fits: bool) -> DataFrame:
    """Scoring for many classes, in blocks of classes that bounds let be skipped.

    A block's bound for a text sums the highest weight that any of its classes has for
    each word. The block of the highest bound is scored class by class; after that only
    blocks whose bound reaches the best score so far. A class that shares no word with
    a text scores prior - tokens * norm; the best of those depends only on the number of
    known tokens and is a candidate of its own.
    """
    constants = model.classes.select("label", "log_prior", "log_norm")
    # classes of like norms share a block, so its bound is near their scores
    placed = numbered(constants, ["log_norm", "label"], "_at")
    block = F.floor(F.col("_at") / CLASS_BLOCK).cast("int").alias("block")
    placed = settle(placed.select(*constants.columns, block), "class-blocks")
    weights = model.words.select("label", "word", F.log(F.col("n") + 1).alias("weight"))
    weights = lookup_join(weights, placed.select("label", "block"), "label", "inner", ["word"])
    by_block = weights.groupBy("word", "block").agg(
        F.max("weight").alias("top"), F.collect_list(F.struct("label", "weight")).alias("members")
    )
    by_block = settle(by_block, "block-words")
    counted = settle(tokens.groupBy("id", "word").agg(F.count("*").alias("times")), "text-words")

    per_text = settle(_block_bounds(counted, by_block, placed, fits), "block-bounds")
    others = _best_without_words(per_text.select("known").distinct(), constants)
    per_text = lookup_join(per_text, others, "known", "left", ["id"])
    highest = F.array_max("bounds").getField("block")
    pairs = per_text.where(F.size("bounds") > 0).select("id", "known", highest.alias("block"))
    first = settle(_best_of_blocks(counted, pairs, by_block, constants, fits), "first-blocks")

    def with_best(texts: DataFrame, found: DataFrame, name: str) -> DataFrame:
        found = found.select(F.col("id").alias("_id"), F.col("best").alias(name))
        return texts.join(found, F.col("id").eqNullSafe(F.col("_id")), "left").drop("_id")

    per_text = with_best(per_text, first, "first")
    reached = F.greatest(F.col("other.score"), -F.col("first.minus")) - BOUND_SLACK
    left = F.filter("bounds", lambda b: (b["bound"] >= reached) & (b["block"] != highest))
    pairs = settle(
        per_text.select("id", "known", F.explode(F.transform(left, lambda b: b["block"])).alias("block")),
        "blocks-left",
    )
    rest = _best_of_blocks(counted, pairs, by_block, constants, fits)
    other = F.struct((-F.col("other.score")).alias("minus"), F.col("other.label").alias("label"))
    best = F.array_min(F.array_compact(F.array(other, "first", "rest")))
    return with_best(per_text, rest, "rest").select("id", best.getField("label").alias("label"))


def _block_bounds(
    counted: DataFrame, by_block: DataFrame, placed: DataFrame, fits: bool
) -> DataFrame:
    """(id, known, bounds): known tokens of a text, and (bound, block) where it shares a word."""
    by_word = by_block.groupBy("word").agg(F.collect_list(F.struct("block", "top")).alias("tops"))
    met = _with_model(counted, by_word, fits)
    # the row without a block counts the known tokens of the text
    total = F.struct(
        F.lit(None).cast("int").alias("block"),
        F.when(F.col("tops").isNotNull(), F.col("times")).otherwise(0).cast("double").alias("weight"),
    )
    tops = F.transform(
        "tops",
        lambda t: F.struct(t["block"].alias("block"), (t["top"] * F.col("times")).alias("weight")),
    )
    none = F.array().cast("array<struct<block:int,weight:double>>")
    sums = met.select("id", F.inline(F.concat(F.array(total), F.coalesce(tops, none))))
    sums = sums.groupBy("id", "block").agg(F.sum("weight").alias("weight"))
    ranges = placed.groupBy("block").agg(
        F.max("log_prior").alias("prior"), F.min("log_norm").alias("norm")
    )
    shared = F.when(F.col("block").isNotNull(), F.struct("block", "weight", "prior", "norm"))
    per_text = (
        lookup_join(sums, ranges, "block", "left", ["id"])
        .groupBy("id")
        .agg(
            F.max(F.when(F.col("block").isNull(), F.col("weight"))).alias("known"),
            F.collect_list(shared).alias("shared"),
        )
    )
    bounds = F.transform(
        "shared",
        lambda s: F.struct(
            (s["weight"] + s["prior"] - F.col("known") * s["norm"]).alias("bound"),
            s["block"].alias("block"),
        ),
    )
    return per_text.select("id", "known", bounds.alias("bounds"))


def _best_of_blocks(
    counted: DataFrame, pairs: DataFrame, by_block: DataFrame, constants: DataFrame, fits: bool
) -> DataFrame:
    """(id, best): the best class of each text in the blocks that `pairs` names for it."""
    pairs = pairs.withColumnRenamed("id", "_id")
    words = counted.where(F.col("word").isNotNull())
    words = words.join(pairs, F.col("id").eqNullSafe(F.col("_id"))).drop("_id")
    key = F.concat_ws(" ", "block", "word")  # words have no spaces
    words = words.select("id", "known", "times", key.alias("key"))
    members = by_block.select(key.alias("key"), "members")
    if fits:
        met = words.join(F.broadcast(members), "key")
    else:
        met = spread_join(words, members, "key", "inner", ["id"])
    sums = (
        met.select("id", "known", "times", F.inline("members"))
        .groupBy("id", "known", "label")
        .agg(F.sum(F.col("times") * F.col("weight")).alias("weight"))
    )
    scored = lookup_join(sums, constants, "label", "left", ["id"])
    score = F.col("weight") - F.col("known") * F.col("log_norm") + F.col("log_prior")
    best = F.struct((-F.round(score, SCORE_DIGITS)).alias("minus"), "label")
    return scored.groupBy("id").agg(F.min(best).alias("best"))


def _candidate(score: Column, label: Column) -> Column:
    return F.struct(F.round(score, SCORE_DIGITS).alias("score"), label.alias("label"))


def _best_without_words(counts: DataFrame, classes: DataFrame) -> DataFrame:
    """(known, other): for each number of known tokens the best class by prior and norm.

    A corpus of t tokens has at most sqrt(2 t) different text lengths, so these are
    shared with all tasks; each scores its classes as vectors and passes on the best.
    """
    kind = classes.schema["label"].dataType
    shared = classes.sparkSession.sparkContext.broadcast(
        [row["known"] for row in counts.collect()]
    )

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            batch = batch.sort_by("label")
            if not len(batch) or not known:
                continue
            priors, norms = (np.asarray(batch[c]) for c in ("log_prior", "log_norm"))
            scores = [priors - count * norms for count in known]
            places = [int(np.argmax(np.round(s, SCORE_DIGITS))) for s in scores]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(known, pa.float64()),
                    pa.array([s[k] for s, k in zip(scores, places)], pa.float64()),
                    batch["label"].take(pa.array(places)),
                ],
                names=["known", "score", "label"],
            )

    columns = f"known double, score double, label {kind.simpleString()}"
    found = classes.select("label", "log_prior", "log_norm").mapInArrow(best, columns)
    scored = found.select("known", _candidate(F.col("score"), F.col("label")).alias("other"))
    first = F.struct(-F.col("other.score"), F.col("other.label"))
    return scored.groupBy("known").agg(F.min_by("other", first).alias("other"))


def train_classifier_ml(
    df: DataFrame, text: str, label: str, params: dict | None = None
) -> PipelineModel:
    """Hashed word counts and multinomial logistic regression.

    The regression standardizes its features, so weighting the counts first would
    cost a pass over the corpus and change nothing.
    `params`: features (hash size; with the number of classes it alone sets the
    size of the model), max_iter, reg_param, elastic_net.
    """
    params = params or {}
    stages = [
        StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc"),
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=WORD_BREAK),
        HashingTF(
            inputCol="_words", outputCol="_features", numFeatures=params.get("features", 1 << 14)
        ),
        LogisticRegression(
            featuresCol="_features",
            labelCol="_label",
            predictionCol="_prediction",
            maxIter=params.get("max_iter", 10),
            regParam=params.get("reg_param", 0.01),
            elasticNetParam=params.get("elastic_net", 0.0),
        ),
    ]
    labelled = df.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    trained = Pipeline(stages=stages).fit(use_all_cores(labelled.select(text, label)))
    names = IndexToString(
        inputCol="_prediction", outputCol="prediction", labels=trained.stages[0].labels
    )
    # scoring needs no truth, so the label indexer stays behind
    return PipelineModel([*trained.stages[1:], names])


def score_classifier_ml(df: DataFrame, id: str, model: PipelineModel) -> DataFrame:
    """(id, label) predicted by a trained model for its text column."""
    texts = use_all_cores(df.select(F.col(id).alias("id"), model.stages[0].getInputCol()))
    return model.transform(texts).select("id", F.col("prediction").alias("label"))


def save_model(model: WordModel | PipelineModel, path: str) -> None:
    if isinstance(model, WordModel):
        model.words.write.mode("overwrite").parquet(f"{path}/words")
        model.classes.write.mode("overwrite").parquet(f"{path}/classes")
    else:
        model.write().overwrite().save(path)


def load_word_model(spark: SparkSession, path: str) -> WordModel:
    return WordModel(
        spark.read.parquet(f"{path}/words"), spark.read.parquet(f"{path}/classes")
    )


def load_ml_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def batch_score_udf(
    df: DataFrame,
    message: str,
    factory: Callable[[], Callable],
    normalize: bool = True,
    batched: bool = False,
) -> DataFrame:
    """Add `decoded`, the text a user's scorer gives for each message.

    `factory` runs once per Python worker and returns the scorer: from a message to
    its text, or if `batched` from a list of messages to a list of texts. A worker keeps
    the scorer it has used last. Only the message column goes to Python. With `normalize` the scorer gets the form used in
    training, otherwise the message is only stripped.
    """
    shelf, token = "intentloom_loaded_scorers", uuid.uuid4().hex
    clean = normalize_text if normalize else strip_message

    @F.arrow_udf("string")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # a worker process serves many tasks: what is kept in sys.modules stays loaded
        loaded = vars(sys.modules.setdefault(shelf, ModuleType(shelf)))
        scorer = loaded.get(token)
        if scorer is None:
            loaded.clear()
            scorer = loaded[token] = factory()
        for batch in batches:
            given = batch.drop_null().to_pylist()
            answers = iter(scorer(given) if batched else map(scorer, given))
            yield pa.array([next(answers) if t.is_valid else None for t in batch], pa.string())

    return df.withColumn("decoded", score(clean(F.col(message))))


def unscored_rows(df: DataFrame, done: DataFrame, id: str) -> DataFrame:
    """Rows without a stored prediction: what an interrupted run has left."""
    return df.join(done.select(id), id, "left_anti")


def _words(text: str) -> Column:
    return F.split(F.lower(F.col(text)), WORD_BREAK)
