"""The corpus pipeline: stages from raw documents to encoded training text.

Each stage takes the documents that its predecessor has kept and calls one operator.
All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.llm.leaks import remove_leaks
from intentloom.llm.pieces import piece_udf
from intentloom.llm.queries import PIECE_MODEL, SURROGATE_KEY
from intentloom.llm.shared import table, unused
from intentloom.llm.simhash import drop_near_duplicates
from intentloom.llm.surrogates import replace_entities
from intentloom.llm.toxicity import fit_toxicity, labelled_texts, score_toxicity
from intentloom.session import settle

TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score under TOXIC; the score is learned from the labelled ones."""
    model = fit_toxicity(labelled_texts(docs, table(spark, sf_dir, "labels")))
    score = unused(docs, "_score")
    return score_toxicity(docs, model, score).where(F.col(score) < TOXIC).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (three words, 3 of 64 bits)."""
    return drop_near_duplicates(docs, shingle=3, radius=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of benchmark items; mostly copied ones go."""
    return _counted(remove_leaks(docs, table(spark, sf_dir, "benchmark")))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data."""
    replaced = unused(docs, "_replaced")
    new = replace_entities(docs, SURROGATE_KEY, replaced)
    return _counted(new.withColumn("text", F.col(replaced)["text"]).drop(replaced))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the ids of the text's pieces, their number, and the text they stand for."""
    encode_text = piece_udf(spark, public_tokenizers.path(PIECE_MODEL))
    encoded = docs.select("doc_id", encode_text(F.col("text")).alias("_encoded"))
    return encoded.select(
        "doc_id",
        F.size("_encoded.ids").cast("bigint").alias("n_tokens"),
        "_encoded.ids",
        F.col("_encoded.decoded").alias("text"),
    )


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars after the text has changed."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", decontaminate),
    ("personal_data", replace_personal_data),
    ("pieces", encode),
]
#: Learned scores and piece encoding have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
