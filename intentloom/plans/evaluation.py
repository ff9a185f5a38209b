"""Scoring to report in one plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentloom.functions import fixed
from intentloom.functions.text import extract_answer
from intentloom.operators.evaluate import confusion_counts, full_report
from intentloom.operators.resolve import resolve_prediction


def score_and_evaluate(
    df: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
    vocab: DataFrame,
    cutoff: float = fixed.FUZZY_CUTOFF,
) -> DataFrame:
    """Score rows that have `y_true`, resolve the answers and report.

    `scorer` adds the generated text as `decoded`. Equal answers to the same truth
    are counted before they are resolved, so matching works on the distinct ones.
    """
    return full_report(scored_confusion(df, scorer, vocab, cutoff))


def scored_confusion(
    df: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
    vocab: DataFrame,
    cutoff: float = fixed.FUZZY_CUTOFF,
) -> DataFrame:
    """(y_true, y_pred, rows) of scored and resolved rows."""
    answers = scorer(df).select("y_true", extract_answer(F.col("decoded")).alias("raw"))
    counted = answers.groupBy("y_true", "raw").agg(F.count("*").alias("rows"))
    resolved = resolve_prediction(counted, "raw", vocab, cutoff)
    return confusion_counts(resolved, F.col("rows"))
