"""Corpus preparation: labels, instruction, records, profiles and previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentloom.functions import fixed
from intentloom.functions.text import fill_template
from intentloom.operators.scale import lookup_join


def decode_label(df: DataFrame, vocab: DataFrame, spread_by: list[str]) -> DataFrame:
    """Add the intent name of each label id; null where the id has no name."""
    return lookup_join(df, vocab.select("label", "intent"), "label", "left", spread_by)


def undecodable_labels(df: DataFrame, vocab: DataFrame, spread_by: list[str]) -> DataFrame:
    """Rows whose label id has no name in the vocabulary."""
    return lookup_join(df, vocab.select("label"), "label", "left_anti", spread_by)


def build_instruction(vocab: DataFrame) -> DataFrame:
    """One row: the instruction that lists all labels in id order."""
    return vocab.agg(_with_labels().alias("instruction"))


def fallback_instruction(vocab: DataFrame) -> DataFrame:
    """One row: the instruction, in its generic form if there are no labels."""
    generic = F.lit(fixed.INSTRUCTION_WITHOUT_LABELS)
    chosen = F.when(F.count("intent") == 0, generic).otherwise(_with_labels())
    return vocab.agg(chosen.alias("instruction"))


def _with_labels() -> Column:
    listed = F.expr("listagg(intent, ', ') WITHIN GROUP (ORDER BY label)")
    return fill_template(
        fixed.INSTRUCTION_TEMPLATE, label_list=F.coalesce(listed, F.lit(""))
    )


def instruction_text(vocab: DataFrame) -> str:
    """The instruction as a string: one value per run, attached as a literal."""
    return fallback_instruction(vocab).first()["instruction"]


def sft_columns(df: DataFrame, instruction: str) -> DataFrame:
    """Add instruction, input (= text) and output (= intent)."""
    return df.withColumns(
        {
            "instruction": F.lit(instruction),
            "input": F.col("text"),
            "output": F.col("intent"),
        }
    )


def project_sft(df: DataFrame) -> DataFrame:
    """Only what training reads."""
    return df.select("instruction", "input", "output")


def preview_rows(df: DataFrame, order_by: str, n: int, widths: dict[str, int]) -> DataFrame:
    """The first n rows, each named text column cut to its width plus '...'."""
    shown = [
        F.concat(F.substring(c, 1, widths[c]), F.lit("...")).alias(c) if c in widths else F.col(c)
        for c in df.columns
    ]
    return df.orderBy(order_by).limit(n).select(*shown)


def corpus_profile(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and distinct classes per split."""
    per_class = df.groupBy("split", label).agg(F.count("*").alias("_rows"))
    return per_class.groupBy("split").agg(
        F.sum("_rows").alias("rows"), F.count(label).alias("classes")
    )


def prompt_budget(
    df: DataFrame, prompt: str, limit: int = fixed.PROMPT_LIMIT
) -> DataFrame:
    """How the rendered prompts fit the sequence limit, one row.

    Words stand in for model tokens. Lengths are counted before the percentiles
    are taken, so these see one row per distinct length.
    """
    words = F.regexp_count(F.col(prompt), F.lit(r"\s+")).cast("bigint") + 1
    lengths = df.select(words.alias("words")).groupBy("words").agg(F.count("*").alias("rows"))

    def percentile(share: float):
        return F.percentile("words", share, F.col("rows"))

    return lengths.agg(
        F.sum("rows").alias("prompts"),
        F.max("words").alias("max_words"),
        percentile(0.5).alias("p50"),
        percentile(0.9).alias("p90"),
        percentile(0.99).alias("p99"),
        F.sum(F.when(F.col("words") > limit, F.col("rows")).otherwise(0)).alias("over_limit"),
    )
