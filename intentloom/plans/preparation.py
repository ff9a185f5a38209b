"""Raw labelled messages to instruction-tuning records in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentloom.functions import fixed
from intentloom.functions.text import normalize_text
from intentloom.operators.corpus import decode_label, instruction_text, sft_columns
from intentloom.operators.sampling import sample_capped_per_class
from intentloom.sources.corpus import union_splits

DEFAULT_CAPS = {"train": fixed.TRAIN_ROWS_PER_CLASS, "test": fixed.TEST_ROWS_PER_CLASS}


def prepare_records(
    splits: dict[str, DataFrame],
    vocab: DataFrame,
    caps: dict[str, int] = DEFAULT_CAPS,
    seed: int = fixed.SEED,
) -> DataFrame:
    """Normalize, sample, decode and render the splits, each (id, text, label).

    Labels are decoded after the sample, on the few rows that are left. Rows whose
    label has no name give no record; `undecodable_labels` lists them.
    """
    sampled = {
        split: sample_capped_per_class(
            df.select("id", "text", "label"), "label", "id", caps[split], seed
        )
        for split, df in splits.items()
    }
    rows = union_splits(sampled).withColumn("text", normalize_text(F.col("text")))
    named = decode_label(rows, vocab, ["id"]).where("intent is not null")
    return sft_columns(named, instruction_text(vocab))
