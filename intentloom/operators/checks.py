"""Cleaning a corpus and checking it before training."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentloom.functions.text import normalize_text, strip_message
from intentloom.operators.presence import may_be_listed
from intentloom.operators.scale import lookup_join
from intentloom.session import settle


def clean_corpus(df: DataFrame, id: str, text: str, label: str) -> DataFrame:
    """(id, text, label) of labelled texts that are not blank, each pair once.

    Of rows with the same text and label that with the lowest id stays. Hashes are
    counted first; texts whose hash occurs once are not shuffled, and of the others
    equal ones are combined before the shuffle.
    """
    usable = df.where(F.col(label).isNotNull() & (strip_message(F.col(text)) != "")).select(
        F.col(id).alias("_id"), F.col(text).alias("_text"), F.col(label).alias("_label")
    )
    keyed = usable.withColumn("_hash", F.xxhash64("_text", "_label"))
    repeated = keyed.groupBy("_hash").agg(F.count("*").alias("_rows")).where("_rows > 1")
    repeated = settle(repeated.select("_hash"), "repeated")
    flagged = may_be_listed(keyed, "_hash", repeated, "_again")
    single = flagged.where("not _again").select("_id", "_text", "_label")
    again = flagged.where("_again").groupBy("_text", "_label").agg(F.min("_id").alias("_id"))
    found = single.unionByName(again)
    return found.select(
        F.col("_id").alias(id), F.col("_text").alias(text), F.col("_label").alias(label)
    )


def validate_sft(
    df: DataFrame, vocab: DataFrame, cap: int, text: str = "text", label: str = "intent"
) -> DataFrame:
    """(rule, violations): texts that are not normalized, rows whose label is not in the
    vocabulary, and rows beyond `cap` per class.

    The rows are read once and counted per class; the rest is as small as the classes.
    """
    bad = F.count_if(~F.col(text).eqNullSafe(normalize_text(F.col(text))))
    counts = df.groupBy(F.col(label).alias("intent")).agg(
        F.count("*").alias("rows"), bad.alias("not_normalized")
    )
    known = vocab.select("intent", F.lit(True).alias("known")).distinct()
    checked = lookup_join(counts, known, "intent", "left", ["rows"])
    sums = {
        "not_normalized": F.sum("not_normalized"),
        "unknown_label": F.sum(F.when(F.col("known").isNull(), F.col("rows")).otherwise(0)),
        "over_cap": F.sum(F.greatest(F.col("rows") - cap, F.lit(0))),
    }
    rules = [
        F.struct(F.lit(rule).alias("rule"), F.coalesce(n, F.lit(0)).alias("violations"))
        for rule, n in sums.items()
    ]
    return checked.agg(F.array(*rules).alias("rules")).select(F.inline("rules"))


def split_overlap(train: DataFrame, test: DataFrame, text: str) -> DataFrame:
    """(text, train_rows, test_rows) of normalized texts that both splits hold.

    Hashes of both sides are counted first. Only texts whose hash both sides hold are
    shuffled, equal ones combined before, so a text that fills a split is no hot key.
    """
    sides = train.select(F.col(text).alias("text"), F.lit(1).alias("train")).unionByName(
        test.select(F.col(text).alias("text"), F.lit(0).alias("train"))
    )
    sides = sides.select(normalize_text(F.col("text")).alias("text"), "train").where(
        "text is not null"
    )
    keyed = sides.withColumn("_hash", F.xxhash64("text"))
    held = F.count_if(F.col("train") == 1), F.count_if(F.col("train") == 0)
    shared = keyed.groupBy("_hash").agg(held[0].alias("_in"), held[1].alias("_out"))
    shared = settle(shared.where("_in > 0 and _out > 0").select("_hash"), "shared")
    near = may_be_listed(keyed, "_hash", shared, "_shared").where("_shared")
    counts = near.groupBy("text").agg(held[0].alias("train_rows"), held[1].alias("test_rows"))
    return counts.where("train_rows > 0 and test_rows > 0")


def class_balance(df: DataFrame, label: str = "intent") -> DataFrame:
    """(split, label, rows, smallest, largest, ratio): rows per class, and per split the
    smallest and largest class and their ratio. Rows without a label are left out."""
    counts = (
        df.where(F.col(label).isNotNull())
        .groupBy("split", F.col(label).alias("label"))
        .agg(F.count("*").alias("rows"))
    )
    ends = counts.groupBy("split").agg(
        F.min("rows").alias("smallest"), F.max("rows").alias("largest")
    )
    return lookup_join(counts, ends, "split", "inner", ["label"]).withColumn(
        "ratio", F.col("largest") / F.col("smallest")
    )
