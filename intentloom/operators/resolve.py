"""Mapping free-form predictions to valid labels: exact, then fuzzy, then as is."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentloom.functions import fixed
from intentloom.functions.matching import closest_label, closest_labels
from intentloom.functions.text import normalize_text, strip_message
from intentloom.operators.nearest import closest_by_index
from intentloom.operators.scale import fetch_small, lookup_join
from intentloom.session import settle


@dataclass
class FoldedVocabulary:
    """Vocabulary by lower-cased label; the first label wins if two fold alike."""

    table: DataFrame
    small: pa.Table | None

    @classmethod
    def of(cls, vocab: DataFrame) -> FoldedVocabulary:
        table = vocab.groupBy(F.lower("intent").alias("folded")).agg(
            F.min_by("intent", "label").alias("intent")
        )
        small = fetch_small(table)
        if small is None:
            table = settle(table, "vocabulary")
        else:
            table = vocab.sparkSession.createDataFrame(small, schema=table.schema)
        return cls(table, small)

    def shared(self) -> Broadcast:
        """The lower-cased labels of a vocabulary within the bound, for the UDFs."""
        context = self.table.sparkSession.sparkContext
        return context.broadcast(self.small.column("folded").to_pylist())


def exact_match_label(raws: DataFrame, vocab: DataFrame) -> DataFrame:
    """(raw, label) of the distinct raws equal to a label but for case."""
    folded = FoldedVocabulary.of(vocab).table.select("folded", F.col("intent").alias("label"))
    keyed = _distinct_raws(raws)
    return lookup_join(keyed, folded, "folded", "inner", ["raw"]).select("raw", "label")


def fuzzy_match_label(
    raws: DataFrame, vocab: DataFrame, cutoff: float = fixed.FUZZY_CUTOFF
) -> DataFrame:
    """(raw, label, ratio): the closest label of each distinct raw, ratio >= cutoff."""
    return best_label_topk(raws, vocab, 1, cutoff).drop("rank")


def best_label_topk(
    raws: DataFrame, vocab: DataFrame, n: int, cutoff: float = fixed.FUZZY_CUTOFF
) -> DataFrame:
    """(raw, rank, label, ratio): the n closest labels of each distinct raw."""
    folded = FoldedVocabulary.of(vocab)
    keyed = _distinct_raws(raws)
    if folded.small is not None:
        closest = closest_labels(folded.shared(), cutoff, n)(F.col("folded"))
        ranked = keyed.select("raw", F.posexplode(closest).alias("pos", "match")).select(
            "raw",
            (F.col("pos") + 1).alias("rank"),
            F.col("match.label").alias("folded"),
            F.col("match.ratio").alias("ratio"),
        )
    else:
        keys = keyed.select("folded").distinct()
        matches = closest_by_index(keys, folded.table, cutoff, n)
        ranked = keyed.withColumnRenamed("folded", "key").join(matches, "key").drop("key")
    return lookup_join(ranked, folded.table, "folded", "inner", ["raw"]).select(
        "raw", "rank", F.col("intent").alias("label"), "ratio"
    )


def resolve_prediction(
    df: DataFrame, raw_col: str, vocab: DataFrame, cutoff: float = fixed.FUZZY_CUTOFF
) -> DataFrame:
    """Add y_pred and match_kind ('exact', 'fuzzy' or 'none') to each row.

    With a vocabulary within the bound these are two broadcast joins and a UDF: no
    shuffle, and repeated answers do not matter. Beyond it distinct answers look up an
    index of the labels' characters. Streams resolve each micro-batch as a batch, see
    `streaming.scoring`.
    """
    folded = FoldedVocabulary.of(vocab)
    raw = strip_message(F.col(raw_col))
    keyed = df.withColumn("_key", normalize_text(F.col(raw_col)))
    exact = folded.table.select(F.col("folded").alias("_key"), F.col("intent").alias("_exact"))
    if folded.small is not None:
        keyed = keyed.join(F.broadcast(exact), "_key", "left")
        # the UDF sees null wherever the exact match has settled the row
        unmatched = F.when(F.col("_exact").isNull(), F.col("_key"))
        near = keyed.withColumn("_folded", closest_label(folded.shared(), cutoff)(unmatched))
        fuzzy = folded.table.select(
            F.col("folded").alias("_folded"), F.col("intent").alias("_fuzzy")
        )
        matched = near.join(F.broadcast(fuzzy), "_folded", "left").drop("_folded")
    else:
        matched = _resolve_by_key(df, keyed, folded, exact, cutoff)
    kind = (
        F.when(F.col("_exact").isNotNull(), "exact")
        .when(F.col("_fuzzy").isNotNull(), "fuzzy")
        .otherwise("none")
    )
    return matched.select(
        *df.columns,
        F.coalesce("_exact", "_fuzzy", raw).alias("y_pred"),
        kind.alias("match_kind"),
    )


def _resolve_by_key(
    df: DataFrame, keyed: DataFrame, folded: FoldedVocabulary, exact: DataFrame, cutoff: float
) -> DataFrame:
    """Resolve the distinct keys only, then bring the answers back to the rows."""
    keys = keyed.where("_key != ''").select("_key").distinct()
    found = keys.join(exact, "_key", "left")
    open_keys = found.where("_exact is null").select(F.col("_key").alias("folded"))
    near = closest_by_index(open_keys, folded.table, cutoff, 1).select(
        F.col("key").alias("_key"), "folded"
    )
    near = lookup_join(near, folded.table, "folded", "inner", ["_key"])
    near = near.select("_key", F.col("intent").alias("_fuzzy"))
    answers = found.join(near, "_key", "left").where("_exact is not null or _fuzzy is not null")
    return lookup_join(keyed, settle(answers, "answers"), "_key", "left", df.columns)


def invalid_predictions(preds: DataFrame, vocab: DataFrame) -> DataFrame:
    """(y_pred, rows) of predictions that are not labels; they count as wrong."""
    counted = preds.groupBy("y_pred").agg(F.count("*").alias("rows"))
    valid = vocab.select(F.col("intent").alias("y_pred")).distinct()
    return counted.join(valid, "y_pred", "left_anti")


def _distinct_raws(raws: DataFrame) -> DataFrame:
    return (
        raws.select("raw")
        .where("raw is not null")
        .distinct()
        .withColumn("folded", normalize_text(F.col("raw")))
    )
