"""Closest labels of many strings from a vocabulary too large to broadcast.

The similarity is 2 * matched / (length + length), and no more characters match than
the two strings share. A string is the set of its (character, occurrence) tokens in one
order, rare ones first; two strings that share enough tokens share one among their first
few. So an equi-join on those tokens finds every pair that can reach a cutoff, and no
label is compared with an answer it cannot match.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from intentloom.functions.matching import COMMON_TOKENS, letter_tokens, similarity
from intentloom.operators.scale import first_per_group, spread_join
from intentloom.session import settle

# Answers with n labels above one of these take no part in the search below it.
EARLY_CUTOFFS = (0.9, 0.75)
# Length classes per doubling of the length.
CLASSES_PER_OCTAVE = 4
ROUNDING = 1e-9


@dataclass
class LabelIndex:
    """The labels (folded, tokens), stored, and how long they are."""

    table: DataFrame
    tokens_of: object
    shortest: int
    longest: int

    @classmethod
    def of(cls, folded: DataFrame) -> LabelIndex | None:
        """Index of the non-empty labels; None if there are none."""
        labels = folded.select("folded").where("folded != ''").distinct()
        context = folded.sparkSession.sparkContext
        plain = labels.select(F.explode(letter_tokens(None)(F.col("folded"))).alias("token"))
        common = plain.groupBy("token").count().orderBy(F.desc("count"), "token")
        # at most COMMON_TOKENS numbers, the rarest of them first
        ranks = [row["token"] for row in common.limit(COMMON_TOKENS).collect()][::-1]
        tokens_of = letter_tokens(context.broadcast(ranks))
        table = settle(labels.withColumn("tokens", tokens_of(F.col("folded"))), "label-index")
        ends = table.agg(F.min(F.size("tokens")), F.max(F.size("tokens"))).first()
        return None if ends[0] is None else cls(table, tokens_of, ends[0], ends[1])


def closest_by_index(keys: DataFrame, folded: DataFrame, cutoff: float, n: int) -> DataFrame:
    """(key, rank, folded, ratio): the n closest labels of each distinct string `folded`
    of `keys`, ratio >= cutoff, the larger label first among equals.

    The search starts at a high cutoff, where few labels share a rare token with an
    answer, and goes on only with answers that have found fewer than n labels.
    """
    index = LabelIndex.of(folded)
    if index is None:
        return keys.select(
            F.col("folded").alias("key"),
            F.lit(1).alias("rank"),
            F.lit("").alias("folded"),
            F.lit(0.0).alias("ratio"),
        ).where(F.lit(False))
    left = keys.select(F.col("folded").alias("key")).where("key != ''").distinct()
    left = settle(left.withColumn("key_tokens", index.tokens_of(F.col("key"))), "answers-left")
    order = [F.desc("ratio"), F.desc("folded")]
    rank = F.row_number().over(Window.partitionBy("key").orderBy(*order))
    found = []
    for step in [*[early for early in EARLY_CUTOFFS if early > cutoff], cutoff]:
        near = candidates(left, index, step).select(
            "key", "folded", similarity()(F.col("folded"), F.col("key")).alias("ratio")
        )
        near = near.where(F.col("ratio") >= step)
        if step <= 0:
            near = _with_unlike(left, near, index, n)
        best = first_per_group(near, ["key"], order, n)
        best = settle(best.select("key", rank.alias("rank"), "folded", "ratio"), "closest")
        if step == cutoff:
            found.append(best)
        else:
            settled = best.where(F.col("rank") == n).select("key")
            found.append(best.join(settled, "key", "left_semi"))
            left = settle(left.join(settled, "key", "left_anti"), "answers-left")
    return reduce(DataFrame.unionByName, found)


def candidates(keys: DataFrame, index: LabelIndex, cutoff: float) -> DataFrame:
    """(key, folded) once for every pair whose ratio may reach the cutoff.

    `keys` has (key, key_tokens). A pair meets at its first common token alone, and
    stays if the characters shared and the edit distance allow the ratio: a common
    subsequence of m characters leaves at most length + length - 2 m edits.
    """
    size, mine = F.size("tokens"), F.size("key_tokens")
    labels = index.table.select(
        "folded",
        "tokens",
        F.explode(_first_tokens("tokens", cutoff)).alias("token"),
        _length_class(size).alias("class"),
    ).select("folded", "tokens", F.struct("token", "class").alias("place"))

    lowest, highest = _partner_lengths(mine, cutoff, index)
    classes = F.sequence(_length_class(lowest), _length_class(highest))
    places = (
        keys.where(lowest <= highest)
        .withColumn("class", F.explode(classes))
        .withColumn("token", F.explode(_first_tokens("key_tokens", cutoff)))
        .select("key", "key_tokens", F.struct("token", "class").alias("place"))
    )
    met = spread_join(places, labels, "place", "inner", ["key"])
    shared = F.array_intersect("key_tokens", "tokens")
    both = (size + mine).cast("double")
    return met.where(
        (size >= lowest)
        & (size <= highest)
        & (F.get(shared, F.lit(0)) == F.col("place.token"))
        & (F.lit(2.0) * F.size(shared) / both >= cutoff)
        & (F.lit(1.0) - F.levenshtein("key", "folded") / both >= cutoff - ROUNDING)
    ).select("key", "folded")


def _partner_lengths(size: Column, cutoff: float, index: LabelIndex) -> tuple[Column, Column]:
    """The shortest and longest label that a string of this length can match."""
    shortest, longest = F.lit(index.shortest), F.lit(index.longest)
    if cutoff <= 0:
        return shortest, longest
    span = (2.0 - cutoff) / cutoff
    lowest = F.ceil(size / span - ROUNDING).cast("int")
    highest = F.least(F.floor(size * span + ROUNDING), longest.cast("bigint")).cast("int")
    return F.greatest(lowest, shortest), highest


def _first_tokens(tokens: str, cutoff: float) -> Column:
    """As many tokens as surely hold one that any partner shares, and holds among its own.

    Partners share at least cutoff / (2 - cutoff) of a string's characters, so all but
    that many, and one more, have to be looked at.
    """
    least_shared = F.greatest(
        F.ceil(F.size(tokens) * (cutoff / (2.0 - cutoff)) - ROUNDING).cast("int"), F.lit(1)
    )
    return F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - least_shared + 1, F.lit(0)))


def _length_class(size: Column) -> Column:
    return F.floor(F.log2(size.cast("double")) * CLASSES_PER_OCTAVE).cast("int")


def _with_unlike(keys: DataFrame, near: DataFrame, index: LabelIndex, n: int) -> DataFrame:
    """At a cutoff of zero also labels that share no character with an answer.

    Their ratio is zero, and such a label is among an answer's n closest only if it is
    one of the n largest of all.
    """
    largest = [r["folded"] for r in index.table.orderBy(F.desc("folded")).limit(n).collect()]
    unlike = keys.select(
        "key", F.explode(F.array(*[F.lit(label) for label in largest])).alias("folded")
    ).withColumn("ratio", F.lit(0.0))
    return near.unionByName(unlike).groupBy("key", "folded").agg(F.max("ratio").alias("ratio"))
