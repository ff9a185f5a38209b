"""Quality rules: a decision list learned from labelled statistics, run as SQL.

All features are array and string functions of one row, so a corpus is judged
where it is read. Rules are learned by sequential covering: grown and pruned one
condition at a time from grouped counts, never from rows on the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentloom.llm.shared import unused

SPACES = "[\\x20\\x09-\\x0D]+"
WINDOW = 3
#: Bits of a word's place in a packed number; a text of one row has fewer words.
PLACE_BITS = 30
PLACES = (1 << PLACE_BITS) - 1
LEAST_WORDS = 50

#: Thresholds of a feature come from this many quantiles of the labelled rows.
QUANTILES = 64
MOST_RULES, MOST_CONDITIONS = 12, 4
#: A rule must be right on this share of the pruning rows it covers, and cover
#: this many growing rows.
LEAST_PRECISION, LEAST_COVERED = 0.8, 3

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = (
    "mean_word", "symbols_per_word", "dup_line_share", "repeat_share", "capital_share",
    "exclamations_per_word", "digit_share", "words_per_line", "stops_per_word",
)


def _repeated_places(words: str, packed: str) -> Column:
    """Places of windows that occur twice or more, as (hash, place) numbers.

    `packed` is sorted, so windows of one hash stand side by side. A few bits of the
    hash have to do; windows of equal bits are compared word by word, first with
    their neighbours and, if those are other windows, with all of the same bits.
    """

    def bits(number: Column) -> Column:
        return F.shiftright(number, PLACE_BITS)

    def same(one: Column, other: Column) -> Column:
        a, b = (n.bitwiseAND(F.lit(PLACES)).cast("int") for n in (one, other))
        equal = F.lit(True)
        for k in range(WINDOW):
            equal = equal & (F.get(words, a + k) == F.get(words, b + k))
        return equal

    def repeated(number: Column, k: Column) -> Column:
        before, after = F.get(packed, k - 1), F.get(packed, k + 1)
        near = [F.coalesce(bits(n) == bits(number), F.lit(False)) for n in (before, after)]
        anywhere = F.exists(
            packed,
            lambda n: (bits(n) == bits(number)) & (n != number) & same(n, number),
        )
        return (near[0] | near[1]) & (
            (near[0] & same(before, number)) | (near[1] & same(after, number)) | anywhere
        )

    return F.filter(packed, repeated)


def _count_of(text: Column, characters: str) -> Column:
    """How many of the characters a text has."""
    return F.length(text) - F.length(F.regexp_replace(text, characters, ""))


def add_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` without its text, with the columns of BASE and RATIOS added.

    Words are runs without ASCII white space. A null text has no words; ratios of a
    text without words are 0. Columns of these names are replaced, and the text has
    to go because results would otherwise carry it along.
    """
    names = [unused(docs, f"_{n}") for n in ("text", "words", "packed", "places", "lines")]
    text, words, packed, places, lines = names
    counted = [unused(docs, f"_{n}") for n in ("capitals", "exclamations", "digits", "stops", "n_lines")]
    capitals, exclamations, digits, stops, n_lines = counted
    given = [c for c in docs.columns if c not in {text_col, *BASE, *RATIOS}]

    def packed_window(k: Column) -> Column:
        hashed = F.xxhash64(*[F.get(words, k + j) for j in range(WINDOW)])
        return F.shiftleft(hashed, PLACE_BITS).bitwiseOR(k.cast("bigint"))

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), packed_window)
    steps = docs.select(*given, F.coalesce(text_col, F.lit("")).alias(text))
    steps = steps.select(
        *given,
        F.filter(F.split(text, SPACES), lambda w: w != "").alias(words),
        F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias(lines),
        _count_of(F.col(text), "[#*$%&|<>]+").cast("bigint").alias("n_symbols"),
        _count_of(F.col(text), "[A-ZÀ-ÖØ-Þ]+").alias(capitals),
        _count_of(F.col(text), "[!]+").alias(exclamations),
        _count_of(F.col(text), "[0-9]+").alias(digits),
        _count_of(F.col(text), "[.]+").alias(stops),
    )
    kept = [*given, "n_symbols", capitals, exclamations, digits, stops]
    steps = steps.select(
        *kept,
        words,
        F.size(words).cast("bigint").alias("n_words"),
        F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
        F.size(lines).alias(n_lines),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size(words) >= WINDOW, F.sort_array(hashes))
        .otherwise(F.array().cast("array<bigint>"))
        .alias(packed),
    )
    kept += ["n_words", "word_chars", n_lines, "n_dup_lines"]
    steps = steps.select(
        *kept,
        F.sort_array(
            F.transform(
                _repeated_places(words, packed), lambda n: n.bitwiseAND(F.lit(PLACES))
            )
        ).alias(places),
    )
    gaps = F.transform(
        places, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW)))
    )
    steps = steps.select(
        *kept,
        F.aggregate(gaps, F.lit(0).cast("bigint"), lambda n, gap: n + gap).alias("n_repeat_words"),
    )

    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))

    ratios = {
        "mean_word": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", n_lines),
        "repeat_share": share("n_repeat_words", "n_words"),
        "capital_share": share(capitals, "word_chars"),
        "exclamations_per_word": share(exclamations, "n_words"),
        "digit_share": share(digits, "word_chars"),
        "words_per_line": share("n_words", n_lines),
        "stops_per_word": share(stops, "n_words"),
    }
    return steps.select(*given, *BASE, *[ratios[r].alias(r) for r in RATIOS])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        feature, limit = F.col(self.feature), F.lit(self.threshold)
        return feature > limit if self.above else feature <= limit

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; a row that some rule covers is rejected by the first of them."""

    rules: tuple[tuple[Condition, ...], ...]

    def number(self) -> Column:
        """Number of the first rule that covers a row, from 1; null if none does."""
        found = F.lit(None).cast("int")
        for k in range(len(self.rules), 0, -1):
            found = F.when(_all_of(self.rules[k - 1]), F.lit(k)).otherwise(found)
        return found

    def rejects(self) -> Column:
        return self.number().isNotNull()

    def __str__(self) -> str:
        return "\n".join("reject if " + " and ".join(map(str, r)) for r in self.rules)


def _all_of(rule: tuple[Condition, ...]) -> Column:
    covered = F.lit(True)
    for condition in rule:
        covered = covered & condition.column()
    return covered


def learn_rules(rows: DataFrame, features: tuple[str, ...] = (*BASE, *RATIOS)) -> DecisionList:
    """Decision list from a stored table: the features, and `bad` (1 to reject, 0 to keep).

    Rows with a null `bad` are left out. A hash of the features deals rows into two
    thirds to grow rules and one third to prune them. Ties go to the feature that
    stands first and its lowest threshold. Without both kinds of rows the list is
    empty, and an empty list rejects nothing.
    """
    rows = rows.where("bad is not null").select(
        "bad",
        (F.pmod(F.xxhash64(*features), F.lit(3)) == 0).alias("prunes"),
        *[F.col(f).cast("double").alias(f) for f in features],
    )
    steps = [k / QUANTILES for k in range(1, QUANTILES)]
    found = rows.agg(
        *[F.percentile_approx(f, steps, 10_000).alias(f) for f in features],
        F.count_if(F.col("bad") == 1).alias("_bad"),
        F.count_if(F.col("bad") == 0).alias("_good"),
    ).first()
    if not found["_bad"] or not found["_good"]:
        return DecisionList(())
    thresholds = {f: sorted(set(found[f])) for f in features}
    rules: list[tuple[Condition, ...]] = []
    while len(rules) < MOST_RULES:
        left = rows.where(~DecisionList(tuple(rules)).rejects())
        rule = _grown(left.where("not prunes"), thresholds)
        rule = _pruned(left.where("prunes"), rule) if rule else None
        if not rule:
            break
        rules.append(rule)
    return DecisionList(tuple(rules))


def _grown(rows: DataFrame, thresholds: dict[str, list[float]]) -> tuple[Condition, ...]:
    """Conditions added while they gain: each from one grouped count per feature and bin."""
    rule: tuple[Condition, ...] = ()
    while len(rule) < MOST_CONDITIONS:
        counts = _bin_counts(rows.where(_all_of(rule)), thresholds)
        bad = sum(b for b, _ in next(iter(counts.values())))
        good = sum(g for _, g in next(iter(counts.values())))
        if not bad or not good:
            break
        best, gained = None, 0.0
        for feature, bins in counts.items():
            below_bad = below_good = 0
            for limit, (b, g) in zip(thresholds[feature], bins):
                below_bad, below_good = below_bad + b, below_good + g
                for above in (False, True):
                    p = bad - below_bad if above else below_bad
                    n = good - below_good if above else below_good
                    if p < LEAST_COVERED:
                        continue
                    gain = p * (math.log2(p / (p + n)) - math.log2(bad / (bad + good)))
                    if gain > gained + 1e-9:
                        best, gained = Condition(feature, above, limit), gain
        if best is None:
            break
        rule = (*rule, best)
    return rule


def _bin_counts(
    rows: DataFrame, thresholds: dict[str, list[float]]
) -> dict[str, list[tuple[int, int]]]:
    """Per feature and bin the bad and good rows; a bin ends with its threshold."""
    bins = []
    for feature, limits in thresholds.items():
        bins.append(
            F.struct(F.lit(feature).alias("feature"), _bin(F.col(feature), limits).alias("bin"))
        )
    counted = (
        rows.select("bad", F.explode(F.array(*bins)).alias("at"))
        .groupBy("at.feature", "at.bin")
        .agg(F.count_if(F.col("bad") == 1).alias("b"), F.count_if(F.col("bad") == 0).alias("g"))
    )
    found = {f: [(0, 0)] * (len(limits) + 1) for f, limits in thresholds.items()}
    for row in counted.collect():
        found[row["feature"]][row["bin"]] = (row["b"], row["g"])
    return found


def _bin(value: Column, limits: list[float]) -> Column:
    """How many thresholds lie below a value."""
    return F.size(F.filter(F.lit(limits), lambda limit: limit < value))


def _pruned(rows: DataFrame, rule: tuple[Condition, ...]) -> tuple[Condition, ...] | None:
    """The beginning of a rule that is most often right on other rows, if often enough."""
    sums = []
    for size in range(1, len(rule) + 1):
        covered = _all_of(rule[:size])
        sums += [
            F.count_if(covered & (F.col("bad") == 1)).alias(f"b{size}"),
            F.count_if(covered & (F.col("bad") == 0)).alias(f"g{size}"),
        ]
    counts = rows.agg(*sums).first()
    worth = [
        ((counts[f"b{s}"] - counts[f"g{s}"]) / max(1, counts[f"b{s}"] + counts[f"g{s}"]), -s)
        for s in range(1, len(rule) + 1)
    ]
    size = -max(worth)[1]
    bad, good = counts[f"b{size}"], counts[f"g{size}"]
    return rule[:size] if bad and bad >= LEAST_PRECISION * (bad + good) else None
