"""Evaluation of prediction pairs (y_true, y_pred).

Everything but the running accuracy is derived from `confusion_counts`, so the
pairs are aggregated once, map-side first, and what follows is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.functions import fixed
from intentloom.functions.text import percent_text
from intentloom.operators.scale import running_sums

CLASS_SECTION = "class"
SCORES = ["precision", "recall", "f1"]
NAME_WIDTH = len("weighted avg")


def accuracy(preds: DataFrame) -> DataFrame:
    """One row: share of rows where truth and prediction agree."""
    return preds.agg(F.avg(_is_hit().cast("int")).alias("accuracy"))


def running_accuracy(preds: DataFrame, every: int = fixed.ACCURACY_EVERY) -> DataFrame:
    """(rows, accuracy) after each full block of rows.

    `row_id` numbers the rows from 0 without gaps; a last block that is not full
    is not reported.
    """
    blocks = accuracy_blocks(preds, every)
    return merge_accuracy_blocks(blocks, every)


def accuracy_blocks(preds: DataFrame, every: int) -> DataFrame:
    """(block, rows, correct): partial sums that add up in any order."""
    return preds.groupBy(F.floor(F.col("row_id") / every).alias("block")).agg(
        F.count("*").alias("rows"), F.sum(_is_hit().cast("int")).alias("correct")
    )


def merge_accuracy_blocks(blocks: DataFrame, every: int) -> DataFrame:
    sums = running_sums(
        blocks.withColumn("_in_block", F.col("rows")), "block", ["rows", "correct"]
    )
    return sums.where(F.col("_in_block") == every).select(
        "rows", (F.col("correct") / F.col("rows")).alias("accuracy")
    )


def report_label_set(preds: DataFrame) -> DataFrame:
    """Labels seen in truth or predictions."""
    both = F.explode(F.array("y_true", "y_pred")).alias("label")
    return preds.select(both).distinct()


def confusion_counts(preds: DataFrame, rows: Column | None = None) -> DataFrame:
    """(y_true, y_pred, rows); `rows` weights input that is already counted."""
    counted = F.count("*") if rows is None else F.sum(rows)
    return preds.groupBy("y_true", "y_pred").agg(counted.alias("rows"))


def class_report(confusion: DataFrame) -> DataFrame:
    """(label, precision, recall, f1, support) per label; 0/0 counts as 0."""
    return _class_scores(confusion).drop("hits")


def report_averages(confusion: DataFrame) -> DataFrame:
    """(section, precision, recall, f1, support): accuracy, macro, weighted.

    The macro average is the plain mean over all labels, including those that
    only occur as predictions. The accuracy row has its figure in `f1`.
    """
    total = F.sum("support")

    def row(section_no: int, section: str, figures: list[Column]) -> Column:
        values = [v.alias(s) for v, s in zip(figures, SCORES)]
        return F.struct(
            F.lit(section_no).alias("section_no"), F.lit(section).alias("section"), *values
        )

    empty = F.lit(None).cast("double")
    rows = F.array(
        row(1, "accuracy", [empty, empty, F.sum("hits") / total]),
        row(2, "macro avg", [F.avg(s) for s in SCORES]),
        row(3, "weighted avg", [F.sum(F.col(s) * F.col("support")) / total for s in SCORES]),
    )
    return (
        _class_scores(confusion)
        .agg(rows.alias("rows"), total.alias("support"))
        .where("support > 0")
        .select(F.inline("rows"), "support")
    )


def full_report(confusion: DataFrame) -> DataFrame:
    """Class rows in label order, then accuracy, macro and weighted average."""
    classes = class_report(confusion).select(
        F.lit(0).alias("section_no"), F.lit(CLASS_SECTION).alias("section"), "*"
    )
    averages = report_averages(confusion).withColumn("label", F.lit(None).cast("string"))
    return classes.unionByName(averages).orderBy("section_no", "label")


def compare_runs(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two runs' reports side by side, from their confusion counts.

    (section_no, section, label, first_f1, second_f1, f1_change, first_support,
    second_support). A label that only one run knows has nulls on the other side. Rows
    without a prediction are a class of their own, whose label is null.
    """
    key = ["section_no", "section", "label"]
    sides = []
    for name, confusion in (("first", first), ("second", second)):
        figures = [F.col(c).alias(f"{name}_{c}") for c in ("f1", "support")]
        names = [F.col(c).alias(f"{name}_{c}") for c in key]
        sides.append(full_report(confusion).select(*names, *figures))
    # a label is null in the averages and may be null in a class; the sections differ
    same = [F.col(f"first_{c}").eqNullSafe(F.col(f"second_{c}")) for c in ("section_no", "label")]
    joined = sides[0].join(sides[1], same[0] & same[1], "full")
    return joined.select(
        *[F.coalesce(f"first_{c}", f"second_{c}").alias(c) for c in key],
        "first_f1",
        "second_f1",
        (F.col("second_f1") - F.col("first_f1")).alias("f1_change"),
        "first_support",
        "second_support",
    )


def report_lines(report: DataFrame, width: int) -> DataFrame:
    """The text form of a report, (position, label, line) in reading order.

    The layout is the usual one of classification reports: names right-aligned to
    `width`, two decimals, the averages set apart.
    """

    def row(name: Column, *cells: Column) -> Column:
        return F.concat(_right(name, width), F.lit(" "), *[_right(c, 10) for c in cells])

    def position(place: int, text: Column) -> Column:
        return F.struct(F.lit(place).alias("position"), text.alias("line"))

    share = {c: F.coalesce(F.format_number(c, 2), F.lit("")) for c in SCORES}
    own = F.struct(
        (F.col("section_no") * 10).alias("position"),
        row(
            F.coalesce("label", "section"), *share.values(), F.col("support").cast("string")
        ).alias("line"),
    )
    blank = F.lit("")
    heads = [F.lit(h) for h in ("precision", "recall", "f1-score", "support")]
    accuracy_line = F.concat(
        F.lit(fixed.ACCURACY_HEADING), percent_text(F.col("f1")), F.lit("%")
    )
    around = F.array(
        position(-5, accuracy_line),
        position(-4, blank),
        position(-3, F.lit(fixed.REPORT_HEADING)),
        position(-2, row(blank, *heads)),
        position(-1, blank),
        position(5, blank),
        own,
        position(40, blank),
    )
    # the one accuracy row brings along the lines that are there once
    lines = F.when(F.col("section") == "accuracy", around).otherwise(F.array(own))
    return report.select("label", F.inline(lines)).select("position", "label", "line")


def write_eval_report(report: DataFrame, path: str) -> None:
    """Write a report as a table and as text; text part files are in line order."""
    report.write.mode("overwrite").parquet(f"{path}/table")
    stored = read_eval_table(report.sparkSession, path)
    names = stored.agg(F.max(F.length(F.coalesce("label", "section"))).alias("width"))
    width = max(names.first()["width"] or 0, NAME_WIDTH)
    lines = report_lines(stored, width).orderBy("position", "label").select("line")
    lines.write.mode("overwrite").text(f"{path}/text")


def read_eval_table(spark: SparkSession, path: str) -> DataFrame:
    """The table form of a written report."""
    return spark.read.parquet(f"{path}/table")


def _is_hit() -> Column:
    """Never null: a missing prediction is a miss, and so is a missing truth."""
    return F.coalesce(F.col("y_true") == F.col("y_pred"), F.lit(False))


def _right(text: Column, width: int) -> Column:
    """Right-aligned, and never cut."""
    padding = F.greatest(F.lit(width) - F.length(text), F.lit(0))
    return F.concat(F.repeat(F.lit(" "), padding), text)


def _class_scores(confusion: DataFrame) -> DataFrame:
    """Scores per label from one pass: each pair counts for both of its labels."""
    hits = F.when(_is_hit(), F.col("rows")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(
            F.col("y_true").alias("label"),
            F.col("rows").alias("support"),
            zero.alias("predicted"),
            hits.alias("hits"),
        ),
        F.struct(
            F.col("y_pred").alias("label"),
            zero.alias("support"),
            F.col("rows").alias("predicted"),
            zero.alias("hits"),
        ),
    )
    sums = (
        confusion.select(F.inline(sides))
        .groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    hit = F.col("hits")
    return sums.select(
        "label",
        share(hit, F.col("predicted")).alias("precision"),
        share(hit, F.col("support")).alias("recall"),
        share(2 * hit, F.col("support") + F.col("predicted")).alias("f1"),
        "support",
        "hits",
    )
