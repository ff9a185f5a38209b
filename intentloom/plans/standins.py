"""Inputs of the registered queries, derived from the driver's tables.

Every frame covers the whole of the tables it is made from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.functions import fixed
from intentloom.functions.text import iso_utc, normalize_text
from intentloom.operators.scale import lookup_join
from intentloom.sources.corpus import label_dim, union_splits

END_MARK = "</s>"
ANSWER_HEAD = f"### Instruction:\nx\n{fixed.ANSWER_MARK}\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a stream of files."""
    schema = table(spark, sf_dir, name).schema
    # as a glob: a stream does not take the plain path of a single file
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled corpus (doc_id, text, intent): the intent is the source."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.col("source").alias("intent")
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, text, intent, split): documents to train on, web pages to test on."""
    train = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "text", F.col("lang").alias("intent")
    )
    test = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), F.col("html").alias("text"), page_language().alias("intent")
    )
    return union_splits({"train": train, "test": test})


def raw_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, text, intent) with copies, blank texts and missing labels."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "text", F.col("lang").alias("intent")
    )
    feed = messages(table(spark, sf_dir, "conversations")).select(
        (-1 - F.col("conv_id") * 1000 - F.col("turn")).alias("id"),
        F.col("message").alias("text"),
        F.when(F.col("turn") % 4 != 3, F.lit("feed")).alias("intent"),
    )
    return docs.unionByName(feed)


def page_language() -> Column:
    return F.regexp_extract("html", '<html lang="([a-z]+)"', 1)


def source_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_dim(table(spark, sf_dir, "documents"), "source")


def language_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_dim(table(spark, sf_dir, "documents"), "lang")


def part_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary of two-word names joined by an underscore."""
    return label_dim(table(spark, sf_dir, "part").select(part_label().alias("name")), "name")


def part_label() -> Column:
    return F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))


def generations(parts: DataFrame) -> DataFrame:
    """(row_id, run, y_true, decoded): eight kinds of answers to the parts' names."""
    label = part_label()
    noun = F.substring_index("p_name", " ", -1)
    answers = [
        label,
        F.upper(label),
        F.concat(F.lit("  "), F.col("p_name"), F.lit("  ")),
        F.left(label, F.length(label) - 2),
        F.reverse(F.col("p_name")),
        F.concat(F.lit("new_"), noun),
        F.concat(label, F.lit("\nextra line")),
        F.lit(""),
    ]
    kind = F.col("p_partkey") % len(answers)
    answer = F.coalesce(*[F.when(kind == i, a) for i, a in enumerate(answers)])
    return parts.select(
        F.col("p_partkey").alias("row_id"),
        F.replace(F.col("p_brand"), F.lit("#"), F.lit("_")).alias("run"),
        label.alias("y_true"),
        F.concat(F.lit(ANSWER_HEAD), answer).alias("decoded"),
    )


def messages(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, message): a feed with blank messages and control words."""
    message = (
        F.when(F.col("role") == "user", F.col("text"))
        .when(F.col("role") == "system", F.lit(" \t "))
        .when(F.length("text") > 1000, F.lit(" QUIT\n"))
        .otherwise(F.concat(F.lit("q "), F.col("text")))
    )
    return conversations.select("conv_id", "turn", message.alias("message"))


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, content): report texts with none, one or two accuracy figures."""
    figure = F.concat(F.col("n_chars") % 100, F.lit("."), F.col("doc_id") % 10)
    heading = F.concat(F.lit(fixed.ACCURACY_HEADING), figure, F.lit("%\n\n"))
    whole = F.concat(F.lit(f"{fixed.ACCURACY_HEADING} "), F.col("n_chars") % 100, F.lit("%"))
    content = (
        F.when(F.col("lang") == "es", F.col("text"))
        .when(F.col("lang") == "de", F.concat(F.col("text"), F.lit("\n"), whole))
        .otherwise(F.concat(heading, F.col("text"), F.lit("\n"), whole))
    )
    return table(spark, sf_dir, "documents").select("doc_id", content.alias("content"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per user: the first event dates it, errors leave no accuracy."""
    first = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.min_by(F.struct("event_id", "ts", "event_type", "value"), "event_id").alias("_")
    )
    name = F.concat(F.lit("run_"), F.col("user_id"))
    return first.select(
        name.alias("run_name"),
        iso_utc(F.col("_.ts")).alias("created_at_utc"),
        F.concat(F.lit("outputs/"), name).alias("outputs"),
        F.lit("sample_data").alias("sample_data"),
        F.lit("configs").alias("configs"),
        F.when(F.col("_.event_type") != "error", (F.col("_.event_id") % 100).cast("string")).alias(
            "test_accuracy_percent"
        ),
    )


def clean_documents(spark: SparkSession, sf_dir: str, vocab: DataFrame) -> DataFrame:
    """(doc_id, text, label, intent) ready for records: normalized and labelled."""
    rows = documents(spark, sf_dir).withColumn("text", normalize_text(F.col("text")))
    return lookup_join(rows, vocab, "intent", "inner", ["doc_id"])
