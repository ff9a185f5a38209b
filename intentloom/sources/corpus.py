"""Corpus files, label vocabularies and instruction-tuning tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom import schemas
from intentloom.functions.text import strip_message
from intentloom.operators.scale import numbered
from intentloom.sources.quoted import read_quoted_csv

# Quotes are doubled, and text may hold line breaks and outer blanks.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# Other readers take a multi-line CSV file in one task, so files are kept small for them.
CSV_FILE_ROWS = 200_000


def union_splits(splits: dict[str, DataFrame]) -> DataFrame:
    """One table of all splits with a `split` column, so each step runs once."""
    parts = [df.withColumn("split", F.lit(name)) for name, df in splits.items()]
    return reduce(DataFrame.unionByName, parts)


def scan_corpus(
    spark: SparkSession, files: dict[str, str | list[str]], schema: str = schemas.RAW_TEXT
) -> DataFrame:
    """Read the Parquet files (paths or globs) of each split into one table."""
    return union_splits(
        {
            split: spark.read.schema(schema).parquet(*_as_list(paths))
            for split, paths in files.items()
        }
    )


def _as_list(paths: str | list[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def label_dim(df: DataFrame, name_col: str) -> DataFrame:
    """Label table (label, intent): the distinct names numbered in name order."""
    names = df.select(F.col(name_col).alias("intent")).where("intent is not null")
    return numbered(names.distinct(), ["intent"], "label").select("label", "intent")


def vocab_from_data(df: DataFrame, col: str = "output") -> DataFrame:
    """Vocabulary for want of a label file: the sorted distinct outputs."""
    return label_dim(df, col)


def load_label_vocab(spark: SparkSession, path: str) -> DataFrame:
    """Read a label file: lines trimmed, blank ones dropped, order kept.

    Files are split for reading; file name, block start and the sequence inside
    the task together give back the order of the lines.
    """
    lines = (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_line"),
            strip_message(F.col("value")).alias("intent"),
        )
        .where("intent != ''")
    )
    return numbered(lines, ["_file", "_block", "_line"], "label").select("label", "intent")


def write_label_vocab(vocab: DataFrame, path: str) -> None:
    """Write the vocabulary one label per line; part files are in label order."""
    vocab.orderBy("label").select("intent").write.mode("overwrite").text(path)


def write_sft_dataset(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write instruction-tuning records, one folder per split."""
    records = df.select(*schemas.SFT_COLUMNS, "split")
    writer = records.write.mode("overwrite").partitionBy("split")
    if fmt == "csv":
        writer.options(**CSV_OPTIONS, maxRecordsPerFile=CSV_FILE_ROWS).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}: use 'parquet' or 'csv'")


def read_sft_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read instruction-tuning records from CSV; an empty field is null.

    Files of any size are read by many tasks, although texts may hold line breaks. The
    header is checked against the schema instead of being skipped.
    """
    return read_quoted_csv(spark, path, schemas.SFT, CSV_OPTIONS)
