"""Training that goes on: a word-count model and the files it has taken in.

Word counts add up, so a model is kept as counts together with a ledger of its input
files. An update counts the files that the ledger does not list, adds the counts to the
stored ones and publishes both, counts and ledger, as one version. An update that breaks
leaves no version, so no file is half counted. Of two updates at once the later commit
is the model; files that only the other took in are not in its ledger and come with the
next update.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.operators import commits
from intentloom.operators.classify import WordModel, model_of_counts, word_counts
from intentloom.session import settle

COUNTS, FILES = "counts", "files"


def update_classifier_nb(
    spark: SparkSession, root: str, name: str, path: str | list[str], text: str, label: str
) -> int:
    """Take the Parquet files under `path` that are new into the model; returns how many.

    A file that was rewritten since it was taken in is an error: its earlier words can
    no longer be told from the others.
    """
    listed = settle(_listed(spark, path), "listed-files")
    stored = _stored(spark, root, name)
    if stored is not None:
        ledger = stored[FILES]
        earlier = ledger.select("path", F.struct("length", "modified").alias("before"))
        both = listed.join(earlier, "path")
        changed = both.where(F.struct("length", "modified") != F.col("before")).first()
        if changed is not None:
            raise ValueError(f"{changed['path']} was changed after it had been taken in")
        listed = listed.join(ledger, "path", "left_anti")
    paths = [row["path"] for row in listed.select("path").collect()]  # Spark lists them as well
    if not paths:
        return 0
    counts = word_counts(spark.read.parquet(*paths), text, label)
    tables = {COUNTS: counts, FILES: listed}
    if stored is not None:
        sums = [F.sum(c).alias(c) for c in ("n", "first")]
        tables[COUNTS] = stored[COUNTS].unionByName(counts).groupBy("label", "word").agg(*sums)
        tables[FILES] = stored[FILES].unionByName(listed)
    version = commits.begin(root, name)
    commits.write_tables(version, tables)
    commits.commit(spark, version, list(tables))
    return len(paths)


def load_updated_model(spark: SparkSession, root: str, name: str) -> WordModel:
    """The model as of the newest complete update."""
    stored = _stored(spark, root, name)
    if stored is None:
        raise FileNotFoundError(f"no model {name!r} is published in {root}")
    return model_of_counts(stored[COUNTS])


def files_taken_in(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(path, length, modified) of the files that the model has counted."""
    stored = _stored(spark, root, name)
    if stored is None:
        raise FileNotFoundError(f"no model {name!r} is published in {root}")
    return stored[FILES]


def _stored(spark: SparkSession, root: str, name: str) -> dict[str, DataFrame] | None:
    """Counts and ledger of one version; both are of the same commit."""
    head = commits.newest(spark, root).where(F.col("name") == name).first()
    if head is None:
        return None
    version = commits.Version(root, name, head["version"])
    return {table: spark.read.parquet(version.folder(table)) for table in (COUNTS, FILES)}


def _listed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The Parquet files under a path; their content is not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )
