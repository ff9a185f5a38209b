"""Reports, manifests and snapshots of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom import schemas
from intentloom.functions.text import version_number
from intentloom.operators import commits

# What a run consists of; publishing it without one of these is an error.
RUN_TABLES = ("outputs", "sample_data", "configs")


def read_eval_reports(spark: SparkSession, path: str) -> DataFrame:
    """(path, content): one row per report file, each read whole."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")
    )


def write_run_manifest(runs: DataFrame, path: str, mode: str = "append") -> None:
    """Write one JSON manifest per run; a missing accuracy is kept as null.

    `runs`: run_name, created_at_utc, outputs, sample_data, configs,
    test_accuracy_percent, all strings.
    """
    runs.select(manifest_text().alias("value")).write.mode(mode).text(path)


def manifest_text() -> Column:
    """The JSON manifest of a row with the columns of `write_run_manifest`."""
    manifest = F.struct(
        "run_name",
        "created_at_utc",
        F.struct(*RUN_TABLES).alias("source_paths"),
        "test_accuracy_percent",
    )
    return F.to_json(manifest, {"ignoreNullFields": "false"})


def read_run_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All manifests as one flat table, the accuracy as text and as a number."""
    return _flat(spark.read.schema(schemas.MANIFEST).json(path))


def read_published_ledger(spark: SparkSession, root: str) -> DataFrame:
    """The ledger of what `publish_run` has published, one row per run."""
    texts = read_published_manifests(spark, root)
    read = F.from_json("manifest", schemas.MANIFEST).alias("_")
    return _flat(texts.select(read).select("_.*"))


def _flat(manifests: DataFrame) -> DataFrame:
    return manifests.select(
        "run_name",
        "created_at_utc",
        "source_paths.*",
        "test_accuracy_percent",
        F.col("test_accuracy_percent").cast("double").alias("test_accuracy"),
    )


def latest_run(ledger: DataFrame) -> DataFrame:
    """One row: newest run and its accuracy; equal times go to the larger name."""
    newest = F.max_by(
        F.struct("run_name", "created_at_utc", "test_accuracy_percent"),
        F.struct(F.to_timestamp("created_at_utc"), "run_name"),
    )
    return ledger.agg(newest.alias("_")).where("_ is not null").select("_.*")


def latest_version(paths: DataFrame) -> DataFrame:
    """(run, version): highest checkpoint number of each run, by number."""
    versions = paths.select("run", version_number(F.col("path")).alias("version"))
    return versions.where("version is not null").groupBy("run").agg(
        F.max("version").alias("version")
    )


def snapshot_run(
    tables: dict[str, DataFrame], run_name: str, root: str, manifest: str = ""
) -> None:
    """Publish the tables of a run, and its manifest; the same name again replaces them.

    All of it becomes visible with one commit: a reader sees the tables and the manifest
    of one publication, or those of the one before. What a broken publication has
    written is never read.
    """
    missing = [name for name in RUN_TABLES if tables.get(name) is None]
    if missing:
        raise FileNotFoundError(f"run {run_name!r} lacks {', '.join(missing)}")
    if not run_name.strip():
        raise ValueError("a run needs a name")
    spark = next(iter(tables.values())).sparkSession
    version = commits.begin(root, run_name)
    commits.write_tables(version, tables)
    commits.commit(spark, version, sorted(tables), manifest)


def read_snapshots(spark: SparkSession, root: str, table: str) -> DataFrame:
    """One table of all published runs, with `run_name` as a text column."""
    return commits.read_table(spark, root, table, "run_name")


def read_published_manifests(spark: SparkSession, root: str) -> DataFrame:
    """(manifest) of the newest publication of each run that has one."""
    return commits.newest(spark, root).where("note <> ''").select(F.col("note").alias("manifest"))
