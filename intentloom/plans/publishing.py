"""Publishing a finished run: its tables, its manifest and its place in the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentloom.functions.text import iso_utc, percent_text, run_name, utc_wall_clock
from intentloom.operators.ledger import RUN_TABLES, manifest_text, snapshot_run


def publish_run(
    tables: dict[str, DataFrame],
    report: DataFrame,
    root: str,
    name: str = "",
    created_at: Column | None = None,
) -> str:
    """Store tables and manifest of a run under its name; returns the name.

    Without a name the run is named by its time, a UTC TIMESTAMP_NTZ column and now by
    default. Tables and manifest become visible together, with one commit; publishing
    a name again replaces both. `read_published_ledger` lists what is published,
    `latest_run` the newest.
    """
    at = utc_wall_clock(F.current_timestamp()) if created_at is None else created_at
    accuracy = F.max(F.when(F.col("section") == "accuracy", percent_text(F.col("f1"))))
    manifest = (
        report.agg(accuracy.alias("test_accuracy_percent"))
        .withColumn("_at", at)
        .select(
            run_name(F.lit(name), F.col("_at")).alias("run_name"),
            iso_utc(F.col("_at")).alias("created_at_utc"),
            *[F.lit(t).alias(t) for t in RUN_TABLES],
            "test_accuracy_percent",
        )
    )
    row = manifest.select("run_name", manifest_text().alias("manifest")).first()
    snapshot_run(tables, row["run_name"], root, row["manifest"])
    return row["run_name"]
