"""Session defaults and the shared folder that survives lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("intentloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the cluster names it.

    Only a local master gets a folder of our own when the cluster names none: a
    machine-local folder on a cluster would be lost together with its machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    # local-cluster[...] runs executors as processes of their own
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="intentloom-"))
    return context.getCheckpointDir()


#: Paths that were handed out, by application.
_HANDED_OUT: dict[str, list[str]] = {}


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing was written to yet."""
    path = f"{shared_folder(spark)}/intentloom/{name}-{uuid.uuid4().hex}"
    _HANDED_OUT.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete what this application has put under fresh paths; returns how many.

    Results that still read from there can no longer be computed.
    """
    paths = _HANDED_OUT.pop(spark.sparkContext.applicationId, [])
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(configuration).delete(place, True)
    return len(paths)


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write a result used several times to the shared folder and read it back.

    This cuts the lineage, and the files give the optimizer true sizes.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
