"""Atomic publication: versioned folders and one commit file per version.

A version's tables are written to folders of their own that no reader looks at. One
small file, renamed into place when all of them are complete, makes the version
visible as a whole. A publisher that breaks before leaves folders that nothing refers
to; two publishers of one name both commit, and every reader takes the same one of them
for the newest. Commit files have names of their own, so no store has to lock anything.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS = "_commits"
SCHEMA = "name string, sequence bigint, version string, tables array<string>, note string"


@dataclass(frozen=True)
class Version:
    """A version that is being written, or that a commit names."""

    root: str
    name: str
    version: str

    def folder(self, table: str) -> str:
        return f"{self.root}/{table}/version={self.version}"


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as an object of it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def begin(root: str, name: str) -> Version:
    return Version(root, name, uuid.uuid4().hex)


def write_tables(version: Version, tables: dict[str, DataFrame]) -> None:
    """Write tables of a version; a folder that is there already is an error."""
    for table, df in tables.items():
        df.write.mode("error").parquet(version.folder(table))


def commit(spark: SparkSession, version: Version, tables: list[str], note: str = "") -> int:
    """Make a complete version the newest of its name; returns its number.

    The number follows the highest one that is visible now. Two publishers at once may
    take the same number; of these the larger version id counts as newer.
    """
    earlier = read_commits(spark, version.root).agg(F.max("sequence")).first()[0]
    sequence = 0 if earlier is None else earlier + 1
    row = {
        "name": version.name,
        "sequence": sequence,
        "version": version.version,
        "tables": tables,
        "note": note,
    }
    folder = f"{version.root}/{COMMITS}"
    system, hidden = _file_system(spark, f"{folder}/.{version.version}.tmp")
    final = _file_system(spark, f"{folder}/{version.version}.json")[1]
    system.mkdirs(hidden.getParent())
    stream = system.create(hidden, True)
    try:
        stream.write(bytearray(json.dumps(row).encode()))
    finally:
        stream.close()
    if not system.rename(hidden, final):
        raise OSError(f"{final.toString()} could not be committed")
    return sequence


def read_commits(spark: SparkSession, root: str) -> DataFrame:
    """(name, sequence, version, tables, note) of all commits; none if nothing is there."""
    system, folder = _file_system(spark, f"{root}/{COMMITS}")
    if not system.exists(folder):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).json(f"{root}/{COMMITS}")


def newest(spark: SparkSession, root: str) -> DataFrame:
    """The newest commit of each name."""
    latest = F.max_by(F.struct("sequence", "version", "tables", "note"), F.struct("sequence", "version"))
    found = read_commits(spark, root).groupBy("name").agg(latest.alias("_newest"))
    return found.select("name", "_newest.*")


def read_table(spark: SparkSession, root: str, table: str, name_col: str) -> DataFrame:
    """One table of the newest versions of all names, which `name_col` holds.

    The list of versions is read when this is called, so all of a result is of that
    moment, whatever is published later. One short row per name comes to the driver.
    """
    rows = newest(spark, root).where(F.array_contains("tables", table)).collect()
    if not rows:
        raise FileNotFoundError(f"no version with a table {table!r} is published in {root}")
    versions = {r["version"]: Version(root, r["name"], r["version"]) for r in rows}
    folders = [v.folder(table) for v in versions.values()]
    known = spark.createDataFrame(
        [(v.version, v.name) for v in versions.values()], f"version string, `{name_col}` string"
    )
    stored = spark.read.option("basePath", f"{root}/{table}").option("mergeSchema", "true")
    return stored.parquet(*folders).join(F.broadcast(known), "version").drop("version")


def discard_uncommitted(spark: SparkSession, root: str, version: Version, tables: list[str]) -> None:
    """Delete what a publisher that gave up has written; committed versions stay."""
    if read_commits(spark, root).where(F.col("version") == version.version).isEmpty():
        for table in tables:
            system, place = _file_system(spark, version.folder(table))
            system.delete(place, True)
