"""Label names that corpus files carry in their own footers."""

from __future__ import annotations

import json
from collections.abc import Callable

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.operators.scale import fetch_small

#: Footer entries that hold a schema with names: of dataset libraries, and of Spark.
DATASET_ENTRY = b"huggingface"
SPARK_ENTRY = b"org.apache.spark.sql.parquet.row.metadata"


def label_names_from_files(spark: SparkSession, path: str | list[str], column: str) -> DataFrame:
    """(label, intent): the names of the ids in `column`, as the files' footers give them.

    Executors read the footer of every Parquet file, and no rows. Files that name the ids
    differently, or only in part of the files, are an error, as are files without names.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path")
    )
    names = files.select("path", _footer_names(column)(F.col("path")).alias("names"))
    kinds = names.groupBy("names").agg(F.min("path").alias("path")).limit(2).collect()
    if not kinds:
        raise ValueError(f"no Parquet files under {path}")
    if len(kinds) > 1:
        raise ValueError(
            f"the names of {column!r} differ between {kinds[0]['path']} and {kinds[1]['path']}"
        )
    if kinds[0]["names"] is None:
        raise ValueError(f"no file under {path} names the ids of {column!r}")
    rows = list(enumerate(kinds[0]["names"]))
    return spark.createDataFrame(rows, "label bigint, intent string")


def with_label_names(df: DataFrame, column: str, vocab: DataFrame) -> DataFrame:
    """Attach a vocabulary's names to an id column; Parquet files then carry them.

    The ids have to be 0, 1, 2 and so on, and the vocabulary within the broadcast bound,
    as every file repeats it.
    """
    small = fetch_small(vocab.select("label", "intent"))
    if small is None:
        raise ValueError("the vocabulary is too large for the footers of files")
    small = small.sort_by("label")
    if small.column("label").to_pylist() != list(range(small.num_rows)):
        raise ValueError("the ids of the vocabulary are not 0, 1, 2 and so on")
    named = {"names": small.column("intent").to_pylist()}
    return df.withColumn(column, F.col(column).alias(column, metadata=named))


def _footer_names(column: str) -> Callable:
    @F.arrow_udf("array<string>")
    def names(paths: pa.Array) -> pa.Array:
        found = [_names_in(_footer(path), column) for path in paths.to_pylist()]
        return pa.array(found, type=pa.list_(pa.string()))

    return names


def _footer(path: str) -> dict[bytes, bytes]:
    if path.startswith(("file:", "/")):  # Spark's paths are not percent-encoded
        inner = "/" + path.removeprefix("file:").lstrip("/")
        system = pyarrow.fs.LocalFileSystem()
    else:
        system, inner = pyarrow.fs.FileSystem.from_uri(path)
    with system.open_input_file(inner) as file:
        return pyarrow.parquet.read_metadata(file).metadata or {}


def _names_in(footer: dict[bytes, bytes], column: str) -> list[str] | None:
    """Names by id from either entry; the dataset's own entry goes first."""
    if DATASET_ENTRY in footer:
        info = json.loads(footer[DATASET_ENTRY]).get("info") or {}
        names = ((info.get("features") or {}).get(column) or {}).get("names")
        if names is not None:
            return names
    if SPARK_ENTRY in footer:
        for field in json.loads(footer[SPARK_ENTRY])["fields"]:
            if field["name"] == column:
                return field["metadata"].get("names")
    return None
