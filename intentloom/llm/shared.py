"""Helpers that several of these operators use."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

#: A-Z to a-z in UTF-8 bytes; all other bytes stay, so other letters keep their case.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """A column name made from `name` that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Rows of a batch that are worked on, and answered, at a time.
ROWS = 512


def slices(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The batches in small parts; at the end of a task its free memory is given back."""
    for batch in batches:
        for start in range(0, len(batch), ROWS):
            yield batch.slice(start, ROWS)
        del batch
    pa.default_memory_pool().release_unused()


def per_text(kind: pa.DataType, ddl: str, make: Callable[[], Callable]) -> Callable:
    """Arrow UDF from a text (null: empty) to one value.

    `make` runs once per task and returns the function of one text; what it loads
    is kept by the worker, see `once`.
    """

    @F.arrow_udf(ddl)
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        function = make()
        for part in slices(batches):
            yield pa.array([function(text or "") for text in part.to_pylist()], type=kind)

    return apply


_KEPT: dict = {}


def once(key: object, build: Callable) -> object:
    """Build something once per Python worker; only the latest few are kept."""
    if key not in _KEPT:
        while len(_KEPT) >= 8:
            _KEPT.pop(next(iter(_KEPT)))
        _KEPT[key] = build()
    return _KEPT[key]


def release() -> None:
    """Give back what a worker keeps of other work, before work that needs none of it."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """Arrow list array of numpy arrays."""
    sizes = np.fromiter(map(len, values), dtype=np.int32, count=len(values))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat).cast(kind))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
