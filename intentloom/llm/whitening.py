"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

Entries become integers, so sums, products and the scatter matrix are exact whatever
the order in which Spark adds them up. The eigenvalues are roots of the scatter's
characteristic polynomial (see `charpoly`), the components its null spaces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.llm import charpoly
from intentloom.llm.shared import unused
from intentloom.session import settle

SCALE = 64
#: Entries of this size and more, times SCALE, don't fit the integers and are left out.
LARGEST = 2**62
LIMB = 30
PRIMES_A_TASK = 16
CELLS = "cell bigint, limb int, value bigint"


def quantized(vector: Column) -> Column:
    """array<bigint> of floor(SCALE * entry); null if an entry is null or not finite.

    A constant that is added to every entry changes nothing that is centred, so none is.
    """
    wide = F.transform(vector, lambda c: c.cast("double") * SCALE)
    fits = F.forall(wide, lambda c: F.coalesce(F.abs(c) < float(LARGEST), F.lit(False)))
    return F.when(fits, F.transform(wide, lambda c: F.floor(c)))


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: bounded by the dimensions, whatever the number of rows."""

    dimensions: int
    fitted: int
    sums: tuple[int, ...]
    trace: int
    roots: tuple[Decimal, ...]
    components: np.ndarray

    def explained(self) -> list[float]:
        return [float(root / self.trace) for root in self.roots]

    def scales(self) -> np.ndarray:
        """What a centred row (times the number of fitted rows) is multiplied with."""
        factors = [float(1 / root.sqrt()) for root in self.roots]
        return self.components * np.array(factors)[:, None]


def _rows(batch: pa.Array, dimensions: int) -> np.ndarray:
    return batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _products(rows: np.ndarray) -> np.ndarray:
    """Exact sums of products of the columns, as Python integers."""
    largest = max(int(rows.max()), -int(rows.min())) if rows.size else 0
    if largest * largest * len(rows) < 2**53:
        wide = rows.astype(np.float64)
        return (wide.T @ wide).astype(np.int64).astype(object)
    if largest * largest * len(rows) < 2**63:
        return (rows.T @ rows).astype(object)
    exact = rows.astype(object)
    return exact.T.dot(exact)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """The value in parts whose sums over any number of tasks fit a long."""
    sign, rest, number = (1 if value >= 0 else -1), abs(value), 0
    while rest:
        yield number, sign * (rest & ((1 << LIMB) - 1))
        rest >>= LIMB
        number += 1


def scatter(fit: DataFrame, column: str, dimensions: int) -> tuple[int, list[int], list[list[int]]]:
    """Rows, sums, and n * (sums of products) - sums * sums, all exact.

    Every task sends its sums, of which there are about half the square of the
    dimensions; they are added up by cell.
    """
    upper = [(i, j) for i in range(dimensions) for j in range(i, dimensions)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((dimensions, dimensions), dtype=object)
        first, count = np.zeros(dimensions, dtype=object), 0
        for batch in batches:
            rows = _rows(batch.column(0), dimensions)
            products = products + _products(rows)
            first = first + rows.astype(object).sum(axis=0) if len(rows) else first
            count += len(rows)
        cells = [int(products[i, j]) for i, j in upper] + [int(v) for v in first] + [count]
        parts = [(k, limb, part) for k, v in enumerate(cells) for limb, part in _limbs(v)]
        columns = list(zip(*parts)) or [[], [], []]
        kinds = (pa.int64(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds)], ["cell", "limb", "value"]
        )

    added = fit.select(column).mapInArrow(sums, CELLS)
    found = added.groupBy("cell", "limb").agg(F.sum("value").alias("value")).toArrow()
    values = [0] * (len(upper) + dimensions + 1)
    for cell, limb, value in zip(*(found.column(c).to_pylist() for c in ("cell", "limb", "value"))):
        values[cell] += value << (LIMB * limb)
    count, first = values[-1], values[len(upper) : -1]
    matrix = [[0] * dimensions for _ in range(dimensions)]
    for (i, j), value in zip(upper, values):
        matrix[i][j] = matrix[j][i] = count * value - first[i] * first[j]
    return count, first, matrix


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients, lowest first; the primes are dealt over Spark's tasks."""
    size = len(matrix)
    count = charpoly.primes_needed(sum(matrix[i][i] for i in range(size)), size)
    moduli = charpoly.primes(count)

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [moduli[k] for k in batch.column(0).to_pylist()]
            if own:
                found = charpoly.polynomials_modulo(matrix, own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int64()), pa.array(list(found), pa.list_(pa.int64()))],
                    ["prime", "coefficients"],
                )

    tasks = -(-count // PRIMES_A_TASK)
    dealt = spark.range(0, count, 1, tasks).mapInArrow(
        residues, "prime bigint, coefficients array<bigint>"
    )
    found = dealt.toArrow()
    return charpoly.remaindered(
        found.column("coefficients").to_pylist(), found.column("prime").to_pylist()
    )


def fit_whitening(fit: DataFrame, column: str, components: int) -> Whitening | None:
    """Fit on all rows of `fit`, whose `column` holds integer lists of one length.

    None if there is no variance. Components without variance are not counted, so there
    may be fewer than asked for.
    """
    spark = fit.sparkSession
    dimensions = fit.select(F.max(F.size(column))).first()[0] or 0
    if not dimensions:
        return None
    count, first, matrix = scatter(fit, column, dimensions)
    trace = sum(matrix[i][i] for i in range(dimensions))
    if not trace:
        return None
    polynomial = characteristic_polynomial(spark, matrix)
    found = charpoly.largest_roots(polynomial, components)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                root, multiplicity = found[k]
                own = charpoly.null_vectors(matrix, root, multiplicity)
                values = [[float(x) for x in v] for v in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(values), pa.int64()), pa.array(values, pa.list_(pa.float64()))],
                    ["root", "vector"],
                )

    rows = spark.range(0, len(found), 1, len(found)).mapInArrow(
        vectors, "root bigint, vector array<double>"
    ).collect()
    rows = sorted(rows, key=lambda r: r["root"])[:components]
    directions = np.array([r["vector"] for r in rows])
    # of the two signs the one in which the largest entry is positive
    largest = np.abs(directions).argmax(axis=1)
    directions *= np.sign(directions[np.arange(len(rows)), largest])[:, None]
    with localcontext() as context:
        context.prec = charpoly.DIGITS
        roots = tuple(found[r["root"]][0] for r in rows)
    return Whitening(dimensions, count, tuple(first), trace, roots, directions)


def _centred(rows: np.ndarray, fitted: int, sums: np.ndarray) -> np.ndarray:
    """n * row - sums, exact: longs where they surely fit, else Python integers."""
    largest = max(int(rows.max()), -int(rows.min())) if rows.size else 0
    if largest * fitted + max(abs(int(s)) for s in sums) < 2**62:
        return rows * np.int64(fitted) - sums.astype(np.int64)
    return rows.astype(object) * fitted - sums


def _deviations(centred: np.ndarray) -> list[int | None]:
    """Sums of squares; null where one does not fit a long."""
    largest = int(np.abs(centred).max()) if centred.size else 0
    if centred.dtype != object and largest * largest * centred.shape[1] < 2**63:
        return (centred * centred).sum(axis=1).tolist()
    exact = (centred.astype(object) ** 2).sum(axis=1)
    return [int(v) if v < 2**63 else None for v in exact]


def identity_error(fit: DataFrame, column: str, model: Whitening) -> float:
    """Largest difference of the fitted rows' whitened covariance from the identity.

    Measured on the values themselves in a pass over all fitted rows; the rows are
    centred before they are multiplied.
    """
    sums, scales, size = np.array(model.sums, dtype=object), model.scales(), len(model.roots)
    fitted, dimensions = model.fitted, model.dimensions

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            centred = _centred(_rows(batch.column(0), dimensions), fitted, sums)
            white = centred.astype(np.float64) @ scales.T
            total += white.T @ white / fitted
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size * size), pa.int64()), pa.array(total.ravel())], ["cell", "value"]
        )

    parts = fit.select(column).mapInArrow(products, "cell bigint, value double")
    found = parts.groupBy("cell").agg(F.sum("value").alias("value")).collect()
    return max(abs(r["value"] - (r["cell"] % (size + 1) == 0)) for r in found)


def whiten(
    embeddings: DataFrame,
    components: int = 16,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The whitened coordinates of every vector, one row per vector and component.

    Entries count as floor(SCALE * entry). The fit is over the distinct vectors, each
    once; every row is then projected. Returns `id_col`, `component` (from 1, by falling
    eigenvalue), `n` (distinct vectors), `deviation` (sum of squares of n * x - sums,
    exact; null if it does not fit a long), `whitened`, `explained` and `identity_error`.

    Rows are left out if the vector is null or empty, holds an entry that is null, not
    finite or not below LARGEST, or has another length than most distinct vectors (of
    equally frequent lengths the longer one). Repeated rows and null ids give rows of
    their own. Components without variance are not returned; if all vectors are equal,
    or there are none, the result is empty. Other columns are not read, so they may have
    any names.
    """
    spark = embeddings.sparkSession
    row_id = unused(embeddings, "_id")
    rows = embeddings.select(
        F.col(id_col).alias(row_id), quantized(F.col(vector_col)).alias("_vector")
    ).where(F.size("_vector") > 0)
    fit = settle(rows.select("_vector").distinct(), "distinct-vectors")
    lengths = fit.groupBy(F.size("_vector").alias("n")).count()
    usual = lengths.orderBy(F.desc("count"), F.desc("n")).first()
    fit = fit.where(F.size("_vector") == (usual["n"] if usual else 0))
    model = fit_whitening(fit, "_vector", components)
    if model is None:
        return spark.createDataFrame(
            [],
            f"`{id_col}` {rows.schema[row_id].dataType.simpleString()}, component int, n bigint,"
            " deviation bigint, whitened double, explained double, identity_error double",
        )
    error = identity_error(fit, "_vector", model)
    sums, scales = np.array(model.sums, dtype=object), model.scales()
    fitted, dimensions = model.fitted, model.dimensions

    @F.arrow_udf("struct<deviation:bigint,whitened:array<double>>")
    def project(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            centred = _centred(_rows(batch, dimensions), fitted, sums)
            white = centred.astype(np.float64) @ scales.T
            ends = np.arange(len(white) + 1, dtype=np.int32) * white.shape[1]
            yield pa.StructArray.from_arrays(
                [
                    pa.array(_deviations(centred), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(white.ravel())),
                ],
                names=["deviation", "whitened"],
            )

    explained = F.array(*[F.lit(v) for v in model.explained()])
    placed = rows.where(F.size("_vector") == dimensions).withColumn(
        "_projected", project(F.col("_vector"))
    )
    return placed.select(
        row_id, "_projected.deviation", F.posexplode("_projected.whitened").alias("_at", "whitened")
    ).select(
        F.col(row_id).alias(id_col),
        (F.col("_at") + 1).cast("int").alias("component"),
        F.lit(fitted).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("_at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
