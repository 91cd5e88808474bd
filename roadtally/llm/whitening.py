"""Embedding whitening by shifted CholeskyQR: centred rows are orthogonalised in passes, the composed factor is decomposed.

An entry c becomes the integer x = floor(64 c) + 1000000. A pass sums the Gram matrix of the centred rows after the triangular
solves with the factors so far; its Cholesky factor is the next one. While the Gram matrix is nearly singular a small
multiple of the identity is added first, so that the factorisation succeeds and the next pass starts from better
conditioned rows; passes end once the rows are orthonormal. The singular values and right vectors of the product of all factors
give the variances and components, without squaring the condition number. Variances within rounding of zero, those of constant
or dependent dimensions, have no component.

Left out are vectors that are null, hold a null, a non-finite entry or one beyond 2^46 in size (its x is no exact double), or
have another length than most of them (ties: the longest). No or only equal vectors give no rows. Repeated rows count as often
as they occur, a null id is kept, other columns are ignored. A deviation that does not fit a long is null.

Only matrices of dimension x dimension reach the driver; their size does not depend on the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadtally.llm.common import written

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
LARGEST_ENTRY = float(1 << 46)
# The passes end once no entry of the Gram matrix is further from the identity; the last factor then is exact to rounding.
ORTHONORMAL = 1e-8
PASSES = 12
# Below this smallest eigenvalue of the scaled Gram matrix the identity is added, times so much per dimension.
SINGULAR, ADDED = 1e-9, 1e-14
_LONG = float((1 << 63) - 1024)


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _integers(column: pa.Array, dimension: int) -> np.ndarray:
    return np.floor(_matrix(column, dimension) * SCALE).astype(np.int64) + SHIFT


def _sums(dimension: int):
    """Per task the number of rows and the exact sums of the integers, as text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, [0] * dimension, [0] * dimension
        for batch in batches:
            x = _integers(batch.column("vector"), dimension)
            n += len(x)
            high = [a + int(b) for a, b in zip(high, (x >> 32).sum(axis=0), strict=True)]
            low = [a + int(b) for a, b in zip(low, (x & 0xFFFFFFFF).sum(axis=0), strict=True)]
        sums = [str((a << 32) + b) for a, b in zip(high, low, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dimension), pa.int32()), pa.array([n] * dimension, pa.int64()), pa.array(sums)],
            ["i", "n", "total"],
        )

    return run


def _differences(x: np.ndarray, n: int, totals: list[int]) -> np.ndarray:
    """n x - S; as Python integers where 64 bits are too few."""
    if len(x) and max(int(abs(x).max()) * n, max(map(abs, totals))) >= 1 << 62:
        return x.astype(object) * n - np.array(totals, object)
    return x * n - np.array(totals, np.int64)


def _deviations(differences: np.ndarray) -> pa.Array:
    small = (differences.astype(float) ** 2).sum(axis=1) < _LONG / 2
    if differences.dtype != object and small.all():
        return pa.array((differences * differences).sum(axis=1))
    exact = [sum(int(d) ** 2 for d in row) for row in differences]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """The rows times the inverse of an upper triangular factor, by forward substitution."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def _products(read: Callable[[pa.RecordBatch], np.ndarray], size: int):
    """Per task the sum over its rows of the products of all entries, a row of the matrix at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((size, size))
        for batch in batches:
            rows = read(batch)
            gram += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(list(gram))], ["i", "line"])

    return run


def _gram(rows: DataFrame, read: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """The sum over all tasks; entries are added by Spark, the matrix comes to the driver."""
    lines = rows.mapInArrow(_products(read, size), "i int, line array<double>")
    entries = lines.select("i", F.posexplode("line").alias("j", "value")).groupBy("i", "j").agg(F.sum("value").alias("value"))
    gram = np.zeros((size, size))
    for i, j, value in entries.collect():
        gram[i, j] = value
    return (gram + gram.T) / 2


def next_factor(gram: np.ndarray, live: np.ndarray, weakest: np.ndarray) -> np.ndarray:
    """Upper triangular Cholesky factor of the live part, shifted if that is nearly singular.

    A dimension whose pivot is at most its ``weakest`` depends on those before it: its column is kept, its row is zero.
    """
    at = np.flatnonzero(live)
    scale = np.sqrt(np.diag(gram)[at])
    part = gram[np.ix_(at, at)] / np.outer(scale, scale)
    if np.linalg.eigvalsh(part)[0] < SINGULAR:
        part += ADDED * len(at) * np.eye(len(at))
    least = weakest[at] / scale
    upper = np.zeros_like(part)
    for j in range(len(at)):
        pivot = part[j, j] - upper[:j, j] @ upper[:j, j]
        if pivot > least[j] ** 2:
            upper[j, j] = np.sqrt(pivot)
            upper[j, j + 1 :] = (part[j, j + 1 :] - upper[:j, j] @ upper[:j, j + 1 :]) / upper[j, j]
    factor = np.zeros_like(gram)
    factor[np.ix_(at, at)] = upper * scale
    return factor


def components(gram_of: Callable[[list[np.ndarray]], np.ndarray], dimension: int, n: int) -> tuple[np.ndarray, ...]:
    """``(vectors by column, variances, total variance)``; ``gram_of`` gives the Gram matrix after solves with factors."""
    live, factors, composed = np.ones(dimension, bool), [], np.eye(dimension)
    noise = 16 * dimension * np.finfo(float).eps
    norms = total = None
    for _ in range(PASSES):
        gram = gram_of(factors)
        if norms is None:
            norms, total = np.sqrt(np.diag(gram)), float(np.trace(gram)) / n
        live &= np.diag(gram) > 0
        if not live.any():
            return np.empty((dimension, 0)), np.empty(0), 0.0
        factor = next_factor(gram, live, noise * norms / np.where(live, np.diag(composed), 1))
        composed = factor @ composed
        at = np.flatnonzero(live)
        if np.abs(gram[np.ix_(at, at)] - np.eye(len(at))).max() < ORTHONORMAL:
            break
        live &= np.diag(factor) > 0
        solving = np.eye(dimension)
        at = np.flatnonzero(live)
        solving[np.ix_(at, at)] = factor[np.ix_(at, at)]
        factors = [*factors, solving]
    else:
        raise RuntimeError(f"rows are not orthonormal after {PASSES} passes")
    _, singular, right = np.linalg.svd(composed)
    known = singular > noise * singular[0]
    return right[known].T, singular[known] ** 2 / n, total


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``; see the module's text.

    A row for each remaining vector and each of the first ``most`` components.
    """
    vector = F.col(vector_column).cast("array<double>")
    clean = vectors.select(F.col(id_column).alias("vec_id"), vector.alias("vector"))
    clean = clean.where(F.forall("vector", lambda c: c.isNotNull() & (F.abs(c) < LARGEST_ENTRY)) & (F.size("vector") > 0))
    lengths = clean.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length"))
    usual = lengths.first()
    dimension = usual["length"] if usual else 1
    clean = clean.where(F.size("vector") == dimension)

    total = F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total")
    sums = clean.mapInArrow(_sums(dimension), "i int, n long, total string").groupBy("i").agg(F.sum("n").alias("n"), total)
    sums = sorted((r["i"], r["n"], int(r["total"])) for r in sums.collect())
    n, totals = (sums[0][1], [s[2] for s in sums]) if sums else (0, [0] * dimension)

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        return _differences(_integers(batch.column("vector"), dimension), n, totals).astype(float) / n

    def gram_of(factors: list[np.ndarray]) -> np.ndarray:
        def read(batch: pa.RecordBatch) -> np.ndarray:
            rows = centred(batch)
            for factor in factors:
                rows = solved(rows, factor)
            return rows

        return _gram(clean, read, dimension)

    axes, variances, whole = components(gram_of, dimension, n) if n else (np.empty((dimension, 0)), np.empty(0), 0.0)
    axes, variances = axes[:, :most], variances[:most]
    projection = axes / np.sqrt(variances)

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                differences = _differences(_integers(batch.column("vector"), dimension), n, totals)
                values = (differences.astype(float) / n) @ projection
                arrays = [batch.column("vec_id"), _deviations(differences), pa.array(list(values), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "deviation", "whitened"])

    schema = f"vec_id {clean.schema['vec_id'].dataType.simpleString()}, deviation long, whitened array<double>"
    projected = written(clean.mapInArrow(project, schema), "whitened")
    error = _identity_error(projected, len(variances), n)
    shares = F.array(*[F.lit(float(v / whole)) for v in variances]).cast("array<double>")
    return projected.select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened")).select(
        "vec_id",
        (F.col("_at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("_at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def _identity_error(projected: DataFrame, size: int, n: int) -> float:
    """How far the covariance of the whitened rows, centred before multiplying, is from the identity at most."""
    if not size:
        return 0.0

    def values(batch: pa.RecordBatch) -> np.ndarray:
        return _matrix(batch.column("whitened"), size)

    spread = projected.select(F.posexplode("whitened").alias("j", "value")).groupBy("j").agg(F.avg("value").alias("mean"))
    means = np.array([m for _, m in sorted((r["j"], r["mean"]) for r in spread.collect())])
    covariance = _gram(projected, lambda batch: values(batch) - means, size) / n
    return float(np.abs(covariance - np.eye(size)).max())
