"""Embedding whitening by polarisation: covariances from variances of dimensions and of sums of dimension pairs.

Entries become whole numbers x. Over the fit list (each distinct vector once, n of them with sums S) every task adds up
the exact squares of the centred values n*x - S for each dimension and of their sum for each pair of dimensions. As
var(a + b) = var(a) + var(b) + 2 cov(a, b), differences of these totals are all covariances, correctly rounded from whole
numbers; numpy's eigh takes their matrix, whose size is that of the vectors, not of the table.

Totals have no bound: a batch splits values in limbs whose products fit in 64 bits, a task keeps Python's whole numbers
and sends them in limbs, which Spark adds up by place. So results don't depend on how rows are dealt.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .storage import prepare, written

SCALE = 256
COMPONENTS = 4
ROWS, LIMB = 256, 27  # products of two limbs, summed over so many rows or less, fit in 63 bits
SENT_LIMB = 30
OUT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def square_sums(values: np.ndarray, axis: int) -> np.ndarray:
    """Exact sums of squares along an axis, as Python's whole numbers."""
    size = np.abs(values)
    bits = int(size.max(initial=0)).bit_length()
    parts = [(size >> s) & ((1 << LIMB) - 1) for s in range(0, bits, LIMB)]
    total = np.zeros(values.shape[1 - axis], dtype=object)
    for a, x in enumerate(parts):
        for b, y in enumerate(parts[a:], a):
            products = x * y
            cuts = [products[i : i + ROWS] if axis == 0 else products[:, i : i + ROWS] for i in range(0, values.shape[axis], ROWS)]
            for cut in cuts:
                total += cut.sum(axis=axis).astype(object) << (LIMB * (a + b) + (a != b))
    return total


def matrix(x: pa.Array, dimension: int) -> np.ndarray:
    return x.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n*x - S in 64 bits, as Python's whole numbers where these don't hold it."""
    most = n * max(int(x.max(initial=0)), -int(x.min(initial=0)))
    if most + max(map(abs, sums), default=0) >= 1 << 61:
        return x.astype(object) * n - np.array(sums, dtype=object)
    return x * n - np.array(sums, dtype=np.int64)


def plain_sums(x: np.ndarray) -> np.ndarray:
    low, high = x & ((1 << 32) - 1), x >> 32
    return np.array([len(x), *((high.sum(axis=0).astype(object) << 32) + low.sum(axis=0).astype(object))], dtype=object)


def pair_squares(y: np.ndarray) -> np.ndarray:
    """Sums of squares of each column, then of the sum of each two columns."""
    found = [square_sums(y, 0)]
    for i in range(y.shape[1] - 1):
        found.append(square_sums(y[:, i : i + 1] + y[:, i + 1 :], 0))
    return np.concatenate(found)


def exact_totals(fit: DataFrame, dimension: int, sums: Callable[[np.ndarray], np.ndarray]) -> list[int]:
    """Totals over all rows of what sums gives for some of them; each task sends one list, whatever its rows."""

    def limbs(totals: np.ndarray) -> Iterator[tuple[int, int, int]]:
        for place, value in enumerate(totals.tolist()):
            limb = 0
            while value not in (0, -1):
                yield place, limb, value & ((1 << SENT_LIMB) - 1)
                value >>= SENT_LIMB
                limb += 1
            yield place, limb, value

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = None
        for batch in batches:
            x = matrix(batch["x"], dimension)
            for at in range(0, len(x), ROWS):
                own = sums(x[at : at + ROWS])
                totals = own if totals is None else totals + own
        if totals is not None:
            places, limb, values = zip(*limbs(totals), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(limb, pa.int32()), pa.array(values, pa.int64())], names=["place", "limb", "value"])

    found = fit.mapInArrow(run, "place int, limb int, value long").groupBy("place", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    totals: dict[int, int] = {}
    for row in found.collect():  # as many rows as the vectors have pairs of dimensions
        totals[row.place] = totals.get(row.place, 0) + (int(row.value) << (SENT_LIMB * row.limb))
    return [totals[i] for i in range(len(totals))]


def covariance(squares: list[int], n: int, dimension: int) -> np.ndarray:
    """Of x, with divisor n, from the squares of n*x - S: differences of variances."""
    out = np.empty((dimension, dimension))
    pairs = iter(squares[dimension:])
    for i in range(dimension):
        out[i, i] = squares[i] / n**3
        for j in range(i + 1, dimension):
            out[i, j] = out[j, i] = (next(pairs) - squares[i] - squares[j]) / (2 * n**3)
    return out


def integer_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, x: floor(scale * entry) of the rows whose vector is not null or empty and holds no null or non-finite entry."""
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = embeddings.select("vec_id", "embedding").filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).filter(~bad)
    return usable.select("vec_id", F.transform("embedding", lambda c: F.floor(c.cast("double") * float(scale))).alias("x"))


def whiten(embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """For each usable row of embeddings(vec_id, embedding) and component: vec_id, component (from 1, by falling
    eigenvalue), n, deviation (sum of squares of n*x - S), whitened, explained (share of the variance), identity_error
    (how far the whitened covariance of the fit list is from the identity, the same in every row).

    Rows whose vector is null or empty or holds a null or non-finite entry are dropped, and so are rows of another length
    than most distinct vectors have (of the longer one, if two are as frequent). Rows that repeat a vector have results of
    their own; the fit counts the vector once. Products beyond 64 bits stop at their bounds. A component without variance
    (eigenvalue not above rounding) has no whitened value and no rows: a table of one distinct vector has no rows at all.
    A deviation of over 38 digits is null. A null vec_id stays.
    """
    spark = embeddings.sparkSession
    prepare(spark)
    vectors = integer_vectors(embeddings, scale)
    fit = written(vectors.select("x").distinct(), "vectors")
    common = fit.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return spark.createDataFrame([], OUT)
    dimension = common.d
    alike = F.size("x") == dimension
    fit, vectors = fit.filter(alike), vectors.filter(alike)
    n, *sums = exact_totals(fit, dimension, plain_sums)
    squares = exact_totals(fit, dimension, lambda x: pair_squares(centred(x, n, sums)))
    matrix_ = covariance(squares, n, dimension)
    values, axes = np.linalg.eigh(matrix_)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    known = values > max(values[0], 0.0) * dimension * np.finfo(float).eps
    values, axes = values[known], axes[:, known]
    if not len(values):
        return spark.createDataFrame([], OUT)
    trace, turn = float(np.trace(matrix_)), axes / np.sqrt(values)

    def projected(y: np.ndarray) -> np.ndarray:
        return (y / n).astype(np.float64) @ turn

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((len(values), len(values))), np.zeros(len(values))
        for batch in batches:
            z = projected(centred(matrix(batch["x"], dimension), n, sums))
            total, seen = total + z.T @ z, seen + z.sum(axis=0)
        flat = np.concatenate([seen, total.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["place", "value"])

    found = fit.mapInArrow(products, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").collect()
    flat = np.array([r.value for r in found]) / n
    # values are centred before they are multiplied; what rounding leaves of their mean is taken off
    mean, second = flat[: len(values)], flat[len(values) :].reshape(len(values), -1)
    error = float(np.abs(second - np.outer(mean, mean) - np.eye(len(values))).max())
    explained = values / trace

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        for batch in batches:
            y = centred(matrix(batch["x"], dimension), n, sums)
            z = projected(y)
            own = [Decimal(v) if v < 10**38 else None for v in square_sums(y, 1).tolist()]
            at = np.repeat(np.arange(len(y)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"].take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))), pa.array(np.full(len(at), n, dtype=np.int64)),
                    pa.array(own, pa.decimal128(38, 0)).take(pa.array(at)), pa.array(z.ravel()), pa.array(np.tile(explained, len(y))), pa.array(np.full(len(at), error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.mapInArrow(rows, OUT)
