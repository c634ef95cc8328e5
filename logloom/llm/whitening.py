"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

The vectors are scaled to integers and each distinct one is a row of the fit list, X once the mean is taken off.
The bidiagonalisation walks two orthonormal sequences: u_j = (X v_j - b_(j-1) u_(j-1)) / a_j in the space of rows
and v_(j+1) = (X' u_j - a_j v_j) / b_j in that of dimensions, each orthogonalised against all before it, twice.
The small bidiagonal matrix of the a and b then has the singular values of X, and its right singular vectors
combine the v into the components.

A u has an entry per row of the fit list and is never stored: u_j = X w_j for a vector w_j of as many entries as
there are dimensions, so one distributed pass over the rows, X' (X t), gives X t's lengths, its products with
all former u, and X' u_j. A pass sends a vector to the tasks and adds up one. Where a sequence ends early
(a or b vanish, as with repeated or zero variances), it goes on from a fresh direction, so no component is lost.
Vectors of up to `LEAST_STEPS` dimensions are walked in full, others until the wanted components' residuals are
negligible. A last pass over the rows applies X'X to the components once more, and a small rotation within their
span (Rayleigh and Ritz) removes what rounding has left.

Integers stay exact as long as they can: n x - S and the deviation are 64-bit, and one that does not fit raises
an error instead of wrapping. Rows whose vector is NULL, empty, or holds NULL, NaN or infinite entries, or entries
beyond 2^53 after scaling, take no part; neither do vectors of another length than the most frequent one (the
longest of those). Rows without an id and repeated rows are whitened like any other, and repeated vectors count
once in the fit. Components without variance (less than 1e-12 of all) cannot be whitened and are left out, so
a fit list of equal vectors, or an empty table, gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.tables import stored

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Steps that are always taken, up to the number of dimensions.
LEAST_STEPS = 128
#: Share of all variance below which a direction counts as constant.
NOTHING = 1e-12
#: Rows of the fit list in one packed block.
BLOCK_ROWS = 8192

WHITENED = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")


def scaled(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """(vec_id, x): the vectors that take part, as integers, stored."""
    entry = lambda c: F.floor(c * SCALE)
    fits = lambda c: F.coalesce(~F.isnan(c) & (F.abs(c * SCALE) < 2.0**53), F.lit(False))
    value = F.col("c")
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("c"))
    rows = rows.filter(value.isNotNull() & (F.size(value) > 0) & F.forall(value, fits))
    rows = stored(rows.select("vec_id", F.transform(value, lambda c: entry(c) + SHIFT).alias("x")), "scaled")
    length = F.size("x").alias("length")
    most = rows.groupBy(length).count().orderBy(F.desc("count"), F.desc("length")).first()
    return rows.filter(F.size("x") == (most["length"] if most else 0))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


@dataclass(frozen=True)
class Centre:
    """Number of rows, and what is left of the sums after `base` is taken off every row."""

    n: int
    base: np.ndarray
    rest: np.ndarray

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly."""
        y = x - self.base
        most = self.n * int(np.abs(y).max(initial=0)) + int(np.abs(self.rest).max(initial=0))
        if most >= 1 << 63:
            raise OverflowError("n x - S does not fit 64 bits")
        return self.n * y - self.rest

    def rows(self, x: np.ndarray) -> np.ndarray:
        """x - S / n."""
        return self.deviations(x) / self.n


def squares(deviations: np.ndarray) -> np.ndarray:
    """Sum of squares of every row, exactly."""
    bound = int(np.abs(deviations).max(initial=0)) ** 2 * deviations.shape[1]
    if bound < 1 << 63:
        return (deviations * deviations).sum(axis=1)
    sums = [sum(v * v for v in row) for row in deviations.tolist()]
    if max(sums, default=0) >= 1 << 63:
        raise OverflowError("a deviation does not fit 64 bits")
    return np.array(sums, dtype=np.int64)


class FitList:
    """The distinct vectors in packed blocks, and sums over them."""

    def __init__(self, rows: DataFrame):
        self.distinct = rows.select("x").distinct()

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first in range(0, batch.num_rows, BLOCK_ROWS):
                    x = batch.column("x").slice(first, BLOCK_ROWS)
                    flat = x.flatten().to_numpy(zero_copy_only=False)
                    yield pa.record_batch({"rows": pa.array([len(x)], pa.int64()), "block": pa.array([flat.tobytes()], pa.binary())})

        self.blocks = stored(self.distinct.mapInArrow(pack, "rows bigint, block binary"), "fit")
        self.n = int(self.blocks.agg(F.sum("rows")).first()[0] or 0)
        self.dimensions = int(self.blocks.agg(F.max(F.length("block") / F.col("rows") / 8)).first()[0] or 0)
        if self.n:
            self.centre = self._centre()

    def _centre(self) -> Centre:
        """From two exact sums: halves of the entries apart, so that neither can overflow."""
        dimensions = self.dimensions
        low = self.summed(lambda x: np.stack([(x & 0xFFFFFF).sum(axis=0), (x >> 24).sum(axis=0)]).ravel().astype(object))
        sums = [int(a) + (int(b) << 24) for a, b in zip(low[:dimensions], low[dimensions:], strict=True)]
        base = [s // self.n for s in sums]
        return Centre(self.n, np.array(base, np.int64), np.array([s - b * self.n for s, b in zip(sums, base, strict=True)], np.int64))

    def summed(self, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Sum over all blocks of a fixed number of values: integers exactly, floats in one order. A task adds up
        its own blocks; what moves is a row per task and value."""
        dimensions = self.dimensions

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for block in batch.column("block"):
                    found = of(np.frombuffer(block.as_buffer(), np.int64).reshape(-1, dimensions))
                    total = found if total is None else total + found
            if total is not None:
                exact = total.dtype == object
                yield pa.record_batch({
                    "place": pa.array(np.arange(len(total)), pa.int64()),
                    "whole": pa.array([int(v) for v in total] if exact else np.zeros(len(total), np.int64), pa.int64()),
                    "value": pa.array(np.zeros(len(total)) if exact else total, pa.float64()),
                })

        sums = self.blocks.mapInArrow(each, "place bigint, whole bigint, value double").groupBy("place").agg(
            F.sum(F.col("whole").cast("decimal(38,0)")).alias("whole"), F.sum("value").alias("value"), F.count(F.lit(1)).alias("n"))
        found = sorted(sums.collect(), key=lambda r: r["place"])
        return np.array([int(r["whole"]) if r["whole"] else r["value"] for r in found], dtype=object)

    def gram_times(self, t: np.ndarray) -> np.ndarray:
        """X' (X t) of a vector or matrix."""
        centre, wide = self.centre, t.reshape(len(t), -1)

        def product(x: np.ndarray) -> np.ndarray:
            rows = centre.rows(x)
            return (rows.T @ (rows @ wide)).ravel()

        return self.summed(product).astype(np.float64).reshape(t.shape)

    def trace(self) -> float:
        """Sum of all variances."""
        centre = self.centre
        return float(self.summed(lambda x: np.array([(centre.rows(x) ** 2).sum()]))[0]) / self.n


def _apart(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """What of a vector is orthogonal to a basis, of length one."""
    for _ in range(2):
        for b in basis:
            v = v - (b @ v) * b
    return v / np.linalg.norm(v)


def bidiagonalise(gram_times: Callable, dimensions: int, wanted: int, scale: float, least_steps: int = LEAST_STEPS,
                  seed: int = 11) -> tuple[np.ndarray, np.ndarray, int]:
    """Singular values of X and right singular vectors (columns), largest first, and the number of steps.
    `scale` is the Frobenius norm of X: what is below its rounding counts as zero."""
    rng = np.random.Generator(np.random.PCG64(seed))
    tiny = 1e-14 * scale
    vs, ws, images, alphas, betas = [], [], [], [], []
    v, beta = _apart(rng.normal(size=dimensions), []), 0.0
    while True:
        vs.append(v)
        t = v - (beta * ws[-1] if ws else 0.0)
        z = gram_times(t)  # X t is u_j before it is made orthogonal and brought to length one
        for _ in range(2):
            if ws:
                # <u_i, X t> = w_i . X'X t; taken off, so is its image.
                shares = np.stack(ws) @ z
                t = t - shares @ np.stack(ws)
                z = z - shares @ np.stack(images)
        alpha = float(np.sqrt(max(float(t @ z), 0.0)))
        if alpha <= tiny:
            alpha, w, image = 0.0, np.zeros(dimensions), np.zeros(dimensions)
        else:
            w, image = t / alpha, z / alpha  # u_j = X w, image = X' u_j
        ws.append(w)
        alphas.append(alpha)
        images.append(image)
        if len(vs) == dimensions:
            break
        rest = image - alpha * v
        for _ in range(2):
            for b in vs:
                rest = rest - (b @ rest) * b
        beta = float(np.linalg.norm(rest))
        if beta <= tiny:
            beta, v = 0.0, _apart(rng.normal(size=dimensions), vs)
        else:
            v = rest / beta
        betas.append(beta)
        if len(vs) >= max(least_steps, wanted + 2) and beta:
            left = np.linalg.svd(_upper(alphas, betas[:-1]))[0]
            if (np.abs(beta * left[-1, :wanted]) <= 1e-15 * scale).all():
                break
    _, values, right = np.linalg.svd(_upper(alphas, betas[: len(alphas) - 1]))
    return values, np.stack(vs, axis=1) @ right.T, len(vs)


def _upper(alphas: list[float], betas: list[float]) -> np.ndarray:
    return np.diag(alphas) + np.diag(betas, 1) if len(alphas) > 1 else np.diag(alphas)


@dataclass(frozen=True)
class Whitening:
    """A fitted map; `identity_error` tells how far it is from white on its own fit list."""

    centre: Centre
    directions: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float

    def of(self, x: np.ndarray) -> np.ndarray:
        return self.centre.rows(x) @ (self.directions / np.sqrt(self.variances))


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit to the distinct vectors of `rows` (x); None where nothing varies. What comes to the driver has the size
    of the components."""
    held = FitList(rows)
    if not held.n:
        return None
    trace = held.trace()
    if not trace > 0:
        return None
    wanted = min(components, held.dimensions)
    _, found, _ = bidiagonalise(held.gram_times, held.dimensions, wanted, float(np.sqrt(trace * held.n)))
    found = np.linalg.qr(found[:, :wanted])[0]
    image = held.gram_times(found)
    small = found.T @ image
    variances, turn = np.linalg.eigh((small + small.T) / 2 / held.n)
    directions, variances = (found @ turn)[:, ::-1], variances[::-1]
    varied = variances > NOTHING * trace
    directions, variances = np.ascontiguousarray(directions[:, varied]), variances[varied]
    model = Whitening(held.centre, directions, variances, variances / trace, 0.0)

    def moments(x: np.ndarray) -> np.ndarray:
        y = model.of(x)
        return np.concatenate([(y.T @ y).ravel(), y.sum(axis=0)])

    k = len(variances)
    sums = held.summed(moments).astype(np.float64) / held.n
    covariance = sums[: k * k].reshape(k, k) - np.outer(sums[k * k:], sums[k * k:])
    error = float(np.abs(covariance - np.eye(k)).max())
    return Whitening(held.centre, directions, variances, model.explained, error)


def whiten(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component. The fitted map, of fixed size, is sent to the tasks."""
    rows = scaled(vectors, vector, vec_id)
    model = fit(rows, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], WHITENED)
    dimensions, k = model.directions.shape

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(first, BLOCK_ROWS)
                x = _matrix(part.column("x"), dimensions)
                again = np.repeat(np.arange(part.num_rows), k)
                fixed = lambda v: np.full(len(again), v)
                yield pa.record_batch({
                    "vec_id": part.column("vec_id").take(pa.array(again)),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), part.num_rows)),
                    "n": pa.array(fixed(model.centre.n), pa.int64()),
                    "deviation": pa.array(squares(model.centre.deviations(x))[again]),
                    "whitened": pa.array(model.of(x).ravel()),
                    "explained": pa.array(np.tile(model.explained, part.num_rows)),
                    "identity_error": pa.array(fixed(model.identity_error)),
                })

    return rows.select("vec_id", "x").mapInArrow(each, WHITENED)
