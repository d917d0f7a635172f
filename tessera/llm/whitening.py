"""Embedding whitening by Chebyshev-filtered subspace iteration."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import store

#: Fixed values of the contract: an entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Entries above this have no exact sums in longs.
LARGEST = float(1 << 40)
#: Rows multiplied at once within a task.
ROWS = 4096
#: Residuals, as a share of the largest eigenvalue: aimed at, and accepted when
#: rounding lets them fall no further.
GOAL, ENOUGH = 1e-13, 1e-11

OUT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double"


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """``(vec_id, dim, x)`` of every usable row; ``x`` holds longs."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    huge = F.raise_error(F.lit("embedding entry too large for exact sums")).cast("long")
    whole = F.transform("vector", lambda c: F.when(
        F.abs(c * SCALE) <= LARGEST, F.floor(c * SCALE) + SHIFT).otherwise(huge))
    return (rows.where(F.coalesce((F.size("vector") > 0) & ~bad, F.lit(False)))
            .select("vec_id", F.size("vector").alias("dim"), whole.alias("x")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def summed(data: DataFrame, dim: int, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """Sum of ``part`` (of ``shape``) over slices of the vectors: one pass.  A
    task sends one row per entry of its sum, Spark adds them up by entry, and
    the driver gets the sum alone."""
    def run(batches):
        total = np.zeros(shape)
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            for s in range(0, len(x), ROWS):
                total += part(x[s: s + ROWS])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["i", "v"])

    parts = data.select("x").mapInArrow(run, "i long, v double")
    out = np.zeros(shape[0] * shape[1])
    for i, v in parts.groupBy("i").sum("v").collect():
        out[i] = v
    return out.reshape(shape)


@dataclass
class Centre:
    """Size of a fit list, its sums by dimension, and its total variance."""
    n: int
    sums: np.ndarray
    trace: float = 0.0

    def of(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, from the exact n*x - S."""
        return (self.n * x - self.sums) / self.n


def fit_centre(data: DataFrame, dim: int) -> Centre:
    def run(batches):
        total, top, n = np.zeros(dim, dtype=object), 0, 0
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            for s in range(0, len(x), ROWS):  # too few at once to leave a long
                total += x[s: s + ROWS].sum(axis=0).astype(object)
            top, n = max(top, int(np.abs(x).max(initial=0))), n + len(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([str(t) for t in total]),
                                          pa.array([top] * dim), pa.array([n] * dim)], names=["i", "s", "top", "n"])

    rows = (data.select("x").mapInArrow(run, "i int, s string, top long, n long").groupBy("i")
            .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.max("top").alias("top"), F.sum("n").alias("n"))
            .orderBy("i").collect())
    n, top = rows[0].n, max(r.top for r in rows)
    if 2 * n * top >= 1 << 63:
        raise OverflowError(f"{n} vectors with entries up to {top} have no exact deviations in longs")
    centre = Centre(n, np.array([int(r.s) for r in rows], dtype=np.int64))
    centre.trace = float(summed(data, dim, lambda x: np.array([[(centre.of(x) ** 2).sum()]]), (1, 1))[0, 0]) / n
    return centre


def covariance_times(data: DataFrame, centre: Centre, q: np.ndarray) -> np.ndarray:
    """V Q, for the covariance V that no one forms: centred X'(X Q) / n, one pass."""
    def part(x):
        c = centre.of(x)
        return c.T @ (c @ q)
    return summed(data, len(q), part, q.shape) / centre.n


def lanczos(times: Callable, start: np.ndarray, steps: int) -> tuple[float, np.ndarray]:
    """A lower bound of the spectrum and, falling, lower bounds of the largest
    eigenvalues (they interlace), from a short fully orthogonalised run."""
    q, alpha, beta = [start / np.linalg.norm(start)], [], []
    for _ in range(steps):
        w = times(q[-1][:, None])[:, 0]
        alpha.append(float(q[-1] @ w))
        basis = np.array(q).T
        for _ in range(2):
            w = w - basis @ (basis.T @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * max(abs(a) for a in alpha) or len(q) == len(start):
            beta[-1] = 0.0
            break
        q.append(w / beta[-1])
    off = beta[:len(alpha) - 1]
    ritz = np.linalg.eigvalsh(np.diag(alpha) + np.diag(off, 1) + np.diag(off, -1))
    return max(0.0, float(ritz[0]) - beta[-1]), ritz[::-1]


def chebyshev(times: Callable, x: np.ndarray, low: float, cut: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of ``degree`` in V, times ``x``: small on the
    unwanted spectrum [low, cut], growing fast above it, and scaled at ``top``."""
    half, mid = max((cut - low) / 2, 1e-12 * top), (cut + low) / 2
    first = scale = half / (top - mid)
    y = (times(x) - mid * x) * (scale / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - scale)
        x, y = y, (times(y) - mid * y) * (2 * after / half) - scale * after * x
        scale = after
    return y


def leading_axes(times: Callable, dim: int, k: int, *, extra: int = 16, degree: int = 12, bound_steps: int = 10,
                 seed: int = 5, max_cycles: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` leading eigenvalues, falling, and unit eigenvectors of V, which
    is known by ``times`` only.  A block of ``k + extra`` vectors is filtered,
    made orthonormal (QR) and rotated to its Ritz vectors (Rayleigh-Ritz) until
    the residual of every wanted pair certifies it."""
    rng = np.random.default_rng(seed)
    block = min(dim, k + extra)
    low, known = lanczos(times, rng.standard_normal(dim), min(dim, bound_steps)) if block < dim else (0.0, np.zeros(0))
    q = np.linalg.qr(rng.standard_normal((dim, block)))[0]
    was = np.inf
    for _ in range(max_cycles):
        vq = times(q)
        h = q.T @ vq
        value, turn = np.linalg.eigh((h + h.T) / 2)
        value, turn = value[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = max(value[0], np.finfo(float).tiny)
        worst = float(np.linalg.norm(vq - q * value, axis=0)[:k].max()) / top
        if worst <= GOAL or worst <= ENOUGH and worst > was / 2:
            both = min(k, len(known))
            if (value[:both] < known[:both] - 1e-9 * top).any():
                raise RuntimeError("an eigenvalue was missed")
            return value[:k], q[:, :k]
        was = worst
        cut = max(float(value[-1]), 0.0)
        floor = min(low, cut)
        half = max((cut - floor) / 2, 1e-12 * top)
        reach = np.arccosh(max((top - (cut + floor) / 2) / half, 1 + 1e-9))
        # No further than the largest direction may drown the others.
        steps = int(np.clip(np.log(1e8) / reach, 2, degree))
        q = np.linalg.qr(chebyshev(times, q, floor, cut, top, steps))[0]
    raise RuntimeError(f"residual {worst:.1e} of the leading axes after {max_cycles} cycles")


def _applied(centre: Centre, axes: np.ndarray, dim: int, explained: list[float]):
    k = axes.shape[1]

    def run(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, ROWS):
                piece = batch.slice(s, ROWS)
                x = _matrix(piece.column(1), dim)
                gap = centre.n * x - centre.sums
                wide = gap.astype(object) if float(np.abs(gap).max()) ** 2 * dim >= 2.0 ** 62 else gap
                deviation = pa.array([int(v) for v in (wide * wide).sum(axis=1)], pa.decimal128(38, 0))
                each = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.RecordBatch.from_arrays([
                    piece.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(x) * k, centre.n)), deviation.take(each),
                    pa.array((centre.of(x) @ axes).ravel()), pa.array(np.tile(explained, len(x)))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained"])
    return run


def whiten(vectors: DataFrame, *, components: int = 8) -> DataFrame:
    """Coordinates of every vector on the leading unit-variance axes: ``vec_id,
    component, n, deviation, whitened, explained, identity_error``, one row for
    each vector and component.

    ``vectors`` has ``vec_id, embedding``.  Entries become whole numbers x, all
    vectors are the fit list, and their covariance is reached only by passes
    over the data (``covariance_times``), each of which sends the driver a
    matrix of dim x (components + 16).  ``leading_axes`` finds the axes to
    rounding; the entry of largest size is positive.  ``explained`` is the
    share of the total variance, ``identity_error`` the largest entry of the
    whitened vectors' covariance minus the identity, from two passes more.
    ``deviation`` is exact.

    Rows whose vector is null, empty or holds a null or non-finite entry are
    left out.  Repeated rows and rows without an id count and are returned as
    rows of their own.  Vectors of each length are whitened by themselves.  An
    axis without variance (below rounding of the largest) has no rows, so equal
    vectors, or one alone, give none.  An entry of 2^30 or more raises an error,
    as do so many large ones that n * x leaves a long.  An empty table gives an
    empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    data = store(integer_vectors(vectors), 5000)
    out = spark.createDataFrame([], OUT + ", identity_error double")
    for dim in sorted(r.dim for r in data.select("dim").distinct().collect()):
        own = data.where(F.col("dim") == dim)
        centre = fit_centre(own, dim)
        if not centre.trace:
            continue
        value, axes = leading_axes(lambda q: covariance_times(own, centre, q), dim, min(components, dim))
        real = value > 1e-12 * dim * value[0]
        value, axes = value[real], axes[:, real]
        axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(value))]) / np.sqrt(value)
        k = len(value)
        mean = summed(own, dim, lambda x: (centre.of(x) @ axes).sum(axis=0)[None, :], (1, k)) / centre.n

        def products(x):
            z = centre.of(x) @ axes - mean
            return z.T @ z

        error = float(np.abs(summed(own, dim, products, (k, k)) / centre.n - np.eye(k)).max())
        out = out.union(own.select("vec_id", "x").mapInArrow(
            _applied(centre, axes, dim, list(value / centre.trace)), OUT).withColumn("identity_error", F.lit(error)))
    return out
