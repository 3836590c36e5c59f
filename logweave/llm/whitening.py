"""Whitening by the leading components, found by Chebyshev-filtered subspace iteration.

Vectors become whole numbers (floor of 256 times each entry); the fit list holds
each distinct one once.  The covariance V is never formed: all that is known of
it are passes over the fit list that return (X - mean)^T (X - mean) Q for a thin
Q, summed up in tasks.

1. A few Lanczos steps bound the spectrum.
2. A block of vectors, a dozen more than there are components, is filtered: a
   Chebyshev polynomial of V, by its three-term recurrence (one pass a degree),
   is at most 1 on the unwanted part of the spectrum and grows beyond it.
3. QR makes the block orthonormal; Rayleigh-Ritz takes the best vectors in it and
   moves the end of the unwanted part to its least Ritz value.
4. That repeats until the residuals |Vq - eq| of all components have come down to
   rounding and don't fall any more; they bound the distance to an eigenvalue.
   The fit fails if it can't be certified.

Scale: each pass reads the fit list (a table of its own, columns of numbers only)
and returns dimensions x block numbers, whatever the rows; the passes are some
dozens, as the gaps in the spectrum ask for.  The block (a few kilobytes) goes to
the tasks with their code.  Copies of a vector are merged before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import written

SCALE = 256
COMPONENTS = 4
#: Vectors of the block beside the components.
BESIDE = 12
DEGREE = 10
LANCZOS = 12
MOST_ROUNDS = 60
#: Residuals, relative to the largest eigenvalue, that certify a component.
CERTIFIED = 1e-11
LONG = 2**63


class Fit(NamedTuple):
    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit vectors as columns
    trace: float
    residual: float  # the largest, relative to the largest eigenvalue
    passes: int
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def whole(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and x (floor of 256 times each entry) of the rows whose vector is
    complete: not null, with as many entries as the longest, all of them finite."""
    own = rows.select(F.col("vec_id").cast("bigint"), F.col(vector).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    own = own.where(F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True)))
    size = own.agg(F.max(F.size("v"))).first()[0] or 0
    return own.where(F.size("v") == size).select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE)).alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of whole numbers; all lists have the same length."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def moments(fit: DataFrame) -> tuple[int, list[int]]:
    """The rows and the exact sums of all dimensions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] = []
        for b in batches:
            x = matrix(b.column(0)) if len(b) else np.zeros((0, 0), np.int64)
            if x.size:
                small = int(np.abs(x.astype(float)).max()) < LONG // 4 // len(x)
                own = [int(s) for s in (x if small else x.astype(object)).sum(0)]
                total = [s + t for s, t in zip(own, total or [0] * len(own), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(total)), pa.int32()), pa.array(map(Decimal, total), pa.decimal128(38, 0))], ["pos", "total"]
        )

    sums = fit.mapInArrow(run, "pos int, total decimal(38,0)").groupBy("pos").agg(F.sum("total").alias("total")).collect()
    return fit.count(), [int(r.total) for r in sorted(sums, key=lambda r: r.pos)]


class Covariance:
    """V as passes over the fit list."""

    def __init__(self, fit: DataFrame, n: int, mean: np.ndarray):
        self.fit, self.n, self.mean, self.passes = fit, n, mean, 0

    def summed(self, part, size: int) -> np.ndarray:
        """The sum over all rows of what ``part`` makes of a block of centred rows."""
        mean = self.mean

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for b in batches:
                if len(b):
                    total += part(matrix(b.column(0)) - mean).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total)], ["pos", "value"])

        self.passes += 1
        out = np.zeros(size)
        for r in self.fit.mapInArrow(run, "pos int, value double").groupBy("pos").agg(F.sum("value").alias("value")).collect():
            out[r.pos] = r.value
        return out

    def times(self, q: np.ndarray) -> np.ndarray:
        return self.summed(lambda x: x.T @ (x @ q), q.size).reshape(q.shape) / self.n

    def trace(self) -> float:
        return float(self.summed(lambda x: np.square(x).sum(), 1)[0]) / self.n


def spectrum(v: Covariance, d: int, rng: np.random.Generator, steps: int = LANCZOS) -> tuple[float, float]:
    """Bounds of the spectrum by Lanczos steps: Ritz values out to their residuals."""
    basis, alpha, beta = [], [], []
    q = rng.standard_normal(d)
    q /= np.linalg.norm(q)
    for _ in range(min(steps, d)):
        basis.append(q)
        w = v.times(q[:, None])[:, 0]
        alpha.append(float(q @ w))
        for _ in range(2):
            w = w - np.array(basis).T @ (np.array(basis) @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * max(alpha):
            break
        q = w / beta[-1]
    values, vectors = np.linalg.eigh(np.diag(alpha) + np.diag(beta[:-1], 1) + np.diag(beta[:-1], -1))
    out = beta[-1] * np.abs(vectors[-1])
    return max(0.0, float(values[0] - out[0])), float(values[-1] + out[-1])


def filtered(v: Covariance, q: np.ndarray, low: float, cut: float, high: float, degree: int = DEGREE) -> np.ndarray:
    """The Chebyshev polynomial for [low, cut] of V, times q, scaled at ``high``."""
    centre, half = (low + cut) / 2, (cut - low) / 2
    sigma = first = half / (high - centre)
    before, now = q, (v.times(q) - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (v.times(now) - centre * now) * (2 * after / half) - sigma * after * before
        sigma = after
    return now


def ritz(v: Covariance, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (falling), vectors and residuals of the space of ``q``."""
    q = np.linalg.qr(q)[0]
    image = v.times(q)
    small = q.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    q = q @ turn
    return values, q, np.linalg.norm(image @ turn - q * values, axis=0)


def fit(vectors: DataFrame, components: int = COMPONENTS, seed: int = 3) -> Fit | None:
    """The leading components of the distinct x of ``vectors`` (rows of ``whole``);
    None without rows.  Directions without variance are no components."""
    own = written(vectors.select("x").distinct(), "fit")
    n, sums = moments(own)
    d = len(sums)
    if not n or not d:
        return None
    v = Covariance(own, n, np.array([s / n for s in sums]))
    trace = v.trace()
    rng = np.random.default_rng([seed, d])
    k, size = min(components, d), min(d, components + BESIDE)
    if trace <= 0:
        return Fit(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0, 0.0, v.passes, 0.0)
    low, high = spectrum(v, d, rng)
    values, q, errors = ritz(v, rng.standard_normal((d, size)))
    worst = float(errors[:k].max()) / high
    for _ in range(MOST_ROUNDS):
        if size == d:
            break  # the block is the whole space
        cut = float(values[-1])
        if cut - low > 1e-9 * high:
            q = filtered(v, q, low, cut, max(high, float(values[0])))
        values, q, errors = ritz(v, q)
        before, worst = worst, float(errors[:k].max()) / float(values[0])
        if worst <= CERTIFIED and 2 * worst > before:
            break
    if worst > CERTIFIED:
        raise RuntimeError(f"components not certified: residual {worst}")
    k = int((values[:k] > 1e-12 * d * values[0]).sum())
    values, q = values[:k], q[:, :k]
    q = q * np.where(q[np.abs(q).argmax(0), np.arange(k)] < 0, -1.0, 1.0)
    scale = np.sqrt(values)

    def spread(x: np.ndarray) -> np.ndarray:
        w = (x @ q) / scale
        return np.concatenate([w.sum(0)[None], w.T @ w])

    both = v.summed(spread, (k + 1) * k).reshape(k + 1, k) / n
    error = float(np.abs(both[1:] - np.outer(both[0], both[0]) - np.eye(k)).max())
    return Fit(n, sums, values, q, trace, worst, v.passes, error)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """The exact sum over all dimensions of (n * x - sum) ** 2, of each row."""
    most = n * int(np.abs(x.astype(float)).max()) + max(map(abs, sums))
    if most * most * x.shape[1] < LONG // 2:
        return np.square(n * x - np.array(sums, np.int64)).sum(1).tolist()
    return [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x.tolist()]


WHITE = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def whiten(rows: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """One row of ``WHITE`` for each vector that is complete, and each component.

    Rows whose vector is null, holds null or non-finite entries or has fewer entries
    than the longest are dropped.  Null and repeated ids keep their rows; equal
    vectors count once for the fit.  Fewer components come out if fewer
    directions vary; none if all vectors are equal, nor from an empty table.  A
    deviation beyond 64 bits is null.  Other columns aren't read.
    """
    own = whole(rows, vector)
    found = fit(own, components)
    if found is None or not len(found.values):
        return rows.sparkSession.createDataFrame([], WHITE)
    n, sums, mean, q = found.n, found.sums, found.mean, found.vectors / np.sqrt(found.values)
    k, explained, error = len(found.values), (found.values / found.trace).tolist(), found.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            x = matrix(b.column(1))
            far = [s if s < LONG else None for s in deviations(x, n, sums)]
            white = (x - mean) @ q
            rows_of = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(rows_of)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(rows_of), n)), pa.array(far, pa.int64()).take(pa.array(rows_of)),
                    pa.array(white.ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(rows_of), error)),
                ],
                [f.split()[0] for f in WHITE.split(", ")],
            )

    return own.mapInArrow(run, WHITE)
