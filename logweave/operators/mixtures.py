"""L1: Gaussian mixtures with full, tied, diagonal or spherical covariances.

Expectation-maximisation as one pass per round: tasks sum responsibilities,
weighted rows and weighted products of their rows; the sums are added by
position, and the parameters (components x dimensions^2 at most) live on the
driver.  The log-likelihood comes with the same pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.operators.reduce import by_row, rows_of
from logweave.session import cut_lineage

# The kinds of the reference's search and its smallest variance.
KINDS = ("spherical", "tied", "diag", "full")
FLOOR = 1e-6


class Mixture(NamedTuple):
    kind: str
    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray  # components x dimensions x dimensions, whatever the kind
    likelihoods: tuple[float, ...]  # log-likelihood before each round, then of the result
    n: int

    @property
    def parameters(self) -> int:
        k, d = self.means.shape
        spread = {"full": k * d * (d + 1) // 2, "tied": d * (d + 1) // 2, "diag": k * d, "spherical": k}[self.kind]
        return k * d + spread + k - 1

    @property
    def aic(self) -> float:
        return 2 * self.parameters - 2 * self.likelihoods[-1]


def log_densities(x: np.ndarray, weights: np.ndarray, means: np.ndarray, covariances: np.ndarray) -> np.ndarray:
    """log(weight * density) of every row under every component."""
    out = np.empty((len(x), len(weights)))
    for j, (w, m, c) in enumerate(zip(weights, means, covariances, strict=True)):
        low = np.linalg.cholesky(c)
        z = np.linalg.solve(low, (x - m).T)
        out[:, j] = np.log(max(w, 1e-300)) - 0.5 * (np.square(z).sum(0) + x.shape[1] * np.log(2 * np.pi)) - np.log(np.diag(low)).sum()
    return out


def responsibilities(logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = logs.max(1, keepdims=True)
    likely = np.exp(logs - top)
    return likely / likely.sum(1, keepdims=True), top[:, 0] + np.log(likely.sum(1))


def shaped(kind: str, square: np.ndarray, mass: np.ndarray, means: np.ndarray) -> np.ndarray:
    """Covariances of a kind from weighted products of rows."""
    k, d = means.shape
    full = square / mass[:, None, None] - means[:, :, None] * means[:, None, :]
    if kind == "tied":
        full = np.repeat(((full * mass[:, None, None]).sum(0) / mass.sum())[None], k, 0)
    elif kind != "full":
        spread = np.stack([np.diag(c) for c in full])
        if kind == "spherical":
            spread = np.repeat(spread.mean(1)[:, None], d, 1)
        full = np.stack([np.diag(s) for s in spread])
    return full + FLOOR * np.eye(d)


def fit_mixture(df: DataFrame, k: int, kind: str = "full", features: str = "features", seed: int = 42, max_iter: int = 100, tol: float = 1e-3) -> Mixture:
    """EM from k-means centres until the mean log-likelihood gains less than ``tol``.
    NULL vectors are left out."""
    if kind not in KINDS:
        raise ValueError(kind)
    rows = df.select(F.col(features).cast("array<double>").alias("x")).where(F.col("x").isNotNull())
    if k == 1:
        means = np.zeros((1, len(rows.first().x)))  # any centre: all rows are its own
    else:
        first = KMeans(k=k, seed=seed, featuresCol="v", maxIter=20).fit(rows.select(array_to_vector("x").alias("v")))
        means = np.stack(first.clusterCenters())
    k, d = means.shape
    size = k * (1 + d + d * d) + 2

    def sums(weigh) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for b in batches:
                if len(b):
                    x = rows_of(b.column(0))
                    r, logs = weigh(x)
                    square = np.stack([(x * r[:, [j]]).T @ x for j in range(k)])
                    total += np.concatenate([r.sum(0), (r.T @ x).ravel(), square.ravel(), [logs.sum(), len(x)]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["pos", "value"])

        out = np.zeros(size)
        for r in rows.mapInArrow(run, "pos int, value double").groupBy("pos").agg(F.sum("value").alias("value")).collect():
            out[r.pos] = r.value
        return out

    def nearest(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = np.square(x[:, None, :] - means).sum(2).argmin(1)
        return np.eye(k)[own], np.zeros(len(x))

    def maximised(found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mass = np.maximum(found[:k], 1e-10)
        centres = found[k : k + k * d].reshape(k, d) / mass[:, None]
        return mass / mass.sum(), centres, shaped(kind, found[k + k * d : -2].reshape(k, d, d), mass, centres)

    found = sums(nearest)
    n, likelihoods = int(found[-1]), []
    model = maximised(found)
    for _ in range(max_iter + 1):
        found = sums(lambda x, model=model: responsibilities(log_densities(x, *model)))
        likelihoods.append(float(found[-2]))
        if len(likelihoods) > max_iter or (len(likelihoods) > 1 and likelihoods[-1] - likelihoods[-2] < tol * n):
            break
        model = maximised(found)
    return Mixture(kind, *model, tuple(likelihoods), n)


def assign(df: DataFrame, model: Mixture, features: str = "features") -> DataFrame:
    """L2: adds ``prediction`` and ``probability`` (one entry per component)."""
    weights, means, covariances = model.weights, model.means, model.covariances

    @F.pandas_udf("array<double>")
    def probability(column: pd.Series) -> pd.Series:
        return by_row(column, lambda x: responsibilities(log_densities(x, weights, means, covariances))[0])

    out = df.withColumn("probability", probability(F.col(features).cast("array<double>")))
    return out.withColumn("prediction", F.array_position("probability", F.array_max("probability")).cast("int") - 1)


def select_mixture(df: DataFrame, ks: Sequence[int], kinds: Sequence[str] = KINDS, features: str = "features", seed: int = 42, **fit) -> tuple[DataFrame, Mixture]:
    """All sizes and kinds; ``(k, kind, log_likelihood, aic)`` rows and the model of
    least AIC."""
    rows = cut_lineage(df.select(features))
    models = [fit_mixture(rows, k, kind, features, seed, **fit) for k in ks for kind in kinds]
    table = df.sparkSession.createDataFrame(
        [(len(m.weights), m.kind, m.likelihoods[-1], float(m.aic)) for m in models], "k int, kind string, log_likelihood double, aic double"
    )
    return table, min(models, key=lambda m: m.aic)
