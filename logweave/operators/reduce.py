"""Dimension reduction behind one interface: ``dim_reduc(df, reducer)``.

A reducer has ``fit(df, vec) -> Projection``.  Both here need one pass: every
task sums the products of its rows (a dimensions x dimensions matrix), the sums
are added by position, and the driver decomposes the one matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple, Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def by_row(column: pd.Series, rows) -> pd.Series:
    """What ``rows`` makes of the matrix of non-NULL vectors, row by row; NULL stays."""
    here = [i for i, x in enumerate(column) if x is not None]
    done: list = [None] * len(column)
    if here:
        for i, y in zip(here, rows(np.stack([column.iloc[i] for i in here]).astype(float)), strict=True):
            done[i] = y
    return pd.Series(done, dtype=object)


def products(df: DataFrame, vec: str, centre: np.ndarray | None = None) -> tuple[int, np.ndarray, np.ndarray]:
    """``(n, sums, X^T X)`` of the non-NULL vectors (less ``centre``) in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if len(b):
                x = rows_of(b.column(0)) - (0 if centre is None else centre)
                own = np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()])
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["pos", "value"])

    own = df.select(F.col(vec).cast("array<double>")).where(F.col(vec).isNotNull())
    rows = own.mapInArrow(run, "pos int, value double").groupBy("pos").agg(F.sum("value").alias("value")).collect()
    if not rows:
        raise ValueError("no vectors to fit")
    flat = np.zeros(len(rows))
    for r in rows:
        flat[r.pos] = r.value
    d = (-1 + round((4 * len(flat) - 3) ** 0.5)) // 2
    return int(flat[0]), flat[1 : d + 1], flat[d + 1 :].reshape(d, d)


class Projection(NamedTuple):
    """A fitted reducer: rows map to (x - mean) @ components."""

    mean: np.ndarray
    components: np.ndarray  # dimensions x k, orthonormal, largest entry of each positive
    variance: np.ndarray  # of each component: sample variance (PCA) or squared singular value (SVD)
    total: float  # of all dimensions

    def transform(self, df: DataFrame, vec: str = "features", out: str = "reduced") -> DataFrame:
        """Adds the projected rows as ``array<double>``; NULL stays NULL."""
        mean, components = self.mean, self.components

        @F.pandas_udf("array<double>")
        def project(column: pd.Series) -> pd.Series:
            return by_row(column, lambda x: (x - mean) @ components)

        return df.withColumn(out, project(F.col(vec).cast("array<double>")))


class Reducer(Protocol):
    def fit(self, df: DataFrame, vec: str = "features") -> Projection: ...


def leading(square: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    values, vectors = np.linalg.eigh(square)
    values, vectors = np.maximum(values[::-1][:k], 0), vectors[:, ::-1][:, :k]
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return values, vectors * np.where(sign == 0, 1, sign)


class PCA(NamedTuple):
    """L3: principal components of centred rows (two passes: means, then products)."""

    k: int

    def fit(self, df: DataFrame, vec: str = "features") -> Projection:
        n, sums, _ = products(df, vec)
        _, _, square = products(df, vec, sums / n)
        square = square / max(1, n - 1)
        values, vectors = leading(square, self.k)
        return Projection(sums / n, vectors, values, float(np.trace(square)))


class TruncatedSVD(NamedTuple):
    """L3: right singular vectors of rows as they are (no centring)."""

    k: int

    def fit(self, df: DataFrame, vec: str = "features") -> Projection:
        _, sums, square = products(df, vec)
        values, vectors = leading(square, self.k)
        return Projection(np.zeros(len(sums)), vectors, values, float(np.trace(square)))


def dim_reduc(df: DataFrame, reducer: Reducer, vec: str = "features", out: str = "reduced") -> DataFrame:
    """Any reducer: fitted on ``df`` and applied to it."""
    return reducer.fit(df, vec).transform(df, vec, out)
