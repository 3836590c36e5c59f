"""Feature selection: variance, correlation, standardisation.

Statistics are single passes with constant-size buffers; only the small per-column / per-pair result
reaches the driver, where the (sequential) keep/drop rules run.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from logweave.functions.encode import FEATURE_VARIANCE_THRESHOLD


def _q(c: str):
    return F.col(f"`{c}`")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def column_moments(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """One pass: (mean, population std) per column."""
    aggs = []
    for c in cols:
        aggs += [F.avg(_q(c)).alias(f"m|{c}"), F.stddev_pop(_q(c)).alias(f"s|{c}")]
    row = df.agg(*aggs).first().asDict()
    return {c: (row[f"m|{c}"], row[f"s|{c}"]) for c in cols}


def standardize(df: DataFrame, cols: Sequence[str] | None = None, key: str | None = None) -> DataFrame:
    """K8: (x - mean) / population std; zero std divides by 1."""
    cols = list(cols or numeric_columns(df, [key] if key else []))
    mom = column_moments(df, cols)
    exprs = {}
    for c in cols:
        m, s = mom[c]
        s = 1.0 if not s else s
        exprs[c] = (_q(c) - F.lit(m if m is not None else 0.0)) / F.lit(s)
    return df.withColumns(exprs)


def variances(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, variance)`` population variance per column, long."""
    wide = df.agg(*[F.var_pop(_q(c)).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column", "variance")


def variance_filter(
    df: DataFrame,
    threshold: float = FEATURE_VARIANCE_THRESHOLD,
    standardized: bool = True,
    key: str | None = "FileID",
) -> DataFrame:
    """K7: keep columns with population variance above ``threshold``.

    ``standardized=True`` measures variance on z-scored data (so only
    constant columns fall); ``False`` on raw values.
    """
    cols = numeric_columns(df, [key] if key else [])
    if standardized:
        mom = column_moments(df, cols)
        var = {c: (0.0 if not mom[c][1] else 1.0) for c in cols}
    else:
        row = df.agg(*[F.var_pop(_q(c)).alias(c) for c in cols]).first()
        var = {c: row[c] or 0.0 for c in cols}
    drop = [c for c in cols if not var[c] > threshold]
    return df.drop(*drop)


#: Columns of one block; a task holds four sums per pair of columns of a block pair.
BLOCK_COLUMNS = 128


def pair_sums(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """For all pairs (i, j) of columns, over the rows where both are known: n, the sum
    of i, of i * i and of i * j, as a (4, p, p) array.  One pass.

    Tasks multiply their batches as matrices, by pairs of column blocks; the sums
    of a block pair are added where they meet, as a stream.  Values are shifted by
    a value of their column, so large offsets don't cancel."""
    shift = df.agg(*[F.min(_q(c).cast("double")).alias(str(i)) for i, c in enumerate(cols)]).first()
    base = np.array([0.0 if v is None else v for v in shift])
    edges = [(a, min(a + BLOCK_COLUMNS, len(cols))) for a in range(0, len(cols), BLOCK_COLUMNS)]
    schema = "i int, j int, sums binary"

    def batch(found: dict) -> pa.RecordBatch:
        keys = list(found)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([found[k].tobytes() for k in keys], pa.binary())],
            ["i", "j", "sums"],
        )

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns]) - base
            known = ~np.isnan(x)
            x = np.where(known, x, 0.0)
            known = known.astype(float)
            for i, (a, z) in enumerate(edges):
                for j, (c, e) in enumerate(edges):
                    own, there = x[:, a:z], known[:, c:e]
                    sums = np.stack([known[:, a:z].T @ there, own.T @ there, np.square(own).T @ there, own.T @ x[:, c:e]])
                    found[i, j] = found[i, j] + sums if (i, j) in found else sums
        yield batch(found)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for b in batches:
            for i, j, data in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                sums = np.frombuffer(data)
                found[i, j] = found[i, j] + sums if (i, j) in found else sums
        yield batch(found)

    own = df.select(*[_q(c).cast("double").alias(f"_{i}") for i, c in enumerate(cols)])
    blocks = own.mapInArrow(multiply, schema).repartition(len(edges) ** 2, "i", "j").mapInArrow(add, schema)
    out = np.zeros((4, len(cols), len(cols)))
    for r in blocks.collect():  # p * p * 32 bytes
        (a, z), (c, e) = edges[r.i], edges[r.j]
        out[:, a:z, c:e] = np.frombuffer(r.sums).reshape(4, z - a, e - c)
    return out


#: Below this share of the mean square a variance is rounding: the column is constant.
ROUNDING = 1e-13


def correlation_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(col_i, col_j, corr)`` for i > j (pairwise-complete Pearson), all pairs from
    one pass; NULL if a side is constant.  NaN counts as missing."""
    n, x, xx, xy = pair_sums(df, cols) if len(cols) > 1 else np.zeros((4, len(cols), len(cols)))
    with np.errstate(all="ignore"):
        mean, square = x / n, xx / n
        var = square - mean**2
        var = np.where(var > ROUNDING * square, var, 0.0)
        corr = (xy / n - mean * mean.T) / np.sqrt(var * var.T)
    rows = [
        (cols[i], cols[j], float(corr[i, j]) if np.isfinite(corr[i, j]) else None) for i in range(len(cols)) for j in range(i)
    ]
    return df.sparkSession.createDataFrame(rows, "col_i string, col_j string, corr double")


def low_corr_drop(pairs: DataFrame, threshold: float) -> DataFrame:
    """K5: column i falls iff some earlier column j has corr(i, j) >= threshold."""
    return pairs.where(F.col("corr") >= threshold).select(F.col("col_i").alias("column")).distinct()


def low_corr(df: DataFrame, threshold: float = 0.95, key: str = "FileID") -> DataFrame:
    cols = numeric_columns(df, [key])
    drop = [r.column for r in low_corr_drop(correlation_pairs(df, cols), threshold).collect()]
    return df.drop(*drop)


def correlation_groups(pairs_rows: Sequence[tuple], cols: Sequence[str], threshold: float) -> list[str]:
    """K6: greedy groups over the lower triangle; returns columns to remove.

    For each column j in order: P = later columns with corr > threshold; if
    P is non-empty and j is not yet covered, cover P and remove
    (P + [j])[1:].  May contain duplicates, like the reference.
    """
    corr = {(a, b): v for a, b, v in pairs_rows}
    covered: set[str] = set()
    result: list[str] = []
    for jx, j in enumerate(cols):
        p = [i for i in cols[jx + 1 :] if (corr.get((i, j)) or float("-inf")) > threshold]
        if p and j not in covered:
            covered.update(p)
            result += (p + [j])[1:]
    return result
