"""Feature-table assembly, range features, label attachment."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.operators.prep import drop_constant


def assemble(tables: Sequence[DataFrame], key: str = "FileID") -> DataFrame:
    """Full outer join of feature tables on ``key`` in one shuffle.

    Every table is unioned (missing columns NULL) and collapsed with
    ``first(ignorenulls)`` per column: same result as the chain of full
    outer joins when column names are disjoint, one exchange instead of
    one per table.
    """
    seen: set[str] = set()
    for t in tables:
        dup = (set(t.columns) - {key}) & seen
        if dup:
            raise ValueError(f"duplicate feature columns: {sorted(dup)[:5]}")
        seen |= set(t.columns) - {key}
    u = tables[0]
    for t in tables[1:]:
        u = u.unionByName(t, allowMissingColumns=True)
    cols = [c for c in u.columns if c != key]
    return u.groupBy(key).agg(*[F.first(F.col(f"`{c}`"), ignorenulls=True).alias(c) for c in cols])


def assemble_bucketed(spark: SparkSession, spine: str, names: Sequence[str], key: str = "FileID") -> DataFrame:
    """C1 on catalog tables that ``write_co_bucketed`` wrote: left merge joins from the
    table of all keys, bucket by bucket, no exchange.  Same rows as ``assemble``."""
    out = spark.table(spine).select(key)
    for n in names:
        out = out.join(spark.table(n).hint("merge"), key, "left")
    return out


_MAX = re.compile(r"^(.*)(_max|Max)(.*)$")


def range_features(df: DataFrame) -> DataFrame:
    """D20 (inferred): for every ``<p>_max``/``<p>_min`` pair add ``<p>_range``,
    for ``<p>Max<s>``/``<p>Min<s>`` add ``<p>Range<s>``."""
    new = {}
    for c in df.columns:
        m = _MAX.match(c)
        if not m:
            continue
        pre, tag, post = m.groups()
        lo = f"{pre}{'_min' if tag == '_max' else 'Min'}{post}"
        if lo in df.columns:
            new[f"{pre}{'_range' if tag == '_max' else 'Range'}{post}"] = F.col(f"`{c}`") - F.col(f"`{lo}`")
    return df.withColumns(new)


def remove_percentage_cols(df: DataFrame) -> DataFrame:
    """Drop columns whose name contains ``percentage``."""
    return df.drop(*[c for c in df.columns if "percentage" in c])


def filter_data(
    df: DataFrame, vari: bool = False, cori: bool = False, vari_threshold=0.25, cori_threshold=0.999, keys: Sequence[str] = ("FileID",)
) -> DataFrame:
    """K9 filters: low-correlation, variance, constant columns, percentage columns.
    ``keys`` always stay."""
    from logweave.operators.select import low_corr, variance_filter

    if cori:
        df = low_corr(df, cori_threshold)
    if vari:
        df = variance_filter(df, vari_threshold)
    df = drop_constant(df, keys)
    return remove_percentage_cols(df)


def attach_labels(features: DataFrame, ids: DataFrame, split: str) -> DataFrame:
    """Listed ids of ``split`` left-joined to the features (train keeps y)."""
    lab = ids.where(F.col("split") == split).select("FileID", "y")
    out = lab.join(features, "FileID", "left")
    return out if split == "train" else out.drop("y")
