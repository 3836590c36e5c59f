"""Exact per-group quantiles and modes that stay bounded on hot groups.

Spark's ``percentile`` / ``median`` / ``mode`` aggregates keep every
distinct value of a group in one buffer.  When one group holds a third of
all rows of continuous values, that buffer is the group.  These versions
keep per-task memory bounded:

* mode: count per (group, value) first -- that shuffle is spread by value
  -- then a constant-size ``max_by`` (or max + min) per group;
* quantile q: a Greenwald-Khanna sketch (``percentile_approx``, rank error
  at most n/accuracy) gives values ``lo`` and ``hi`` whose ranks bracket the
  target rank q(n-1).  Rows below ``lo`` are only counted; the rows between
  ``lo`` and ``hi`` are counted per value (a shuffle spread by value, so a
  value that a third of all rows share is one row), and these distinct values
  (about 8n/accuracy at most) are ranked by running counts; groups under
  accuracy/2 rows are ranked whole.  Linear interpolation as in
  ``numpy.percentile``.

A call without keys is one global group (constant key, no cross join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from logweave.session import small_table

DEFAULT_ACCURACY = 100_000
MAX_BROADCAST_GROUPS = 100_000
_G = "_group"


def _keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    if keys:
        return df, list(keys)
    return df.withColumn(_G, F.lit(0)), [_G]


def _unkey(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df if keys else df.drop(_G)


def group_mode(df: DataFrame, keys: Sequence[str], x: str, out: str = "mode") -> DataFrame:
    """Most frequent non-NULL value per group; ties -> smallest value."""
    d, k = _keyed(df, keys)
    counts = d.where(F.col(x).isNotNull()).groupBy(*k, F.col(x).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    if isinstance(df.schema[x].dataType, NumericType):
        # highest count, then the smallest value (its negation is largest)
        res = counts.groupBy(*k).agg(F.max_by("_v", F.struct("_c", -F.col("_v").cast("double"))).alias(out))
    else:
        best = counts.groupBy(*k).agg(F.max("_c").alias("_m"))
        res = (
            counts.join(best, k)
            .where(F.col("_c") == F.col("_m"))
            .groupBy(*k)
            .agg(F.min("_v").alias(out))
        )
    return _unkey(res, keys)


def group_quantile(
    df: DataFrame,
    keys: Sequence[str],
    x: str,
    q: float,
    out: str = "quantile",
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """Exact q-quantile (linear interpolation) of the non-NULL ``x`` per group."""
    d, k = _keyed(df, keys)
    v = d.where(F.col(x).isNotNull()).select(*k, F.col(x).cast("double").alias("_x"))
    eps = 1.0 / accuracy
    # Sketch ranks are within eps*n of target and differ from the
    # interpolation rank q(n-1) by at most one row: +-4 eps brackets it for
    # n >= accuracy/3.  Smaller groups (bounded) are ranked whole.
    lo_p, hi_p = max(q - 4 * eps, 0.0), min(q + 4 * eps, 1.0)
    small = F.col("_n") < accuracy // 2
    sk = v.groupBy(*k).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_x", [lo_p, hi_p], accuracy).alias("_b"),
        F.min("_x").alias("_min"),
        F.max("_x").alias("_max"),
    )
    sk = sk.select(
        *k,
        F.when(small | F.lit(lo_p <= 0), F.col("_min")).otherwise(F.col("_b")[0]).alias("_lo"),
        F.when(small | F.lit(hi_p >= 1), F.col("_max")).otherwise(F.col("_b")[1]).alias("_hi"),
        (F.lit(q) * (F.col("_n") - 1)).alias("_r"),
    )
    # One row per group: fetched and broadcast when small (size checked), so
    # a hot group's rows are not gathered into one join task.
    sk, small = small_table(sk, MAX_BROADCAST_GROUPS)
    j = v.join(F.broadcast(sk) if small else sk, k)
    below = j.groupBy(*k).agg(F.sum((F.col("_x") < F.col("_lo")).cast("long")).alias("_below"))
    band = j.where((F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi")))
    values = band.groupBy(*k, "_x").agg(F.count(F.lit(1)).alias("_c"), F.first("_r").alias("_r"))
    upto = F.sum("_c").over(Window.partitionBy(*k).orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = values.withColumn("_end", upto).join(below, k)
    holds = lambda rank: (F.col("_end") - F.col("_c") <= rank) & (rank < F.col("_end"))
    fl = F.floor(F.col("_r")) - F.col("_below")
    ce = F.ceil(F.col("_r")) - F.col("_below")
    picked = ranked.groupBy(*k).agg(
        F.max(F.when(holds(fl), F.col("_x"))).alias("_a"),
        F.max(F.when(holds(ce), F.col("_x"))).alias("_c"),
        F.first("_r").alias("_r"),
    )
    frac = F.col("_r") - F.floor(F.col("_r"))
    res = picked.select(*k, (F.col("_a") + frac * (F.col("_c") - F.col("_a"))).alias(out))
    return _unkey(res, keys)
