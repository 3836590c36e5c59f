"""Named queries (Spark) and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
RAW: dict[str, QueryFn] = {}  # same queries without the comparison rounding (bench)
ORACLE: dict[str, str] = {}
DIGITS = 6


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` (and its oracle)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        RAW[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# Magnitude steps: below 1e5 keep DIGITS decimals, two fewer per two decades
# above (10-11 significant digits), so large sums do not hinge on the 16th digit.
MAG_STEPS = 7


def round_value(x):
    """Magnitude-aware rounding (same CASE ladder as ``sqlgen.rnd``)."""
    a = F.abs(x)
    expr = None
    for i in range(MAG_STEPS):
        cond = a < float(10 ** (5 + 2 * i))
        r = F.round(x, DIGITS - 2 * i)
        expr = F.when(cond, r) if expr is None else expr.when(cond, r)
    return expr.otherwise(x)


def round_doubles(df: DataFrame) -> DataFrame:
    """Round floating columns for engine-independent comparison."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(round_value(F.col(f"`{f.name}`").cast("double")).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)
