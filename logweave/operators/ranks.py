"""Exact ranks by a seeded hash inside strata, without a window over a stratum.

Rows are dealt to buckets by the first digits of an MD5 of ``seed:key``; bucket
counts are prefix-summed per stratum (one row per bucket) and rows are ranked
inside their bucket only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one window sorts, about.
ROWS_PER_BUCKET = 50_000


def seeded(key: str, seed: Column | int) -> Column:
    """MD5 (hex) of ``seed:key``, the same in every engine."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    return F.md5(F.concat(seed.cast("string"), F.lit(":"), F.col(key).cast("string")))


def fraction(digest: Column) -> Column:
    """The first 32 bits of a hex digest, as a double in [0, 1)."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(2**32)


def hash_ranks(df: DataFrame, key: str, strata: Sequence[str] = (), seed: Column | int = 0, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``df`` with ``_rank`` (from 0, by hash then key) and ``_size`` of its stratum.

    ``key`` should be unique in a stratum; equal keys are ranked next to each
    other in any order.  Null strata are a stratum; null keys come first.
    """
    hashed = df.withColumn("_hash", F.coalesce(seeded(key, seed), F.lit("")))
    digits = 1
    while 16**digits * rows_per_bucket < df.count() and digits < 7:
        digits += 1
    hashed = hashed.withColumn("_bucket", F.substring("_hash", 1, digits))
    strata = list(strata)
    ahead = Window.partitionBy(*strata).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = hashed.groupBy(*strata, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select(
        *[F.col(s).alias(f"_{i}_of") for i, s in enumerate(strata)],
        F.col("_bucket").alias("_bucket_of"),
        F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*strata)).alias("_size"),
    )
    own = Window.partitionBy(*strata, "_bucket").orderBy("_hash", key)
    ranked = hashed.withColumn("_rank", F.row_number().over(own) - 1)
    on = F.col("_bucket") == F.col("_bucket_of")
    for i, s in enumerate(strata):
        on &= F.col(s).eqNullSafe(F.col(f"_{i}_of"))
    out = ranked.join(offsets, on).withColumn("_rank", F.col("_before") + F.col("_rank"))
    return out.select(*df.columns, "_rank", "_size")


def stratified_split(df: DataFrame, key: str, label: str, test_pct: int = 33, seed: int = 42, n_splits: int = 1) -> DataFrame:
    """M5 with strata: ``n_splits`` repeated splits that keep the share of every
    class to one row (output gains ``split_no`` and ``subset``).

    The test set has ceil(n * test_pct / 100) rows.  A class gets the whole part
    of its share; the rows still missing go to the classes with the largest
    remainders (ties by label).  Inside a class the rows with the smallest hash
    of ``seed + split_no`` and key are taken, so a split is repeatable.
    """
    sizes = df.groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per class.
    every = Window.partitionBy()
    order = Window.orderBy(F.desc(F.col("_n") * test_pct % 100), F.asc_nulls_first("_class"))
    short = F.ceil(F.sum("_n").over(every) * test_pct / F.lit(100)) - F.sum(F.floor(F.col("_n") * test_pct / F.lit(100))).over(every)
    quota = sizes.select("_class", (F.floor(F.col("_n") * test_pct / F.lit(100)) + (F.row_number().over(order) <= short).cast("long")).alias("_quota"))
    drawn = df.withColumn("split_no", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    ranked = hash_ranks(drawn, key, ["split_no", label], F.lit(seed) + F.col("split_no"))
    out = ranked.join(quota, F.col(label).eqNullSafe(F.col("_class")))
    return out.select(*df.columns, "split_no", F.when(F.col("_rank") < F.col("_quota"), "test").otherwise("train").alias("subset"))
