"""Per-batch count facts and the feature tables built on them.

Facts stay long (``batch_id, FileID, <dim>, value``); wide ``{dim}_{stat}``
tables are pivoted last, over an explicit bounded value list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.functions.calendar import hour_of, weekday_of
from logweave.functions.stats import F5, F9, F11, describe, widen
from logweave.operators.batches import assign_batches
from logweave.session import cut_lineage

# Count fields and the id columns they group on beside FileID.
COUNT_FIELDS = {
    "countCustomer": ["CustomerID"],
    "countProduct": ["ProductID"],
    "countProductCustomer": ["ProductID", "CustomerID"],
}
UNIQ_FIELDS = {
    "uniqCustomer": ["CustomerID"],
    "uniqProduct": ["ProductID"],
    "uniqProductCustomer": ["ProductID", "CustomerID"],
}


def count_facts(blog: DataFrame, field: str, deep: bool = True) -> DataFrame:
    """D3: rows per (batch, FileID, ids) -- or per (batch, FileID) if not deep."""
    ids = COUNT_FIELDS[field] if deep else []
    return blog.groupBy("batch_id", "FileID", *ids).agg(F.count(F.lit(1)).alias(field))


def deep_counts(log: DataFrame, field: str) -> DataFrame:
    """Rows per (FileID, ids) over all batches: the sum of a fact's counts is one
    count, so neither batches nor a second shuffle are needed."""
    return log.groupBy("FileID", *COUNT_FIELDS[field]).agg(F.count(F.lit(1)).alias(field))


def uniq_facts(blog: DataFrame, field: str) -> DataFrame:
    """Distinct ids (or id pairs) per (batch, FileID)."""
    ids = UNIQ_FIELDS[field]
    return blog.groupBy("batch_id", "FileID").agg(F.count_distinct(*ids).alias(field))


#: log2 of the sketch's registers: relative standard error 1.04 / sqrt(2 ** 14) = 0.8 %.
SKETCH_BITS = 14


def sketch_facts(log: DataFrame, field: str, lg: int = SKETCH_BITS) -> DataFrame:
    """D4, mergeable: a distinct-count sketch of the ids per (day, FileID)."""
    ids = UNIQ_FIELDS[field]
    whole = F.when(sum((F.col(c).isNull().cast("int") for c in ids), F.lit(0)) == 0, F.xxhash64(*ids))
    return log.groupBy("day", "FileID").agg(F.hll_sketch_agg(whole, lg).alias("sketch"))


def uniq_from_sketches(facts: DataFrame, n: int, field: str) -> DataFrame:
    """Approximate ``uniq_facts`` of n-day batches from daily sketches: the log isn't
    read again for another batch length."""
    batched = assign_batches(facts, n)
    return batched.groupBy("batch_id", "FileID").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch", True)).alias(field))


def daily_count_facts(blog: DataFrame) -> DataFrame:
    """Rows per (batch, FileID)."""
    return blog.groupBy("batch_id", "FileID").agg(F.count(F.lit(1)).alias("FileIDCountDaily"))


def fact_features(
    facts: DataFrame,
    field: str,
    stats: Sequence[str] = F11,
    deep: bool = False,
) -> DataFrame:
    """Stats per FileID, columns ``{field}_{stat}``.

    ``deep`` first sums each (FileID, ids) fact across batches (D2).
    """
    if deep:
        ids = [c for c in facts.columns if c not in ("batch_id", "FileID", field)]
        facts = facts.groupBy("FileID", *ids).agg(F.sum(field).alias(field))
    return describe(facts, ["FileID"], field, stats, name=lambda s: f"{field}_{s}")


# ---------------------------------------------------------------- dense pivots


def dim_facts(blog: DataFrame, dim: str, dim_col) -> DataFrame:
    """Non-zero counts ``(batch_id, FileID, dim, cnt)``."""
    return (
        blog.select("batch_id", "FileID", dim_col.alias(dim))
        .groupBy("batch_id", "FileID", dim)
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def implicit_zeros(facts: DataFrame, dim: str) -> DataFrame:
    """``(FileID, dim, zeros)``: pivot cells that are 0 inside a batch.

    Inside a batch the reference pivots every file of the batch against
    every dim value seen in the batch and fills 0; across batches a value
    absent from the batch is NULL (skipped).  For a (file, value) pair with
    k non-zero cells the number of 0 cells is m - k, where m counts the
    batches holding both the file and the value: the common elements of the
    file's and the value's set of batches (as long as the calendar at most), so
    a pair is never fanned out to batches.
    """
    fb = facts.groupBy("FileID").agg(F.collect_set("batch_id").alias("_fb"))
    db = facts.groupBy(dim).agg(F.collect_set("batch_id").alias("_db"))
    pairs = facts.groupBy("FileID", dim).agg(F.count(F.lit(1)).alias("_k"))
    m = F.size(F.array_intersect("_fb", "_db"))
    return pairs.join(fb, "FileID").join(db, dim).select("FileID", dim, (m - F.col("_k")).alias("zeros"))


def dense_dim_stats(facts: DataFrame, dim: str, stats: Sequence[str], null_poison: bool = False) -> DataFrame:
    """Stats per (FileID, dim) over the batch-densified pivot, kept long."""
    zeros = implicit_zeros(facts, dim)
    return describe(facts, ["FileID", dim], "cnt", stats, zeros=zeros, null_poison=null_poison)


def dense_dim_table(facts: DataFrame, dim: str) -> DataFrame:
    """The densified pivot cells themselves, long: ``(batch_id, FileID, dim, Count)``.

    Files x values per batch by definition: use it for dimensions with a
    fixed small domain (hours, weekdays); features use
    :func:`dense_dim_stats`, which never materialises the zeros.
    """
    fb = facts.select("batch_id", "FileID").distinct()
    db = facts.select("batch_id", dim).distinct()
    cells = fb.join(db, "batch_id")
    return cells.join(facts, ["batch_id", "FileID", dim], "left").select(
        "batch_id", "FileID", dim, F.coalesce(F.col("cnt"), F.lit(0)).cast("long").alias("Count")
    )


def hour_facts(blog: DataFrame) -> DataFrame:
    """D9 facts: events per (batch, FileID, hour{h})."""
    return dim_facts(blog, "hour", F.concat(F.lit("hour"), hour_of("QueryTs").cast("string")))


def week_facts(blog: DataFrame) -> DataFrame:
    """D10 facts: events per (batch, FileID, week{w}), Monday = 0."""
    return dim_facts(blog, "week", F.concat(F.lit("week"), weekday_of("QueryTs").cast("string")))


def product_facts(blog: DataFrame) -> DataFrame:
    """D7 facts: events per (batch, FileID, ProductID)."""
    return dim_facts(blog, "ProductID", F.col("ProductID"))


def wide_dim_features(
    facts: DataFrame,
    dim: str,
    stats: Sequence[str],
    values: Sequence[str],
    null_poison: bool = False,
) -> DataFrame:
    """D9/D10/D11 wide: ``{value}_{stat}`` per FileID (0 where no fact) for a
    list of values, so that the columns do not depend on the data."""
    # The fact table (far smaller than the log) feeds the implicit zeros and
    # the stats: compute it once, reliably checkpointed.
    return widen(dense_dim_stats(cut_lineage(facts), dim, stats, null_poison), "FileID", dim, stats, values)


# The hours of a day and the days of a week (Monday = 0).
HOURS = tuple(f"hour{h}" for h in range(24))
WEEKDAYS = tuple(f"week{w}" for w in range(7))


def hour_features(blog: DataFrame) -> DataFrame:
    return wide_dim_features(hour_facts(blog), "hour", F9, HOURS)


def week_features(blog: DataFrame) -> DataFrame:
    return wide_dim_features(week_facts(blog), "week", F9, WEEKDAYS)


def product_daily_stats(blog: DataFrame) -> DataFrame:
    """D11 product detail, long: ``(FileID, ProductID, stats)``.  Any number of
    products; a catalogue is no list of columns."""
    return dense_dim_stats(cut_lineage(product_facts(blog)), "ProductID", F5)


def product_daily_features(blog: DataFrame, products: Sequence[str]) -> DataFrame:
    """D11 product detail, wide, for the products that the caller lists (one row
    per file of any product)."""
    return wide_dim_features(product_facts(blog), "ProductID", F5, products)


def product_share(blog: DataFrame, normalize: bool = True) -> DataFrame:
    """Per batch, count (or share of the file's row) per product; summed over batches.

    Long output ``(FileID, ProductID, count_percentage)``.  Merge-by-add of
    the reference = union + sum (0-filled).
    """
    f = product_facts(blog)
    if normalize:
        tot = f.groupBy("batch_id", "FileID").agg(F.sum("cnt").alias("_tot"))
        f = f.join(tot, ["batch_id", "FileID"]).withColumn("cnt", F.col("cnt") / F.col("_tot"))
    return f.groupBy("FileID", "ProductID").agg(F.sum(F.col("cnt").cast("double")).alias("count_percentage"))


def row_normalize(df: DataFrame, cols: Sequence[str], rename=None) -> DataFrame:
    """Each value over the row sum; zero row sum -> NULL.

    Replaces ``cols`` in place, or appends renamed twins when ``rename`` is
    given (a function old name -> new name).
    """
    total = sum((F.coalesce(F.col(f"`{c}`"), F.lit(0.0)) for c in cols), F.lit(0.0))
    new = {
        (rename(c) if rename else c): F.try_divide(F.col(f"`{c}`").cast("double"), total)
        for c in cols
    }
    return df.withColumns(new)


def norm_percentage(df: DataFrame) -> DataFrame:
    """Append row-normalised ``percentage`` twins of the ``sum`` columns
    (or, when there are none, of the ``mean`` columns)."""
    cols = [c for c in df.columns if "sum" in c]
    src = "sum"
    if not cols:
        cols = [c for c in df.columns if "mean" in c]
        src = "mean"
    return row_normalize(df, cols, rename=lambda c: c.replace(src, "percentage"))


def union_batches(parts: Sequence[DataFrame]) -> DataFrame:
    """Row union of per-batch frames, missing columns NULL."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def merge_add(parts: Sequence[DataFrame], keys: Sequence[str], value: str) -> DataFrame:
    """Align-and-add of partial tables: keys present on one side keep
    their value, keys on both add (union + sum)."""
    return union_batches(list(parts)).groupBy(*keys).agg(F.sum(value).alias(value))
