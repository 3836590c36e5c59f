"""Inter-event intervals per file (and per file and id) and their statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.functions.stats import F12, describe_compressed

# Field name -> grouping columns beside FileID.  The pair is grouped on both
# columns; the reference's delimiter-free string concatenation is not used.
FIELD_KEYS = {
    "": [],
    "CustomerID": ["CustomerID"],
    "ProductID": ["ProductID"],
    "ProductCustomerID": ["ProductID", "CustomerID"],
}

DEFAULT_CHUNK_SECONDS = 3600


def open_intervals(
    log: DataFrame,
    field: str = "",
    chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
) -> DataFrame:
    """Seconds since the previous event of the same key; first event dropped.

    Output ``(FileID, <field keys>, QueryTs, QueryTsInterval<field>)``.  The
    multiset of intervals per key equals ``QueryTs - lag(QueryTs)`` over the
    whole key ordered by time, but the work is split into time chunks so a
    key holding a third of all rows is not sorted in one task:

    * inside each ``(key, chunk)``: ``lag`` over the chunk's rows;
    * across chunks: first time of a chunk minus last time of the previous
      non-empty chunk of the key, from a ``(key, chunk, min, max)`` summary
      whose size is bounded by the time span, not by rows.

    Equal timestamps give interval 0 in any order, so no tiebreak is needed.
    """
    keys = ["FileID"] + FIELD_KEYS[field]
    out = f"QueryTsInterval{field}"
    base = log.select(*keys, "QueryTs").dropna()
    base = base.withColumn("_chunk", F.floor(F.col("QueryTs") / chunk_seconds))

    # One shuffle on (key, chunk): lag inside the chunk and the chunk's last
    # time.  Rows without a lag are chunk heads and carry the chunk summary.
    part = Window.partitionBy(*keys, "_chunk")
    w = base.select(
        *keys,
        "_chunk",
        "QueryTs",
        F.lag("QueryTs").over(part.orderBy("QueryTs")).alias("_prev"),
        F.max("QueryTs").over(part).alias("_hi"),
    )
    inner = w.where(F.col("_prev").isNotNull()).select(
        *keys, "QueryTs", (F.col("QueryTs") - F.col("_prev")).alias(out)
    )
    heads = w.where(F.col("_prev").isNull())  # exactly one per chunk
    w_chunk = Window.partitionBy(*keys).orderBy("_chunk")
    edges = (
        heads.withColumn("_prev_hi", F.lag("_hi").over(w_chunk))
        .where(F.col("_prev_hi").isNotNull())
        .select(*keys, "QueryTs", (F.col("QueryTs") - F.col("_prev_hi")).alias(out))
    )
    return inner.unionByName(edges)


def step_intervals(counts: DataFrame, keys: Sequence[str], out: str, chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Distinct seconds of a key with their number of events ``n`` -> the same rows
    with the seconds since the key's previous one (NULL at the first).

    Split into time chunks like :func:`open_intervals`; as seconds are
    distinct, a chunk holds at most ``chunk_seconds`` rows whatever the skew.
    """
    part = Window.partitionBy(*keys, "_chunk")
    w = counts.withColumn("_chunk", F.floor(F.col("QueryTs") / chunk_seconds)).select(
        *keys,
        "_chunk",
        "QueryTs",
        "n",
        F.lag("QueryTs").over(part.orderBy("QueryTs")).alias("_prev"),
        F.max("QueryTs").over(part).alias("_hi"),
    )
    inner = w.where(F.col("_prev").isNotNull()).select(*keys, "QueryTs", "n", (F.col("QueryTs") - F.col("_prev")).alias(out))
    heads = w.where(F.col("_prev").isNull())  # exactly one per chunk
    before = F.lag("_hi").over(Window.partitionBy(*keys).orderBy("_chunk"))
    return inner.unionByName(heads.select(*keys, "QueryTs", "n", (F.col("QueryTs") - before).alias(out)))


def compressed_intervals(steps: DataFrame, value: str, key: str = "FileID") -> DataFrame:
    """``step_intervals`` rows -> ``(key, x, w, xi)`` for ``describe_compressed``: a
    second with n events has its step once and n - 1 intervals of 0."""
    both = F.explode(
        F.array(
            F.struct(F.col(value).cast("long").alias("xi"), F.lit(1).cast("long").alias("w")),
            F.struct(F.lit(0).cast("long").alias("xi"), (F.col("n") - 1).alias("w")),
        )
    )
    rows = steps.select(key, both.alias("_r")).select(key, "_r.xi", "_r.w").where("xi is not null and w > 0")
    comp = rows.groupBy(key, "xi").agg(F.sum("w").alias("w"))
    return comp.select(key, F.col("xi").cast("double").alias("x"), "w", "xi")


def interval_name(stat: str, field: str) -> str:
    """``QueryTsInterval`` + capitalised stat + field (reference naming)."""
    return f"QueryTsInterval{stat.capitalize()}{field}"


def interval_features(
    log: DataFrame,
    field: str = "",
    stats: Sequence[str] = F12,
    chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
) -> DataFrame:
    """Per-FileID statistics of the intervals (one row per file with >= 2 events).

    Events are first counted by key and second (map-side combine), so repeats
    of a hot second never leave their task."""
    keys = ["FileID"] + FIELD_KEYS[field]
    counts = log.select(*keys, "QueryTs").dropna().groupBy(*keys, "QueryTs").agg(F.count(F.lit(1)).alias("n"))
    out = f"QueryTsInterval{field}"
    comp = compressed_intervals(step_intervals(counts, keys, out, chunk_seconds), out)
    return describe_compressed(comp, ["FileID"], stats, name=lambda s: interval_name(s, field))


def last_seen(log: DataFrame, keys: Sequence[str] = ("FileID",)) -> DataFrame:
    """Latest timestamp per key (the carried state of the incremental form)."""
    return log.groupBy(*keys).agg(F.max("QueryTs").alias("max_timestamp"))
