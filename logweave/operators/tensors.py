"""Per-second facts, zero-filled series, fixed-shape tensors and sliding windows.

Series are long ``(FileID, bucket, n, <channels>)`` tables; zero filling
happens at bucket level on a per-file spine of exactly ``n`` buckets, so a
file's series (and tensor) is bounded by its fixed shape, never by rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tensor channels in the reference's (alphabetical) order and
# the 6-day series length in seconds.
CHANNELS = ("CustomerIDCount", "CustomerIDUniqCount", "ProductIDUniqCount")
SIX_DAYS = 86400 * 6
PER_SECOND = ("CustomerIDCount", "ProductIDCount", "CustomerIDUniqCount", "ProductIDUniqCount")


def per_second_counts(log: DataFrame, by_batch: bool = False) -> DataFrame:
    """Rows and distinct ids per (FileID, second) [per batch]."""
    keys = (["batch_id"] if by_batch else []) + ["FileID", "QueryTs"]
    return log.groupBy(*keys).agg(
        F.count("CustomerID").alias("CustomerIDCount"),
        F.count("ProductID").alias("ProductIDCount"),
        F.count_distinct("CustomerID").alias("CustomerIDUniqCount"),
        F.count_distinct("ProductID").alias("ProductIDUniqCount"),
    )


def merge_per_second(facts: DataFrame) -> DataFrame:
    """Sum per-batch per-second facts (distinct counts become upper bounds)."""
    return facts.groupBy("FileID", "QueryTs").agg(*[F.sum(c).alias(c) for c in PER_SECOND])


def series(
    sec: DataFrame,
    group_n: int = 1,
    interval: int | None = SIX_DAYS,
    channels: Sequence[str] = CHANNELS,
) -> DataFrame:
    """J1 (``interval`` given) / J2 (``interval=None``): zero-filled bucket series.

    start = first second of the file; bucket = floor((ts - start) / group_n).
    J1 keeps ``ts < start + interval`` and has ``interval / group_n``
    buckets; J2 runs to the file's own last second.
    """
    bounds = sec.groupBy("FileID").agg(F.min("QueryTs").alias("_start"), F.max("QueryTs").alias("_end"))
    if interval is not None:
        n = F.lit(-(-interval // group_n)).cast("long")
    else:
        n = (F.floor((F.col("_end") - F.col("_start")) / group_n) + 1).cast("long")
    bounds = bounds.withColumn("n", n)
    rows = sec.join(bounds, "FileID")
    if interval is not None:
        rows = rows.where(F.col("QueryTs") < F.col("_start") + interval)
    sparse = rows.groupBy(
        "FileID", F.floor((F.col("QueryTs") - F.col("_start")) / group_n).cast("long").alias("bucket")
    ).agg(*[F.sum(c).alias(c) for c in channels])
    spine = bounds.select("FileID", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("bucket"))
    dense = spine.join(sparse, ["FileID", "bucket"], "left")
    return dense.select(
        "FileID", "bucket", "n", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in channels]
    )


def zscore(ser: DataFrame, channels: Sequence[str] = CHANNELS) -> DataFrame:
    """Per file and channel (v - mean) / population std; zero std -> / 1."""
    aggs = []
    for c in channels:
        aggs += [F.avg(c).alias(f"_mu_{c}"), F.stddev_pop(c).alias(f"_sd_{c}")]
    st = ser.groupBy("FileID").agg(*aggs)
    j = ser.join(st, "FileID")
    out = []
    for c in channels:
        sd = F.col(f"_sd_{c}")
        out.append(
            ((F.col(c) - F.col(f"_mu_{c}")) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)).alias(c)
        )
    return j.select("FileID", "bucket", "n", *out)


def tensor(
    ser: DataFrame, split_n: int, channels: Sequence[str] = CHANNELS
) -> DataFrame:
    """J1 reshape: ``(FileID, tensor)`` of shape (split_n, n / split_n, channels).

    Row-major: split = bucket // T, position = bucket % T.  The per-file
    collect is bounded by the fixed series length n, which ``split_n`` must
    divide: like any reshape, another length fails (ragged series have no
    tensor).
    """
    rows = ser.groupBy("FileID").agg(
        F.first("n").alias("n"),
        F.array_sort(F.collect_list(F.struct("bucket", F.array(*[F.col(c) for c in channels]).alias("v")))).alias(
            "_r"
        ),
    )
    vals = F.transform(F.col("_r"), lambda r: r["v"])
    uneven = F.raise_error(F.concat(F.lit(f"no reshape to {split_n} splits of a series of length "), F.col("n").cast("string")))
    t = F.when(F.col("n") % split_n == 0, F.col("n") / split_n).otherwise(uneven.cast("double")).cast("int")
    shaped = F.transform(
        F.sequence(F.lit(0), F.lit(split_n - 1)), lambda s: F.slice(vals, s * t + 1, t)
    )
    return rows.select("FileID", shaped.alias("tensor"))


def slide_windows(
    ser: DataFrame,
    step: int,
    width: int,
    mode: str = "lookback",
    threshold: float = 0.8,
    channels: Sequence[str] = CHANNELS,
) -> DataFrame:
    """Windows of ``width`` buckets every ``step`` over each file's series.

    Long output ``(FileID, window_no, pos, <channels>)``.  Windows
    ``[s, s + width)`` for s = 0, step, ... while s + width <= n; at the first
    short start the list ends: kept only if its length n - s reaches
    ``int(width * threshold)``, as the last ``width`` buckets (``lookback``,
    all n if n < width) or as the rest padded with zeros (``padd``).
    Each bucket is exploded into the windows that hold it (no join).
    """
    if mode not in ("lookback", "padd"):
        raise ValueError(mode)
    min_tail = int(width * threshold)
    b, n = F.col("bucket"), F.col("n")
    full = F.when(n >= width, F.floor((n - width) / step) + 1).otherwise(0).cast("long")
    tail_start = full * step
    tail_len = n - tail_start
    has_tail = (tail_start < n) & (tail_len >= min_tail)
    s = ser.withColumn("_F", full).withColumn("_ts", tail_start).withColumn("_tail", has_tail)

    lo = F.greatest(F.ceil((b - width + 1) / step), F.lit(0)).cast("long")
    hi = F.least(F.floor(b / step), F.col("_F") - 1).cast("long")
    wins = F.when(hi >= lo, F.sequence(lo, hi))
    full_rows = s.select("FileID", "bucket", *channels, F.explode(wins).alias("window_no")).select(
        "FileID", "window_no", (F.col("bucket") - F.col("window_no") * step).alias("pos"), *channels
    )

    tail_lo = F.greatest(n - width, F.lit(0)) if mode == "lookback" else F.col("_ts")
    tail_rows = s.where(F.col("_tail") & (b >= tail_lo)).select(
        "FileID", F.col("_F").alias("window_no"), (b - tail_lo).alias("pos"), *channels
    )
    out = full_rows.unionByName(tail_rows)
    if mode == "padd":
        files = s.where(F.col("_tail")).select("FileID", "_F", "n", "_ts").distinct()
        pad = files.select(
            "FileID",
            F.col("_F").alias("window_no"),
            F.explode(
                F.when(F.col("n") - F.col("_ts") < width, F.sequence(F.col("n") - F.col("_ts"), F.lit(width - 1).cast("long")))
            ).alias("pos"),
            *[F.lit(0).cast("long").alias(c) for c in channels],
        )
        out = out.unionByName(pad)
    return out


def split_series(sec: DataFrame, ids: DataFrame) -> DataFrame:
    """A10: per-second facts of listed files, tagged with their split
    (write with ``partitionBy('split')``, sorted by FileID within files)."""
    return sec.join(ids.select("FileID", "split"), "FileID")


def health_check(sec: DataFrame, cols: Sequence[str] = ("QueryTs",) + PER_SECOND, need: int = 5) -> DataFrame:
    """Files whose per-second table has fewer than ``need`` populated columns.

    Counts are never NULL, so a column is populated if it is above 0 in any
    second of the file (ids that are all NULL leave only zeros)."""
    present = sum(
        (F.when(F.max(F.col(c)) > 0, 1).otherwise(0) for c in cols), F.lit(0)
    )
    return sec.groupBy("FileID").agg(present.alias("n_columns")).where(F.col("n_columns") < need)


def tensor_dataset(tens: DataFrame, labels: DataFrame, val_pct: int = 10, seed: int = 0) -> DataFrame:
    """Tensors of training files with their label, split train / val by
    a deterministic hash of FileID (``val_pct`` percent to validation)."""
    from logweave.operators.metrics import hash_fraction

    lab = labels.where(F.col("split") == "train").select("FileID", "y")
    part = F.when(hash_fraction("FileID", seed) < val_pct, "val").otherwise("train")
    return tens.join(lab, "FileID").withColumn("subset", part)
