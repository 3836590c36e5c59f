"""Day files and n-day batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.session import small_table

SECONDS_PER_DAY = 86400
# Day-rank tables up to this many rows (16 bytes each) are broadcast; larger
# ones use an ordinary join.
MAX_BROADCAST_DAYS = 100_000


def with_day(log: DataFrame, ts: str = "QueryTs", day: str = "day") -> DataFrame:
    """Attach the day of an event when the source did not (UTC day index)."""
    if day in log.columns:
        return log
    return log.withColumn(day, F.floor(F.col(ts) / SECONDS_PER_DAY).cast("long"))


def day_ranks(log: DataFrame, n: int, day: str = "day", days: list | None = None) -> DataFrame:
    """``(day, day_rank, batch_id)``: dense rank of the day in name/time order.

    Runs on the distinct days only (one row per day file), so the
    single-partition window and the broadcast below are bounded by the
    number of days, not by events.  ``days`` (e.g. from the file listing of
    a day-file source) avoids reading the log for them.
    """
    if days is not None:
        t = log.schema[day].dataType
        rows = [(str(d),) for d in sorted(set(days))]
        days_df = log.sparkSession.createDataFrame(rows, f"{day} string").select(F.col(day).cast(t).alias(day))
    else:
        days_df = log.select(day).where(F.col(day).isNotNull()).distinct()
    days = days_df
    r = F.dense_rank().over(Window.orderBy(day))
    return days.select(
        day,
        r.alias("day_rank"),
        F.floor((r - 1) / n).cast("int").alias("batch_id"),
    )


def assign_batches(
    log: DataFrame, n: int, day: str = "day", ts: str = "QueryTs", days: list | None = None
) -> DataFrame:
    """Batch of n consecutive day files: ``floor((dense_rank(day) - 1) / n)``.

    No row is lost: one without a day has no batch (NULL)."""
    log = with_day(log, ts, day)
    ranks = day_ranks(log, n, day, days).select(day, "batch_id")
    if days is not None:
        small = len(set(days)) <= MAX_BROADCAST_DAYS
    else:
        # One job: the rank table (one row per day) is fetched when it is
        # small, which both checks and fixes its size.
        ranks, small = small_table(ranks, MAX_BROADCAST_DAYS)
    return log.join(F.broadcast(ranks) if small else ranks, day, "left")


def first_batches(log: DataFrame, k: int) -> DataFrame:
    """Early stop after k batches (``breakout``): a filter, not a loop."""
    return log.where(F.col("batch_id") < k)
