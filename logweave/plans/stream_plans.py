"""Queries: streaming twins of the incremental paths (stream = batch).

Each query stages the events log as day files (derived from the test
table), runs the stream with ``availableNow`` over one day file per
trigger, and returns the sink table; the oracle is the batch SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from logweave.functions.stats import F12, describe_compressed
from logweave.operators.intervals import compressed_intervals, interval_name
from logweave.operators.metrics import AUC_BINS, auc_from_histogram
from logweave.plans import sqlgen as S
from logweave.plans.intervals_plans import _lag_sql
from logweave.plans.metrics_plans import _BINNED_SQL
from logweave.plans.registry import query
from logweave.plans.tfidf_plans import corpus_sql
from logweave.sources.fixtures import log_events, scored_events
from logweave.sources.log import LOG_DDL
from logweave.streaming import incremental as I
from logweave.streaming import stateful as ST


@query(
    "stream_daily_count",
    'SELECT CAST(floor("QueryTs" / 86400) AS BIGINT) AS day, "FileID", count(*) AS "FileIDCountDaily" '
    f"FROM {S.LOG_EVENTS} GROUP BY ALL",
)
def stream_daily_count(spark, d):
    """Per-day file counts appended per micro-batch (foreachBatch)."""
    out = I.stream_into(spark, "daily", log_events(spark, d), I.stream_daily_facts)
    return spark.read.parquet(out).select("day", "FileID", "FileIDCountDaily")


@query(
    "stream_interval_features",
    S.stats_sql(f"({_lag_sql('')})", ["FileID"], "QueryTsInterval", F12, name=lambda s: interval_name(s, "")),
)
def stream_interval_features(spark, d):
    """Intervals from streamed per-second counts, then F12 stats; equals the
    one-pass feat_interval."""
    out = I.stream_into(spark, "intervals", log_events(spark, d), I.stream_intervals)
    comp = compressed_intervals(I.read_intervals(spark, out), "QueryTsInterval")
    return describe_compressed(comp, ["FileID"], F12, name=lambda s: interval_name(s, ""))


@query("stream_distinct_pairs", f'SELECT DISTINCT "ProductID", "CustomerID" FROM {S.LOG_EVENTS}')
def stream_distinct_pairs(spark, d):
    """I4: growing distinct (product, customer) set via streaming dropDuplicates."""
    out = I.stream_into(
        spark, "pairs", log_events(spark, d),
        lambda s, o, c: I.stream_distinct(s, ["ProductID", "CustomerID"], o, c),
    )
    return spark.read.parquet(out)


@query("stream_corpus", corpus_sql('"ProductID"'))
def stream_corpus(spark, d):
    """Growing product corpus as additive tf facts; equals corpus_tf."""
    out = I.stream_into(spark, "corpus", log_events(spark, d), lambda s, o, c: I.stream_corpus(s, "ProductID", o, c))
    return I.read_corpus(spark, out)


@query(
    "tumbling_counts",
    'SELECT CAST(floor("QueryTs" / 604800) * 604800 AS BIGINT) AS window_start, "FileID", count(*) AS n '
    f"FROM {S.LOG_EVENTS} GROUP BY ALL",
)
def tumbling_counts(spark, d):
    """I1 batch: events per FileID in 7-day tumbling windows (epoch aligned)."""
    ts = F.timestamp_seconds(F.col("QueryTs"))
    return (
        log_events(spark, d)
        .groupBy(F.window(ts, "7 days"), "FileID")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.unix_timestamp(F.col("window.start")).alias("window_start"), "FileID", "n")
    )


@query(
    "stream_tumbling_counts",
    'SELECT CAST(floor("QueryTs" / 604800) * 604800 AS BIGINT) AS window_start, "FileID", count(*) AS n '
    f"FROM {S.LOG_EVENTS} GROUP BY ALL",
)
def stream_tumbling_counts(spark, d):
    """I1 streaming: the same windows from facts added per micro-batch."""
    out = I.stream_into(spark, "tumbling", log_events(spark, d), lambda s, o, c: I.stream_tumbling(s, 7, o, c))
    return I.read_tumbling(spark, out)


@query("stream_binned_auc", _BINNED_SQL)
def stream_binned_auc(spark, d):
    """Score histogram accumulated per micro-batch, then the binned AUC."""
    ev = spark.read.parquet(f"{d}/events.parquet").select("event_id", F.unix_timestamp("ts").alias("QueryTs"))
    rows = scored_events(spark, d).join(ev, "event_id")
    base = I.scratch(spark, "auc")
    src = I.stage_day_files(rows, base + "/in")
    stream = I.read_day_stream(spark, src, "event_id long, score double, label int, QueryTs long")
    I.stream_histogram(stream, base + "/out", base + "/ckpt", AUC_BINS)
    return auc_from_histogram(spark.read.parquet(base + "/out"))


@query(
    "stream_carried_intervals",
    S.stats_sql(f"({_lag_sql('')})", ["FileID"], "QueryTsInterval", F12, name=lambda s: interval_name(s, "")),
)
def stream_carried_intervals(spark, d):
    """I3 with carried state: a micro-batch reads its own rows only; F12 statistics of
    the interval counts equal the one-pass feat_interval."""
    out = I.stream_into(spark, "carried", log_events(spark, d), ST.carried_intervals)
    value = F.col("QueryTsInterval")
    comp = ST.read_carried(spark, out).select("FileID", value.cast("double").alias("x"), F.col("n").alias("w"), value.alias("xi"))
    return describe_compressed(comp, ["FileID"], F12, name=lambda s: interval_name(s, ""))


@query("stream_members", f'SELECT DISTINCT "ProductID", "CustomerID" FROM {S.LOG_EVENTS}')
def stream_members(spark, d):
    """I4 with bounded state: the member table after all day files."""
    base = I.scratch(spark, "members")
    src = I.stage_day_files(log_events(spark, d), f"{base}/in")
    stream = ST.with_arrival(I.read_day_stream(spark, src, LOG_DDL))
    ST.stream_members(stream, ["ProductID", "CustomerID"], f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out").select("ProductID", "CustomerID")


_HOP_SQL = f"""
SELECT CAST(pane - 86400 * k AS BIGINT) AS window_start, "FileID", count(*) AS n
FROM (SELECT "FileID", floor("QueryTs" / 86400) * 86400 AS pane FROM {S.LOG_EVENTS}), range(0, 2) t(k)
GROUP BY ALL
"""


@query("hopping_counts", _HOP_SQL)
def hopping_counts(spark, d):
    """I6 batch: events per FileID in 2-day windows every day."""
    ts = F.timestamp_seconds(F.col("QueryTs"))
    return (
        log_events(spark, d)
        .groupBy(F.window(ts, "2 days", "1 day"), "FileID")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.unix_timestamp(F.col("window.start")).alias("window_start"), "FileID", "n")
    )


@query("stream_hopping_counts", _HOP_SQL)
def stream_hopping_counts(spark, d):
    """I6 streaming: the same windows composed of daily facts added per micro-batch."""
    day = 86400
    out = I.stream_into(spark, "hopping", log_events(spark, d), lambda s, o, c: I.stream_hopping(s, 2 * day, day, o, c))
    return I.read_hopping(spark, out, 2 * day, day).select("window_start", "FileID", "n")
