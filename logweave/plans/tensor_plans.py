"""Queries: per-second facts, zero-filled series, tensors, sliding windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from logweave.operators import tensors as T
from logweave.operators.batches import assign_batches
from logweave.plans import sqlgen as S
from logweave.plans.registry import query
from logweave.sources.fixtures import ids_events, log_events
from logweave.streaming.incremental import scratch

G = 3600  # bucket width used by the registered series queries (hourly)
SEC_COLS = '"CustomerIDCount", "ProductIDCount", "CustomerIDUniqCount", "ProductIDUniqCount"'
CH = ["CustomerIDCount", "CustomerIDUniqCount", "ProductIDUniqCount"]


def sec_sql(src=S.LOG_EVENTS, batch=False):
    k = "batch_id, " if batch else ""
    return (
        f'SELECT {k}"FileID", "QueryTs", count("CustomerID") AS "CustomerIDCount", '
        f'count("ProductID") AS "ProductIDCount", count(DISTINCT "CustomerID") AS "CustomerIDUniqCount", '
        f'count(DISTINCT "ProductID") AS "ProductIDUniqCount" FROM {src} GROUP BY ALL'
    )


def series_sql(g=G, interval=T.SIX_DAYS):
    n = f"{-(-interval // g)}" if interval else f'(en - st) // {g} + 1'
    clip = f'WHERE "QueryTs" < st + {interval}' if interval else ""
    sums = ", ".join(f'sum({S.q(c)}) AS {S.q(c)}' for c in CH)
    outs = ", ".join(f'CAST(coalesce(a.{S.q(c)}, 0) AS BIGINT) AS {S.q(c)}' for c in CH)
    return f"""
WITH sec AS ({sec_sql()}),
b AS (SELECT "FileID", min("QueryTs") AS st, max("QueryTs") AS en FROM sec GROUP BY ALL),
spine AS (SELECT "FileID", CAST({n} AS BIGINT) AS n, unnest(range(0, CAST({n} AS BIGINT))) AS bucket FROM b),
a AS (SELECT sec."FileID", ("QueryTs" - st) // {g} AS bucket, {sums}
      FROM sec JOIN b ON sec."FileID" = b."FileID" {clip} GROUP BY ALL)
SELECT spine."FileID", CAST(spine.bucket AS BIGINT) AS bucket, spine.n, {outs}
FROM spine LEFT JOIN a ON a."FileID" = spine."FileID" AND a.bucket = spine.bucket
"""


def _sec(spark, d):
    return T.per_second_counts(log_events(spark, d))


@query("per_second_counts", sec_sql())
def per_second_counts(spark, d):
    """Count and distinct ids per (FileID, second)."""
    return _sec(spark, d)


@query("per_second_counts_by_batch", sec_sql(S.batched(S.LOG_EVENTS, 7), batch=True))
def per_second_counts_by_batch(spark, d):
    """Per-second facts per 7-day batch."""
    return T.per_second_counts(assign_batches(log_events(spark, d), 7), by_batch=True)


@query(
    "merge_per_second",
    f'SELECT "FileID", "QueryTs", '
    + ", ".join(f"CAST(sum({S.q(c)}) AS BIGINT) AS {S.q(c)}" for c in T.PER_SECOND)
    + f" FROM ({sec_sql(S.batched(S.LOG_EVENTS, 7), batch=True)}) GROUP BY ALL",
)
def merge_per_second(spark, d):
    """Per-batch per-second facts summed across batches."""
    f = T.per_second_counts(assign_batches(log_events(spark, d), 7), by_batch=True)
    return T.merge_per_second(f).select(
        "FileID", "QueryTs", *[F.col(c).cast("long").alias(c) for c in T.PER_SECOND]
    )


@query("dense_series", series_sql())
def dense_series(spark, d):
    """J1 long form: 6-day series from the first event, hourly buckets, zero filled."""
    return T.series(_sec(spark, d), group_n=G)


@query("dense_series_ragged", series_sql(interval=None))
def dense_series_ragged(spark, d):
    """Series to the file's own last event, hourly buckets."""
    return T.series(_sec(spark, d), group_n=G, interval=None)


def _z_sql():
    base = series_sql()
    cols = ", ".join(
        f"{S.rnd(f'({S.q(c)} - avg({S.q(c)}) OVER w) / CASE WHEN stddev_pop({S.q(c)}) OVER w = 0 THEN 1 ELSE stddev_pop({S.q(c)}) OVER w END')} AS {S.q(c)}"
        for c in CH
    )
    return f'SELECT "FileID", bucket, n, {cols} FROM ({base}) WINDOW w AS (PARTITION BY "FileID")'


@query("series_zscore", _z_sql())
def series_zscore(spark, d):
    """Per-file, per-channel z-score of the 6-day series."""
    return T.zscore(T.series(_sec(spark, d), group_n=G))


def _tensor_sql():
    rows = ", ".join(f"s.{S.q(c)}" for c in CH)
    return (
        f"WITH s AS ({series_sql()}), v AS (SELECT \"FileID\", bucket // 24 AS sp, "
        f"list([{rows}] ORDER BY bucket) AS r FROM s GROUP BY ALL) "
        'SELECT "FileID", list(r ORDER BY sp) AS tensor FROM v GROUP BY "FileID"'
    )


@query("tensor", _tensor_sql())
def tensor(spark, d):
    """J1 reshape: (6, 24, 3) tensor per file from hourly 6-day series."""
    return T.tensor(T.series(_sec(spark, d), group_n=G), split_n=6)


def slide_sql(step, width, mode, threshold):
    mt = int(width * threshold)
    base = series_sql(interval=None)
    ch = ", ".join(S.q(c) for c in CH)
    sch = ", ".join(f"s.{S.q(c)}" for c in CH)
    zeros = ", ".join(f"CAST(0 AS BIGINT) AS {S.q(c)}" for c in CH)
    tail_lo = f"greatest(f.n - {width}, 0)" if mode == "lookback" else "f.tail_start"
    pad = ""
    if mode == "padd":
        pad = (
            f" UNION ALL SELECT f.\"FileID\", f.nf AS window_no, unnest(range(f.n - f.tail_start, {width})) AS pos, {zeros} "
            f"FROM f WHERE f.has_tail"
        )
    return f"""
WITH s AS ({base}),
f0 AS (SELECT DISTINCT "FileID", n, CASE WHEN n >= {width} THEN (n - {width}) // {step} + 1 ELSE 0 END AS nf FROM s),
f AS (SELECT *, nf * {step} AS tail_start, (nf * {step} < n AND n - nf * {step} >= {mt}) AS has_tail FROM f0),
wins AS (SELECT "FileID", unnest(range(0, nf)) AS w FROM f)
SELECT s."FileID", wins.w AS window_no, s.bucket - wins.w * {step} AS pos, {sch}
FROM s JOIN wins ON s."FileID" = wins."FileID" AND s.bucket >= wins.w * {step} AND s.bucket < wins.w * {step} + {width}
UNION ALL
SELECT s."FileID", f.nf AS window_no, s.bucket - {tail_lo} AS pos, {sch}
FROM s JOIN f ON s."FileID" = f."FileID" WHERE f.has_tail AND s.bucket >= {tail_lo}
{pad}
"""


for _mode in ("lookback", "padd"):

    def _mk(mode):
        @query(f"slide_windows_{mode}", slide_sql(100, 240, mode, 0.5))
        def _q(spark, d):
            """240-bucket windows every 100 buckets over the ragged hourly series."""
            ser = T.series(_sec(spark, d), group_n=G, interval=None)
            return T.slide_windows(ser, step=100, width=240, mode=mode, threshold=0.5)

    _mk(_mode)


IDS = S.IDS_EVENTS


@query(
    "split_series",
    f'SELECT s.*, i.split FROM ({sec_sql()}) s JOIN {IDS} i USING ("FileID")',
)
def split_series(spark, d):
    """A10: per-second facts of listed files tagged train / test."""
    return T.split_series(_sec(spark, d), ids_events(spark, d))


_PLANTED_SQL = (
    "(SELECT \"FileID\", CASE WHEN \"FileID\" NOT LIKE '%3' THEN \"CustomerID\" END AS \"CustomerID\", "
    f'"QueryTs", "ProductID" FROM {S.LOG_EVENTS})'
)


@query(
    "health_check",
    "SELECT \"FileID\", n_columns FROM (SELECT \"FileID\", "
    + " + ".join(f"CASE WHEN max({S.q(c)}) > 0 THEN 1 ELSE 0 END" for c in ("QueryTs",) + T.PER_SECOND)
    + f" AS n_columns FROM ({sec_sql(_PLANTED_SQL)}) GROUP BY ALL) WHERE n_columns < 5",
)
def health_check(spark, d):
    """Files whose per-second table, as written and read back, has fewer
    than 5 populated columns; the customers of files ending in 3 are lost."""
    log = log_events(spark, d)
    bad = log.withColumn("CustomerID", F.when(~F.col("FileID").endswith("3"), F.col("CustomerID")))
    path = scratch(spark, "health")
    T.per_second_counts(bad).write.parquet(path)
    return T.health_check(spark.read.parquet(path))


@query(
    "tensor_dataset",
    f"SELECT t.\"FileID\", t.tensor, i.y, CASE WHEN "
    f"(CAST(('0x' || substr(md5('0:' || t.\"FileID\"), 1, 8)) AS BIGINT) % 100) < 10 THEN 'val' ELSE 'train' END AS subset "
    f"FROM ({_tensor_sql()}) t JOIN {S.IDS_EVENTS} i USING (\"FileID\") WHERE i.split = 'train'",
)
def tensor_dataset(spark, d):
    """Labelled tensors of training files with a 90/10 hash split."""
    tens = T.tensor(T.series(_sec(spark, d), group_n=G), split_n=6)
    return T.tensor_dataset(tens, ids_events(spark, d))
