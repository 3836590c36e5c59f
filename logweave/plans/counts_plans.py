"""Queries: count facts, distinct counts, calendar histograms, product pivots."""

from __future__ import annotations

from pyspark.sql import functions as F

from logweave.functions.calendar import hour_of, weekday_of
from logweave.functions.stats import F5, F9, F11
from logweave.operators import counts as C
from logweave.operators.batches import assign_batches
from logweave.plans import sqlgen as S
from logweave.plans.registry import query
from logweave.sources.fixtures import log_events


def blog(spark, d, n):
    return assign_batches(log_events(spark, d), n)


def B(n):
    return S.batched(S.LOG_EVENTS, n)


def _ids(field):
    return ", ".join(S.q(c) for c in C.COUNT_FIELDS.get(field, C.UNIQ_FIELDS.get(field, [])))


def count_sql(field, n=1, deep=True):
    ids = _ids(field) if deep else ""
    sel = f'batch_id, "FileID"{", " + ids if ids else ""}'
    return f"SELECT {sel}, count(*) AS {S.q(field)} FROM {B(n)} GROUP BY ALL"


def uniq_sql(field, n=1):
    ids = _ids(field)
    return (
        f'SELECT batch_id, "FileID", count(*) AS {S.q(field)} FROM '
        f'(SELECT DISTINCT batch_id, "FileID", {ids} FROM {B(n)}) GROUP BY ALL'
    )


def feat_sql(facts_sql, field, stats=F11, deep=False):
    src = f"({facts_sql})"
    if deep:
        ids = _ids(field)
        src = f'(SELECT "FileID", {ids}, sum({S.q(field)}) AS {S.q(field)} FROM {src} GROUP BY ALL)'
    return S.stats_sql(src, ["FileID"], field, stats, name=lambda s: f"{field}_{s}")


# ------------------------------------------------------------------ D3 / D4 / D5
_COUNT_Q = {"countCustomer": "count_customer", "countProduct": "count_product", "countProductCustomer": "count_prod_cus"}
_UNIQ_Q = {"uniqCustomer": "nuniq_customer", "uniqProduct": "nuniq_product", "uniqProductCustomer": "nuniq_prod_cus"}
_FEAT_COUNT = {"countCustomer": "feat_cus_count", "countProduct": "feat_prod_count", "countProductCustomer": "feat_prod_cus_count"}
_FEAT_UNIQ = {"uniqCustomer": "feat_cus_nuniq", "uniqProduct": "feat_prod_nuniq", "uniqProductCustomer": "feat_prod_cus_nuniq"}

for _field in C.COUNT_FIELDS:

    def _mk(field):
        @query(_COUNT_Q[field], count_sql(field))
        def _facts(spark, d):
            """D3: rows per (1-day batch, FileID, ids)."""
            return C.count_facts(blog(spark, d, 1), field)

        @query(_FEAT_COUNT[field], feat_sql(count_sql(field), field))
        def _feat(spark, d):
            """F11 stats of the 1-day count facts per FileID."""
            return C.fact_features(C.count_facts(blog(spark, d, 1), field), field)

        @query(_FEAT_COUNT[field] + "_deep", feat_sql(count_sql(field, 31), field, deep=True))
        def _deep(spark, d):
            """31-day facts summed per (FileID, ids), then F11 stats."""
            return C.fact_features(C.deep_counts(log_events(spark, d), field), field)

    _mk(_field)

for _field in C.UNIQ_FIELDS:

    def _mk2(field):
        @query(_UNIQ_Q[field], uniq_sql(field))
        def _facts(spark, d):
            """Distinct ids per (1-day batch, FileID)."""
            return C.uniq_facts(blog(spark, d, 1), field)

        @query(_FEAT_UNIQ[field], feat_sql(uniq_sql(field), field))
        def _feat(spark, d):
            """F11 stats of distinct counts per FileID."""
            return C.fact_features(C.uniq_facts(blog(spark, d, 1), field), field)

        @query(_FEAT_UNIQ[field] + "_deep", feat_sql(uniq_sql(field, 31), field))
        def _deep(spark, d):
            """D11 deep run: distinct counts over 31-day batches (single key level)."""
            return C.fact_features(C.uniq_facts(blog(spark, d, 31), field), field)

    _mk2(_field)

_DAILY_SQL = f'SELECT batch_id, "FileID", count(*) AS "FileIDCountDaily" FROM {B(1)} GROUP BY ALL'


@query("count_file", count_sql("countCustomer", deep=False).replace('"countCustomer"', '"countFile"'))
def count_file(spark, d):
    """D3 with deep=False: rows per (1-day batch, FileID)."""
    return C.count_facts(blog(spark, d, 1), "countCustomer", deep=False).withColumnRenamed(
        "countCustomer", "countFile"
    )


@query("daily_count", _DAILY_SQL)
def daily_count(spark, d):
    """Rows per file per 1-day batch."""
    return C.daily_count_facts(blog(spark, d, 1))


@query("feat_file_daily", feat_sql(_DAILY_SQL, "FileIDCountDaily"))
def feat_file_daily(spark, d):
    """F11 stats of the daily row counts (flattened names)."""
    return C.fact_features(C.daily_count_facts(blog(spark, d, 1)), "FileIDCountDaily")


# ------------------------------------------------------------------ calendars
HOUR_SQL = 'CAST(floor(("QueryTs" % 86400) / 3600) AS INTEGER)'
WEEK_SQL = 'isodow(make_timestamp("QueryTs" * 1000000)) - 1'


@query(
    "calendar_fields",
    f'SELECT "FileID", "QueryTs", hour(make_timestamp("QueryTs" * 1000000)) AS hour, '
    f"CAST({WEEK_SQL} AS INTEGER) AS weekday FROM {S.LOG_EVENTS}",
)
def calendar_fields(spark, d):
    """H1: hour of day and weekday (Monday = 0) of each event, UTC."""
    return log_events(spark, d).select(
        "FileID", "QueryTs", hour_of("QueryTs").alias("hour"), weekday_of("QueryTs").alias("weekday")
    )


def dense_sql(n, dim_name, dim_expr):
    """Dense pivot cells per batch: files of the batch x values of the batch."""
    b = B(n)
    dq = S.q(dim_name)
    return (
        f"(SELECT fb.batch_id, fb.\"FileID\", vb.{dq}, coalesce(c.cnt, 0) AS v FROM "
        f"(SELECT DISTINCT batch_id, \"FileID\" FROM {b}) fb "
        f"JOIN (SELECT DISTINCT batch_id, {dim_expr} AS {dq} FROM {b}) vb ON fb.batch_id = vb.batch_id "
        f"LEFT JOIN (SELECT batch_id, \"FileID\", {dim_expr} AS {dq}, count(*) AS cnt FROM {b} GROUP BY ALL) c "
        f"ON c.batch_id = fb.batch_id AND c.\"FileID\" = fb.\"FileID\" AND c.{dq} = vb.{dq})"
    )


def wide_sql(n, dim_name, dim_expr, stats, values):
    long = S.stats_sql(dense_sql(n, dim_name, dim_expr), ["FileID", dim_name], "v", stats)
    cols = ", ".join(
        f"coalesce(max(CASE WHEN {S.q(dim_name)} = '{v}' THEN {S.q(s)} END), 0) AS {S.q(f'{v}_{s}')}"
        for v in values
        for s in stats
    )
    return f'SELECT "FileID", {cols} FROM ({long}) GROUP BY "FileID"'


HOUR_DIM = f"'hour' || CAST({HOUR_SQL} AS VARCHAR)"
WEEK_DIM = f"'week' || CAST({WEEK_SQL} AS VARCHAR)"
HOURS = [f"hour{h}" for h in range(24)]
WEEKS = [f"week{w}" for w in range(7)]
PRODUCTS = ["click", "error", "purchase", "signup", "view"]


@query("hour_hist", f"SELECT batch_id, \"FileID\", hour, CAST(v AS BIGINT) AS \"Count\" FROM {dense_sql(1, 'hour', HOUR_DIM)}")
def hour_hist(spark, d):
    """Hour-of-day pivot cells per 1-day batch (0 inside a batch)."""
    return C.dense_dim_table(C.hour_facts(blog(spark, d, 1)), "hour")


@query("week_hist", f"SELECT batch_id, \"FileID\", week, CAST(v AS BIGINT) AS \"Count\" FROM {dense_sql(7, 'week', WEEK_DIM)}")
def week_hist(spark, d):
    """Weekday pivot cells per 7-day batch."""
    return C.dense_dim_table(C.week_facts(blog(spark, d, 7)), "week")


@query(
    "file_product_count",
    f'SELECT batch_id, "FileID", "ProductID", count(*) AS "Count" FROM {B(1)} GROUP BY ALL',
)
def file_product_count(spark, d):
    """File x product counts per 1-day batch, non-zero cells only.

    The reference's pivot also holds a 0 for every (file, product) pair of a
    batch; those cells are implied (files of the batch x products of the
    batch) and are what the statistics consume as implicit zeros.  They are
    not materialised: products per batch are not bounded.
    """
    return C.product_facts(blog(spark, d, 1)).withColumnRenamed("cnt", "Count")


@query(
    "hour_stats_long",
    S.stats_sql(dense_sql(1, "hour", HOUR_DIM), ["FileID", "hour"], "v", F9).replace(
        'GROUP BY "FileID", "hour"', 'GROUP BY "FileID", "hour" HAVING sum("v") > 0'
    ),
)
def hour_stats_long(spark, d):
    """D9+D1 long: F9 stats per (FileID, hour) from implicit zeros."""
    return C.dense_dim_stats(C.hour_facts(blog(spark, d, 1)), "hour", F9)


@query("feat_hour", wide_sql(1, "hour", HOUR_DIM, F9, HOURS))
def feat_hour(spark, d):
    """D11 etl_hour: F9 stats per hour column, 1-day batches, wide."""
    return C.hour_features(blog(spark, d, 1))


@query("feat_week", wide_sql(7, "week", WEEK_DIM, F9, WEEKS))
def feat_week(spark, d):
    """D11 etl_week: F9 stats per weekday column, 7-day batches, wide."""
    return C.week_features(blog(spark, d, 7))


@query("feat_prod_daily", wide_sql(1, "ProductID", S.q("ProductID"), F5, PRODUCTS))
def feat_prod_daily(spark, d):
    """D11 etl_file_prod_count: F5 stats per product column, 1-day batches, wide."""
    return C.product_daily_features(blog(spark, d, 1), PRODUCTS)


@query("prod_daily_stats", S.stats_sql(dense_sql(1, "ProductID", S.q("ProductID")), ["FileID", "ProductID"], "v", F5).replace(
    'GROUP BY "FileID", "ProductID"', 'GROUP BY "FileID", "ProductID" HAVING sum("v") > 0'))
def prod_daily_stats(spark, d):
    """D11 product detail, long: any number of products."""
    return C.product_daily_stats(blog(spark, d, 1))


def _share_sql():
    b = B(1)
    return (
        'SELECT "FileID", "ProductID", round(sum(share), 6) AS count_percentage FROM '
        '(SELECT *, c * 1.0 / sum(c) OVER (PARTITION BY batch_id, "FileID") AS share FROM '
        f'(SELECT batch_id, "FileID", "ProductID", count(*) AS c FROM {b} GROUP BY ALL)) GROUP BY ALL'
    )


@query("file_product_share", _share_sql())
def file_product_share(spark, d):
    """Per-batch product share of a file's events, summed over batches."""
    return C.product_share(blog(spark, d, 1))


def _hour_norm_sql():
    wide = wide_sql(1, "hour", HOUR_DIM, F9, HOURS)
    means = (
        'SELECT "FileID", ' + ", ".join(
            f"coalesce(avg(CASE WHEN hour = '{h}' THEN v END), 0) AS \"m_{h}\"" for h in HOURS
        ) + f' FROM {dense_sql(1, "hour", HOUR_DIM)} GROUP BY "FileID"'
    )
    total = " + ".join(f'"m_{h}"' for h in HOURS)
    pct = ", ".join(
        f'round(CASE WHEN ({total}) = 0 THEN NULL ELSE "m_{h}" / ({total}) END, 6) AS "{h}_percentage"'
        for h in HOURS
    )
    return f'SELECT w.*, {pct} FROM ({wide}) w JOIN ({means}) m USING ("FileID")'


@query("norm_percentage", _hour_norm_sql())
def norm_percentage(spark, d):
    """Hour features with row-normalised mean shares appended."""
    return C.norm_percentage(C.hour_features(blog(spark, d, 1)))


@query(
    "union_batches",
    f'SELECT batch_id, "FileID", count(*) AS n, NULL::BIGINT AS nuniq FROM {B(7)} WHERE batch_id = 0 GROUP BY ALL '
    f'UNION ALL SELECT batch_id, "FileID", NULL::BIGINT AS n, count(DISTINCT "CustomerID") AS nuniq FROM {B(7)} '
    "WHERE batch_id > 0 GROUP BY ALL",
)
def union_batches(spark, d):
    """Union of per-batch frames with different columns (missing -> NULL)."""
    b = blog(spark, d, 7)
    first = b.where(F.col("batch_id") == 0).groupBy("batch_id", "FileID").agg(F.count(F.lit(1)).alias("n"))
    rest = b.where(F.col("batch_id") > 0).groupBy("batch_id", "FileID").agg(
        F.count_distinct("CustomerID").alias("nuniq")
    )
    return C.union_batches([first, rest])


@query(
    "merge_add",
    f'SELECT "FileID", "CustomerID", sum(c) AS "countCustomer" FROM ('
    f'SELECT "FileID", "CustomerID", count(*) AS c FROM {B(1)} WHERE batch_id < 15 GROUP BY ALL '
    f'UNION ALL SELECT "FileID", "CustomerID", count(*) AS c FROM {B(1)} WHERE batch_id >= 15 GROUP BY ALL'
    ") GROUP BY ALL",
)
def merge_add(spark, d):
    """Merge-by-add of two partial count tables (union + sum, 0-filled)."""
    b = blog(spark, d, 1)
    first = C.count_facts(b.where(F.col("batch_id") < 15), "countCustomer").drop("batch_id")
    rest = C.count_facts(b.where(F.col("batch_id") >= 15), "countCustomer").drop("batch_id")
    return C.merge_add([first, rest], ["FileID", "CustomerID"], "countCustomer")
