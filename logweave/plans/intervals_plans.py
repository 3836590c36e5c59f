"""Queries: log scan, day batches, intervals and interval features."""

from __future__ import annotations


from logweave.functions.stats import F12
from logweave.operators.batches import assign_batches
from logweave.operators.intervals import (
    FIELD_KEYS,
    interval_features,
    interval_name,
    last_seen,
    open_intervals,
)
from logweave.plans import sqlgen as S
from logweave.plans.registry import query
from logweave.sources.fixtures import log_events, log_lineitem
from logweave.sources.log import clean_log

LOG_COLS = '"FileID", "CustomerID", "QueryTs", "ProductID"'


@query("scan_query_log", f"SELECT {LOG_COLS} FROM {S.LOG_EVENTS}")
def scan_query_log(spark, d):
    """A1/B1: the events table read as a cleaned query log."""
    return clean_log(log_events(spark, d))


@query(
    "scan_query_log_lineitem",
    f"SELECT {LOG_COLS} FROM {S.LOG_LINEITEM}",
)
def scan_query_log_lineitem(spark, d):
    """A1 at scale: lineitem JOIN orders as a query log."""
    return clean_log(log_lineitem(spark, d))


for _n in (1, 7, 31):

    def _mk(n):
        @query(
            f"assign_batches_{n}",
            f'SELECT "FileID", "QueryTs", day, batch_id FROM {S.batched(S.LOG_EVENTS, n)}',
        )
        def _q(spark, d):
            """A3: batch of n consecutive days (dense rank over days)."""
            return assign_batches(log_events(spark, d), n).select("FileID", "QueryTs", "day", "batch_id")

        return _q

    _mk(_n)


def _lag_sql(field: str, log: str = S.LOG_EVENTS) -> str:
    keys = ["FileID"] + FIELD_KEYS[field]
    kq = ", ".join(S.q(k) for k in keys)
    out = S.q(f"QueryTsInterval{field}")
    return (
        f"SELECT * FROM (SELECT {kq}, \"QueryTs\", "
        f"\"QueryTs\" - lag(\"QueryTs\") OVER (PARTITION BY {kq} ORDER BY \"QueryTs\") AS {out} "
        f"FROM {log}) WHERE {out} IS NOT NULL"
    )


_SUFFIX = {"": "", "CustomerID": "_customer", "ProductID": "_product", "ProductCustomerID": "_prod_cus"}

for _field, _sfx in _SUFFIX.items():

    def _mk2(field, sfx):
        @query(f"open_interval{sfx}", _lag_sql(field))
        def _iv(spark, d):
            """Seconds since the previous event of the key."""
            return open_intervals(log_events(spark, d), field)

        @query(
            f"feat_interval{sfx}",
            S.stats_sql(
                f"({_lag_sql(field)})",
                ["FileID"],
                f"QueryTsInterval{field}",
                F12,
                name=lambda s: interval_name(s, field),
            ),
        )
        def _feat(spark, d):
            """F12 statistics of the intervals per FileID."""
            return interval_features(log_events(spark, d), field)

    _mk2(_field, _sfx)


@query(
    "feat_interval_lineitem",
    S.stats_sql(f"({_lag_sql('', S.LOG_LINEITEM)})", ["FileID"], "QueryTsInterval", F12,
                name=lambda s: interval_name(s, "")),
)
def feat_interval_lineitem(spark, d):
    """D12 on the lineitem log (many equal timestamps: shipdate is a date)."""
    return interval_features(log_lineitem(spark, d))


@query(
    "last_seen",
    f'SELECT "FileID", "CustomerID", max("QueryTs") AS max_timestamp FROM {S.LOG_EVENTS} GROUP BY 1, 2',
)
def last_seen_q(spark, d):
    """Latest timestamp per (FileID, CustomerID)."""
    return last_seen(log_events(spark, d), ["FileID", "CustomerID"])


