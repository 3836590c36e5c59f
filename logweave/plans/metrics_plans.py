"""Queries: AUC (exact and binned), ranking log-loss, hash splits."""

from __future__ import annotations

from logweave.operators import metrics as M
from logweave.plans import sqlgen as S
from logweave.plans.registry import query
from logweave.sources.fixtures import ids_events, scored_events

SCORED = (
    "(SELECT event_id, least(greatest(value / 600.0, 0.0), 1.0) AS score, "
    "CAST(event_type = 'purchase' AS INTEGER) AS label FROM events)"
)

_AUC_SQL = f"""
WITH r AS (SELECT label, rank() OVER (ORDER BY score) AS rk, count(*) OVER (PARTITION BY score) AS c FROM {SCORED}),
t AS (SELECT sum(CASE WHEN label = 1 THEN rk + (c - 1) / 2.0 END) AS sr,
             sum(label) AS p, sum(1 - label) AS q FROM r)
SELECT {S.rnd('CASE WHEN p * q = 0 THEN NULL ELSE (sr - p * (p + 1) / 2.0) / (p * q) END')} AS auc FROM t
"""


@query("roc_auc", _AUC_SQL)
def roc_auc(spark, d):
    """M8: exact ROC AUC of the deterministic event score (ties half)."""
    return M.roc_auc(scored_events(spark, d))


_BINNED_SQL = f"""
WITH h AS (SELECT least(floor(score * 200), 199) AS bin, sum(label) AS pos, sum(1 - label) AS neg FROM {SCORED} GROUP BY 1),
c AS (SELECT bin, sum(pos) OVER (ORDER BY bin DESC) AS tp, sum(neg) OVER (ORDER BY bin DESC) AS fp FROM h),
t AS (SELECT sum(pos) AS p, sum(neg) AS q FROM h),
pts AS (SELECT bin, tp * 1.0 / p AS tpr, fp * 1.0 / q AS fpr FROM c, t)
SELECT {S.rnd('sum((fpr - coalesce(lag(fpr) OVER (ORDER BY bin DESC), 0)) * (tpr + coalesce(lag(tpr) OVER (ORDER BY bin DESC), 0)) / 2)')} AS auc
FROM pts
"""
# DuckDB cannot nest a window in an aggregate; compute the segments first.
_BINNED_SQL = _BINNED_SQL.replace(
    "SELECT " + S.rnd('sum((fpr - coalesce(lag(fpr) OVER (ORDER BY bin DESC), 0)) * (tpr + coalesce(lag(tpr) OVER (ORDER BY bin DESC), 0)) / 2)') + " AS auc\nFROM pts",
    "SELECT " + S.rnd("sum(a)") + " AS auc FROM (SELECT (fpr - coalesce(lag(fpr) OVER (ORDER BY bin DESC), 0)) * "
    "(tpr + coalesce(lag(tpr) OVER (ORDER BY bin DESC), 0)) / 2 AS a FROM pts)",
)


@query("binned_auc", _BINNED_SQL)
def binned_auc(spark, d):
    """M9: 200-bin streaming-style AUC of the event score."""
    return M.binned_auc(scored_events(spark, d))


_RL_SQL = f"""
WITH b AS (SELECT least(greatest(score, 1e-7), 1 - 1e-7) AS p, CAST(label AS DOUBLE) AS y FROM {SCORED}),
z AS (SELECT p, y, ln(p / (1 - p)) AS z FROM b),
m AS (SELECT max(z * CAST(y < 1 AS DOUBLE)) AS zmax FROM z)
SELECT {S.rnd('sum(power(least(greatest((z - zmax) * y, -100.0), 0.0), 2)) / (sum(CAST(y > 0 AS DOUBLE)) + 1) + avg(-(y * ln(p) + (1 - y) * ln(1 - p)))')} AS ranking_logloss
FROM z, m
"""


@query("ranking_logloss", _RL_SQL)
def ranking_logloss(spark, d):
    """Log-loss plus ranking penalty over the scored events."""
    return M.ranking_logloss(scored_events(spark, d))


@query(
    "shuffle_split",
    "SELECT \"FileID\", s AS split_no, CASE WHEN "
    "(CAST(('0x' || substr(md5(CAST(42 + s AS VARCHAR) || ':' || \"FileID\"), 1, 8)) AS BIGINT) % 100) < 33 "
    f"THEN 'test' ELSE 'train' END AS subset FROM {S.IDS_EVENTS}, range(0, 3) t(s)",
)
def shuffle_split(spark, d):
    """M5: three 33 % hash splits of the file ids (md5 rule, engine independent)."""
    ids = ids_events(spark, d).select("FileID")
    return M.shuffle_split(ids, "FileID", 33, 42, n_splits=3).select("FileID", "split_no", "subset")
