"""Queries: corpora and TF-IDF summaries."""

from __future__ import annotations

from logweave.operators import tfidf as T
from logweave.operators.batches import assign_batches
from logweave.plans import sqlgen as S
from logweave.plans.registry import query
from logweave.sources.fixtures import log_events

TOK = "unnest(regexp_extract_all(lower(\"FileID\"), '\\b\\w\\w+\\b'))"


def corpus_sql(doc_expr, src=S.LOG_EVENTS):
    return (
        f"SELECT doc, token, count(*) AS tf FROM "
        f"(SELECT CAST({doc_expr} AS VARCHAR) AS doc, {TOK} AS token FROM {src}) GROUP BY ALL"
    )


def tfidf_sql(doc_expr, field, src=S.LOG_EVENTS):
    """Dense derivation: every doc x every token, zeros filled, numpy-style stats."""
    c = corpus_sql(doc_expr, src)
    r = S.rnd
    return f"""
WITH c AS ({c}),
docs AS (SELECT DISTINCT CAST({doc_expr} AS VARCHAR) AS doc FROM {src}),
nd AS (SELECT count(*) AS n FROM docs),
dq AS (SELECT token, count(*) AS df FROM c GROUP BY token),
w AS (SELECT c.doc, c.token, c.tf * (ln((1 + nd.n) / (1 + dq.df)) + 1) AS w
      FROM c JOIN dq ON c.token = dq.token, nd),
x AS (SELECT doc, token, w / sqrt(sum(w * w) OVER (PARTITION BY doc)) AS x FROM w),
dense AS (SELECT dq.token, coalesce(x.x, 0) AS x FROM docs CROSS JOIN dq
          LEFT JOIN x ON x.doc = docs.doc AND x.token = dq.token)
SELECT dense.token AS "FileID",
  {r('avg(x)')} AS "{field}_tfidf_mean",
  {r('quantile_cont(x, 0.5)')} AS "{field}_tfidf_median",
  {r('stddev_pop(x)')} AS "{field}_tfidf_std",
  {r('min(x)')} AS "{field}_tfidf_min",
  {r('max(x)')} AS "{field}_tfidf_max",
  {r('max(x) - min(x)')} AS "{field}_tfidf_ptp",
  {r('quantile_cont(x, 0.25)')} AS "{field}_tfidf_q1",
  {r('quantile_cont(x, 0.75)')} AS "{field}_tfidf_q3",
  {r('ln((1 + any_value(nd.n)) / (1 + any_value(dq.df))) + 1')} AS "{field}_idf"
FROM dense JOIN dq ON dense.token = dq.token, nd GROUP BY dense.token
"""


DAY_DOC = "batch_id"
DAY_SRC = S.batched(S.LOG_EVENTS, 1)


@query("corpus_tf", corpus_sql('"ProductID"'))
def corpus_tf(spark, d):
    """K1: corpus per product; tokens are the FileIDs of its rows."""
    return T.corpus(log_events(spark, d), "ProductID")


@query("corpus_day", corpus_sql(DAY_DOC, DAY_SRC))
def corpus_day(spark, d):
    """K2: corpus per 1-day batch."""
    return T.corpus_by_batch(assign_batches(log_events(spark, d), 1))


@query("tfidf_product", tfidf_sql('"ProductID"', "ProductID"))
def tfidf_product(spark, d):
    """K3/K4 etl_tfidf_prod: per-FileID tf-idf summary over product documents."""
    return T.tfidf_summary(T.corpus(log_events(spark, d), "ProductID"), "ProductID")


@query("tfidf_customer", tfidf_sql('"CustomerID"', "CustomerID"))
def tfidf_customer(spark, d):
    """K3/K4 etl_tfidf_cus: summary over customer documents."""
    return T.tfidf_summary(T.corpus(log_events(spark, d), "CustomerID"), "CustomerID")


@query("tfidf_day", tfidf_sql(DAY_DOC, "day", DAY_SRC))
def tfidf_day(spark, d):
    """K3/K4 etl_tfidf_day: summary over 1-day batch documents."""
    return T.tfidf_summary(T.corpus_by_batch(assign_batches(log_events(spark, d), 1)), "day")
