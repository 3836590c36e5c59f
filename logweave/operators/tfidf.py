"""Corpora of FileIDs and per-token TF-IDF summaries.

A corpus is long: ``(doc, token, tf)``.  TF-IDF follows the vectorizer
defaults the reference relies on: lower-case, tokens of two or more word
characters, smooth idf ``ln((1+N)/(1+df)) + 1``, raw tf, L2 row norm.
Per token the summary runs over *all* N documents, the N - df documents
without the token contributing zeros; those zeros enter the stat engine as
one weighted row, so the doc x token matrix is never materialised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.functions.stats import describe_compressed
from logweave.operators.overlap import common_filter

# Fixed value: the vectorizer's default token pattern (2+ word characters).
TOKEN_PATTERN = r"(?U)\b\w\w+\b"

TFIDF_STATS = {
    "mean": "mean",
    "median": "median",
    "std": "std_pop",
    "min": "min",
    "max": "max",
    "ptp": "ptp",
    "q1": "percentile_25",
    "q3": "percentile_75",
}


def tokens_of(col: str = "FileID") -> F.Column:
    return F.explode(F.regexp_extract_all(F.lower(F.col(col)), F.lit(TOKEN_PATTERN), 0))


def corpus(log: DataFrame, field: str) -> DataFrame:
    """K1: doc = value of ``field``; tokens = the FileIDs of its rows (with repeats).

    Output ``(doc, token, tf)``; a document with rows that yield no token
    also has a ``(doc, NULL, 0)`` row, so it still counts in N.  Growing the
    corpus across batches is a sum of tf, so the batch and incremental forms
    agree.
    """
    rows = log.where(F.col(field).isNotNull()).select(F.col(field).cast("string").alias("doc"), "FileID")
    return _tf(rows)


def corpus_by_batch(blog: DataFrame, target: dict[str, DataFrame] | None = None, typ: str = "tight") -> DataFrame:
    """K2: doc = n-day batch; tokens = all FileIDs of the batch, with ``target``
    (member sets) only of the rows that ``common_filter`` keeps.  A batch that
    the filter empties is still a document: all have a ``(doc, NULL, 0)`` row then."""
    doc = F.col("batch_id").cast("string").alias("doc")
    if target is None:
        return _tf(blog.select(doc, "FileID"))
    rows = common_filter(blog, target, typ).select(doc, "FileID")
    return _tf(rows.unionByName(blog.select(doc).distinct().withColumn("FileID", F.lit(None).cast("string"))))


def _tf(rows: DataFrame) -> DataFrame:
    """One aggregation: ``explode_outer`` keeps rows whose FileID yields no
    token as ``(doc, NULL, 0)`` markers, so such documents still count in N
    without a second pass over the input."""
    toks = rows.select(
        "doc", F.explode_outer(F.regexp_extract_all(F.lower(F.col("FileID")), F.lit(TOKEN_PATTERN), 0)).alias("token")
    )
    return toks.groupBy("doc", "token").agg(F.count("token").alias("tf"))


def tfidf_weights(corp: DataFrame) -> DataFrame:
    """``(doc, token, x, idf)``: L2-normalised tf-idf of present cells."""
    # Scalar subquery: N is computed once and inlined, no join.
    n_docs = corp.select(F.count_distinct("doc")).scalar()
    present = corp.where(F.col("token").isNotNull())
    dfreq = present.groupBy("token").agg(F.count(F.lit(1)).alias("_df"))
    idf = dfreq.select("token", "_df", n_docs.alias("_N")).withColumn(
        "idf", F.log((1 + F.col("_N")) / (1 + F.col("_df"))) + 1
    )
    w = present.join(idf, "token").withColumn("_w", F.col("tf") * F.col("idf"))
    norm = w.groupBy("doc").agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_norm"))
    return w.join(norm, "doc").select(
        "doc", "token", (F.col("_w") / F.col("_norm")).alias("x"), "idf", "_df", "_N"
    )


def tfidf_summary(corp: DataFrame, field: str) -> DataFrame:
    """K3: per token (FileID): mean, median, std (population), min, max, ptp,
    q1, q3 of its tf-idf over all documents, and its idf."""
    wts = tfidf_weights(corp)
    comp = wts.groupBy("token", "x").agg(F.count(F.lit(1)).alias("w"))
    per_tok = wts.groupBy("token").agg(
        F.first("idf").alias("idf"), F.first("_df").alias("_df"), F.first("_N").alias("_N")
    )
    zeros = per_tok.where(F.col("_N") > F.col("_df")).select(
        "token", F.lit(0.0).alias("x"), (F.col("_N") - F.col("_df")).alias("w")
    )
    stats = list(TFIDF_STATS.values())
    res = describe_compressed(comp.unionByName(zeros), ["token"], stats)
    out = res.join(per_tok.select("token", "idf"), "token")
    cols = [F.col("token").alias("FileID")]
    cols += [F.col(src).alias(f"{field}_tfidf_{name}") for name, src in TFIDF_STATS.items()]
    cols.append(F.col("idf").alias(f"{field}_idf"))
    return out.select(*cols)
