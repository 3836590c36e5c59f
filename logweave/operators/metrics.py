"""Evaluation metrics over scored tables and deterministic splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.session import cut_lineage

# Bins of the streaming AUC and the logit clip epsilon.
AUC_BINS = 200
EPSILON = 1e-7


SCORES_PER_BUCKET = 1_000_000
MAX_BUCKETS = 100_000


def score_ranks(df: DataFrame, score: str = "score", label: str = "label", buckets: int | None = None) -> DataFrame:
    """``(score, pos, neg, pos_below, neg_below)`` per distinct score.

    Distributed prefix sum: distinct scores are routed (binary search,
    ``Bucketizer``) into buckets cut at approximate quantiles -- about a
    million distinct scores per bucket, at least 64 -- so boundaries only
    route rows and results are exact.  Bucket totals are prefix-summed over
    the bucket table (one row per bucket), then counts below are completed
    inside each bucket.  No window ever spans all scores.
    """
    from pyspark.ml.feature import Bucketizer

    g = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(
        F.col(score).cast("double").alias("s")
    ).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum((1 - F.col(label)).cast("long")).alias("neg"),
    )
    g = cut_lineage(g)  # distinct scores: computed once, used three times
    if buckets is None:
        buckets = int(min(max(64, -(-g.count() // SCORES_PER_BUCKET)), MAX_BUCKETS))
    probs = [i / buckets for i in range(1, buckets)]
    # ``buckets - 1`` boundary values (bounded list), strictly increasing.
    cuts = g.select(F.percentile_approx("s", probs, 10000).alias("c")).first()["c"] or []
    splits = [float("-inf")] + sorted(set(float(c) for c in cuts)) + [float("inf")]
    gb = Bucketizer(splits=splits, inputCol="s", outputCol="_b").transform(g)
    tot = gb.groupBy("_b").agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"))
    wb = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(
        "_b",
        F.coalesce(F.sum("_bp").over(wb), F.lit(0)).alias("_op"),
        F.coalesce(F.sum("_bn").over(wb), F.lit(0)).alias("_on"),
    )
    wi = Window.partitionBy("_b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    within = gb.select(
        "_b", "s", "pos", "neg",
        F.coalesce(F.sum("pos").over(wi), F.lit(0)).alias("_ip"),
        F.coalesce(F.sum("neg").over(wi), F.lit(0)).alias("_in"),
    )
    # one row per bucket (<= MAX_BUCKETS): bounded broadcast
    return within.join(F.broadcast(offs), "_b").select(
        F.col("s").alias(score),
        "pos",
        "neg",
        (F.col("_op") + F.col("_ip")).alias("pos_below"),
        (F.col("_on") + F.col("_in")).alias("neg_below"),
    )


def roc_auc(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """M8: exact ROC AUC with ties counted half; NULL when a class is absent."""
    r = score_ranks(df, score, label)
    agg = r.agg(
        F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg"))).alias("_num"),
        F.sum("pos").alias("_P"),
        F.sum("neg").alias("_Q"),
    )
    return agg.select(F.try_divide(F.col("_num"), F.col("_P") * F.col("_Q")).alias("auc"))


def score_histogram(df: DataFrame, score: str = "score", label: str = "label", bins: int = AUC_BINS) -> DataFrame:
    """``(bin, pos, neg)``: bin = least(floor(score * bins), bins - 1)."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(b.alias("bin")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum((1 - F.col(label)).cast("long")).alias("neg")
    )


def binned_auc(df: DataFrame, score: str = "score", label: str = "label", bins: int = AUC_BINS) -> DataFrame:
    """M9: AUC from a ``bins``-bin score histogram (trapezoid over the ROC
    points obtained by thresholding at each bin, top bin first)."""
    return auc_from_histogram(score_histogram(df, score, label, bins))


def auc_from_histogram(hist: DataFrame) -> DataFrame:
    """Trapezoid AUC from ``(bin, pos, neg)`` facts (summed per bin first, so
    per-batch histograms can be passed as they are).  At most ``bins`` rows
    reach the ordered window."""
    h = hist.groupBy("bin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    w = Window.orderBy(F.desc("bin"))
    cum = h.select(
        "bin",
        F.sum("pos").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("tp"),
        F.sum("neg").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("fp"),
    )
    tot = h.agg(F.sum("pos").alias("P"), F.sum("neg").alias("Q"))
    pts = cum.select(
        "bin",
        F.try_divide(F.col("tp"), tot.select("P").scalar()).alias("tpr"),
        F.try_divide(F.col("fp"), tot.select("Q").scalar()).alias("fpr"),
    )
    seg = pts.select(
        (
            (F.col("fpr") - F.coalesce(F.lag("fpr").over(w), F.lit(0.0)))
            * (F.col("tpr") + F.coalesce(F.lag("tpr").over(w), F.lit(0.0)))
            / 2
        ).alias("a")
    )
    return seg.agg(F.sum("a").alias("auc"))


def ranking_logloss(df: DataFrame, p: str = "score", y: str = "label", eps: float = EPSILON) -> DataFrame:
    """Mean log-loss plus the squared shortfall of positives' logits
    below the best negative logit, averaged over (positives + 1)."""
    pc = F.least(F.greatest(F.col(p), F.lit(eps)), F.lit(1 - eps))
    z = F.log(pc / (1 - pc))
    yy = F.col(y).cast("double")
    base = df.select(pc.alias("_p"), z.alias("_z"), yy.alias("_y"))
    zmax = base.select(F.max(F.col("_z") * (F.col("_y") < 1).cast("double"))).scalar()
    r = F.pow(F.least(F.greatest((F.col("_z") - zmax) * F.col("_y"), F.lit(-100.0)), F.lit(0.0)), 2)
    ll = -(F.col("_y") * F.log(F.col("_p")) + (1 - F.col("_y")) * F.log(1 - F.col("_p")))
    return base.agg(
        (F.sum(r) / (F.sum((F.col("_y") > 0).cast("double")) + 1) + F.avg(ll)).alias("ranking_logloss")
    )


def hash_fraction(key, seed: int = 0):
    """Deterministic value in [0, 100) from md5 of ``seed:key`` (engine independent)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("long"), F.lit(100))


def shuffle_split(df: DataFrame, key: str, test_pct: int = 33, seed: int = 42, n_splits: int = 1) -> DataFrame:
    """M5: ``n_splits`` repeated train/test splits by hash of the key
    (output gains ``split_no`` and ``subset``)."""
    out = None
    for k in range(n_splits):
        part = df.withColumn("split_no", F.lit(k)).withColumn(
            "subset", F.when(hash_fraction(key, seed + k) < test_pct, "test").otherwise("train")
        )
        out = part if out is None else out.unionByName(part)
    return out
