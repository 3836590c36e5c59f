"""Classifiers, stacking, parameter search, scoring and model persistence."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.operators.metrics import hash_fraction, roc_auc
from logweave.session import cut_lineage

# Class weights of the reference (negatives 1, positives 8).
POSITIVE_WEIGHT = 8.0
META_C = 0.1


def with_weights(df: DataFrame, label: str = "y", pos_weight: float = POSITIVE_WEIGHT, out: str = "w") -> DataFrame:
    """Per-row weight, ``pos_weight`` for positives (scale_pos_weight)."""
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(pos_weight)).otherwise(F.lit(1.0)))


def gbt(features: str = "features", label: str = "y", weight: str | None = "w", **params) -> GBTClassifier:
    """M1: weighted gradient-boosted trees."""
    est = GBTClassifier(featuresCol=features, labelCol=label, seed=42, **params)
    if weight:
        est = est.setWeightCol(weight)
    return est


def stacking(
    train: DataFrame,
    bases: Sequence,
    features: str = "features",
    label: str = "y",
    c: float = META_C,
    weight: str | None = None,
) -> PipelineModel:
    """M2: fit base classifiers in-sample, feed all their class
    probabilities to a logistic meta learner (L2 strength 1/(C n)).  With
    ``weight`` the bases are fitted on weighted rows."""
    n = train.count()
    stages, cols = [], []
    for i, b in enumerate(bases):
        b = b.copy().setFeaturesCol(features).setLabelCol(label)
        b = b.setProbabilityCol(f"p{i}").setRawPredictionCol(f"r{i}").setPredictionCol(f"h{i}")
        if weight:
            b = b.setWeightCol(weight)
        stages.append(b)
        cols.append(f"p{i}")
    stages.append(VectorAssembler(inputCols=cols, outputCol="meta"))
    stages.append(
        LogisticRegression(featuresCol="meta", labelCol=label, regParam=1.0 / (c * max(n, 1)), standardization=False)
    )
    return Pipeline(stages=stages).fit(train)


def grid_search(train: DataFrame, estimator, grid: dict, folds: int = 3, parallelism: int = 4, label: str = "y"):
    """M3: exhaustive grid, k-fold CV on ROC AUC, refit on all data."""
    b = ParamGridBuilder()
    for p, vals in grid.items():
        b = b.addGrid(getattr(estimator, p), vals)
    ev = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    cv = CrossValidator(
        estimator=estimator, estimatorParamMaps=b.build(), evaluator=ev, numFolds=folds, parallelism=parallelism, seed=42
    )
    return cv.fit(train)


def sample_params(space: dict, draws: int, seed: int = 42) -> list[dict]:
    """M4 draws: ('int', lo, hi) uniform integers, ('log', lo, hi) log-uniform
    (reciprocal), or a list to choose from."""
    import math

    rnd = random.Random(seed)
    out = []
    for _ in range(draws):
        d = {}
        for k, spec in space.items():
            if isinstance(spec, list):
                d[k] = rnd.choice(spec)
            elif spec[0] == "int":
                d[k] = rnd.randint(spec[1], spec[2])
            else:
                d[k] = math.exp(rnd.uniform(math.log(spec[1]), math.log(spec[2])))
        out.append(d)
    return out


def random_search(
    df: DataFrame,
    make_estimator,
    space: dict,
    draws: int,
    splits: int,
    key: str,
    test_pct: int = 33,
    label: str = "y",
    seed: int = 42,
) -> tuple[DataFrame, dict]:
    """M4: random parameter draws, each scored by mean validation AUC over
    ``splits`` hash shuffle-splits of ``key``.  Returns (results, best).

    The input's lineage is cut once; every fit reads that copy."""
    rows = []
    df = cut_lineage(df)
    for i, params in enumerate(sample_params(space, draws, seed)):
        aucs = []
        for s in range(splits):
            part = df.withColumn("_t", hash_fraction(key, seed + s) < test_pct)
            model = make_estimator(**params).fit(part.where(~F.col("_t")))
            pred = model.transform(part.where(F.col("_t"))).select(
                vector_to_array("probability")[1].alias("score"), F.col(label).alias("label")
            )
            aucs.append(roc_auc(pred).first().auc)
        valid = [a for a in aucs if a is not None]
        rows.append((i, str(params), float(sum(valid) / len(valid)) if valid else None))
    res = df.sparkSession.createDataFrame(rows, "draw int, params string, mean_auc double")
    best = max(rows, key=lambda r: -1 if r[2] is None else r[2])
    return res, sample_params(space, draws, seed)[best[0]]


def score(model, df: DataFrame, key: str = "FileID", prob_col: str = "probability") -> DataFrame:
    """``(key, probability of class 1)``."""
    return model.transform(df).select(key, vector_to_array(prob_col)[1].alias("probability"))


def search_refit_score(
    train: DataFrame,
    test: DataFrame,
    make_estimator,
    space: dict,
    path: str,
    draws: int = 3,
    splits: int = 1,
    key: str = "FileID",
    label: str = "y",
) -> tuple[DataFrame, dict]:
    """M3/M4/A15 as one path: search the parameters on ``train``, refit the best
    on all of it, score ``test`` and write the predictions to ``path``.

    ``make_estimator(**params)`` gives anything with ``fit``, such as
    :class:`Stack`.  Returns (predictions as written, best parameters)."""
    train = cut_lineage(train)
    _, best = random_search(train, make_estimator, space, draws, splits, key, label=label)
    score(make_estimator(**best).fit(train), test, key).write.mode("overwrite").parquet(path)
    return train.sparkSession.read.parquet(path), best


class Stack:
    """A weighted stack with its parameters, as an estimator for the searches."""

    def __init__(self, bases: Sequence, c: float = META_C, weight: str | None = "w", label: str = "y"):
        self.bases, self.c, self.weight, self.label = bases, c, weight, label

    def fit(self, train: DataFrame) -> PipelineModel:
        return stacking(train, self.bases, label=self.label, c=self.c, weight=self.weight)


def save_model(model, path: str) -> None:
    """Persist (overwrite) a fitted model or pipeline."""
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def rf(features: str = "features", label: str = "y", **params) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol=features, labelCol=label, seed=42, **params)
