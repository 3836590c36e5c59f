"""Model operators on data whose answer is known."""

import random

import pytest
from pyspark.sql import functions as F

from logweave.operators import cluster as CL
from logweave.operators import models as MD
from logweave.operators.metrics import roc_auc


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(240):
        y = int(i % 4 == 0)
        rows.append((f"f{i}", y, [y + rnd.gauss(0, 0.25), rnd.random()]))
    df = spark.createDataFrame(rows, "FileID string, y int, x array<double>")
    return MD.with_weights(CL.as_vector(df, "x")).cache()


def auc(model, df):
    s = MD.score(model, df).join(df.select("FileID", F.col("y").alias("label")), "FileID")
    return roc_auc(s.withColumnRenamed("probability", "score")).first().auc


def test_weights(data):
    assert {(r.y, r.w) for r in data.select("y", "w").distinct().collect()} == {(0, 1.0), (1, MD.POSITIVE_WEIGHT)}


def test_gbt_separates_and_survives_saving(spark, data, tmp_path):
    from pyspark.ml import Pipeline

    model = Pipeline(stages=[MD.gbt(maxIter=5)]).fit(data)
    assert auc(model, data) > 0.97
    MD.save_model(model, str(tmp_path / "m"))
    a, b = (sorted(map(tuple, MD.score(m, data).collect())) for m in (model, MD.load_pipeline(str(tmp_path / "m"))))
    assert a == b and len(a) == 240 and all(0 <= p <= 1 for _, p in a)


def test_weighted_stack(data):
    model = MD.stacking(data, [MD.gbt(maxIter=3), MD.rf(numTrees=5)])
    assert auc(model, data) > 0.97 and len(model.stages) == 4


def test_searches(data):
    found = MD.grid_search(data, MD.gbt(maxIter=2), {"maxDepth": [1, 2]}, folds=2)
    assert len(found.avgMetrics) == 2 and max(found.avgMetrics) > 0.9
    draws = MD.sample_params({"maxDepth": ("int", 1, 3), "stepSize": ("log", 0.01, 0.5), "maxIter": [2]}, 5, seed=1)
    assert draws == MD.sample_params({"maxDepth": ("int", 1, 3), "stepSize": ("log", 0.01, 0.5), "maxIter": [2]}, 5, seed=1)
    assert all(1 <= p["maxDepth"] <= 3 and 0.01 <= p["stepSize"] <= 0.5 for p in draws)
    table, best = MD.random_search(data, MD.gbt, {"maxDepth": ("int", 1, 2), "maxIter": [2]}, draws=2, splits=1, key="FileID")
    rows = table.collect()
    assert len(rows) == 2 and best["maxDepth"] in (1, 2) and max(r.mean_auc for r in rows) > 0.85


def test_search_refit_score_writes_predictions(data, tmp_path):
    train, test = data.where("FileID not like '%6'"), data.where("FileID like '%6'")
    make = lambda c: MD.Stack([MD.gbt(maxIter=2), MD.rf(numTrees=3)], c)
    found, best = MD.search_refit_score(train, test, make, {"c": ("log", 0.1, 1.0)}, str(tmp_path / "p"), draws=2)
    rows = found.join(test.select("FileID", "y"), "FileID").collect()
    assert len(rows) == test.count() and 0.1 <= best["c"] <= 1.0
    good, bad = ([r.probability for r in rows if r.y == y] for y in (1, 0))
    assert sum(g > b for g in good for b in bad) > 0.95 * len(good) * len(bad)
