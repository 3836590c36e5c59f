import itertools
import random

import pytest

from logweave.operators import metrics as M


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    if not pos or not neg:
        return None
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_auc_ties_and_buckets(spark):
    rnd = random.Random(7)
    rows = [(round(rnd.random(), 2), rnd.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "score double, label int")
    got = M.roc_auc(df).first().auc
    assert got == pytest.approx(brute_auc(rows), abs=1e-12)
    # a third of the rows on one score (hot tie) still exact
    rows2 = rows + [(0.5, i % 2) for i in range(200)]
    got2 = M.roc_auc(spark.createDataFrame(rows2, "score double, label int")).first().auc
    assert got2 == pytest.approx(brute_auc(rows2), abs=1e-12)


def test_auc_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.4, 1)], "score double, label int")
    assert M.roc_auc(df).first().auc is None


def test_binned_auc_close_to_exact(spark):
    rnd = random.Random(3)
    rows = [(min(max(rnd.gauss(0.4 + 0.2 * y, 0.15), 0.0), 1.0), y) for y in (0, 1) for _ in range(300)]
    df = spark.createDataFrame(rows, "score double, label int")
    assert M.binned_auc(df).first().auc == pytest.approx(brute_auc(rows), abs=0.01)


def test_ranking_logloss_hand(spark):
    import math

    rows = [(0.9, 1), (0.2, 0), (0.6, 0), (0.3, 1)]
    df = spark.createDataFrame(rows, "score double, label int")
    z = {p: math.log(p / (1 - p)) for p, _ in rows}
    zmax = max([z[p] * (y < 1) for p, y in rows])
    rank = sum(min(max((z[p] - zmax) * y, -100), 0) ** 2 for p, y in rows) / (2 + 1)
    ll = sum(-(y * math.log(p) + (1 - y) * math.log(1 - p)) for p, y in rows) / 4
    assert M.ranking_logloss(df).first()[0] == pytest.approx(rank + ll)
