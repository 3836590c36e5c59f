"""Correlations from one pass, quantiles with hot ties, deep counts."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from logweave.functions.quantiles import group_quantile
from logweave.functions.stats import describe
from logweave.operators import counts as C
from logweave.operators import select as SEL
from logweave.operators.batches import assign_batches

RNG = np.random.default_rng(3)


@pytest.mark.parametrize("block", [7, 128])
def test_correlations_equal_pandas(spark, monkeypatch, block):
    monkeypatch.setattr(SEL, "BLOCK_COLUMNS", block)
    x = RNG.standard_normal((200, 20))
    x[:, 1] = 3 * x[:, 0] + 0.01 * x[:, 1]
    x[:, 2] += 1e6  # a large offset
    x[:, 3] = 7.25  # constant
    x[RNG.random(x.shape) < 0.1] = np.nan
    x[:150, 4], x[150:, 5] = np.nan, np.nan  # never known together
    frame = pd.DataFrame(x, columns=[f"c.{i}" if i == 6 else f"c{i}" for i in range(20)])
    df = spark.createDataFrame([[None if np.isnan(v) else float(v) for v in r] for r in x], list(frame.columns))
    got = {(r.col_i, r.col_j): r["corr"] for r in SEL.correlation_pairs(df.repartition(3), list(frame.columns)).collect()}
    want = frame.corr()
    assert len(got) == 190
    for (a, b), v in got.items():
        if "c3" in (a, b) or {a, b} == {"c4", "c5"}:
            assert v is None
        else:
            assert abs(v - want.loc[a, b]) < 1e-8
    assert SEL.correlation_pairs(df, ["c0"]).collect() == []


def test_a_third_tied_at_the_median(spark):
    rows = [("hot", v) for v in [0.0] * 1000 + (RNG.random(1000) + 1).tolist() + (-RNG.random(1000) - 1).tolist()]
    rows += [("small", v) for v in (3.0, 1.0, 2.0)] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    for q in (0.1, 0.5, 0.66, 0.9):
        got = {r.g: r.quantile for r in group_quantile(df, ["g"], "x", q, accuracy=200).collect()}
        for g in ("hot", "small"):
            assert abs(got[g] - np.quantile([v for k, v in rows if k == g], q)) < 1e-12
    # What is ranked is one row per distinct value of the band, not the tied rows.
    plan = group_quantile(df, ["g"], "x", 0.5, accuracy=200)._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window [") :]
    assert "Aggregate [g" in window and "_x" in window.split("Aggregate [g")[1][:40]


def test_quantiles_of_continuous_facts_equal_those_of_percentile(spark):
    stats = ["median", "percentile_25", "percentile_75", "mean", "std", "nunique"]
    values = RNG.integers(0, 40, 600)
    rows = [(f"k{i % 3}", int(v), float(v)) for i, v in enumerate(values)] + [("k0", None, None), ("k9", None, None)]
    df = spark.createDataFrame(rows, "k string, i long, x double")
    zeros = spark.createDataFrame([("k0", 17), ("k1", 0)], "k string, zeros long")
    for z in (None, zeros):
        a = describe(df, ["k"], "i", stats, zeros=z).orderBy("k").collect()
        b = describe(df, ["k"], "x", stats, zeros=z).orderBy("k").collect()
        assert len(a) == len(b) and all(abs(p - q) < 1e-9 for r, s in zip(a, b) for p, q in zip(r[1:], s[1:]))


def test_deep_counts_are_sums_over_batches(spark):
    log = spark.range(500).selectExpr("concat('f', id % 3) AS FileID", "concat('c', id % 7) AS CustomerID", "concat('p', id % 2) AS ProductID", "id % 9 * 86400 AS QueryTs")
    for field in C.COUNT_FIELDS:
        by_batch = C.fact_features(C.count_facts(assign_batches(log, 2), field), field, deep=True)
        at_once = C.fact_features(C.deep_counts(log, field), field)
        assert sorted(map(tuple, by_batch.collect())) == sorted(map(tuple, at_once.collect()))
    plan = C.deep_counts(log, "countProduct").groupBy("FileID").agg(F.count("*"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "batch_id" not in plan
