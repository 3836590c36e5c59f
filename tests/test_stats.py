import math

import numpy as np
import pandas as pd
import pytest

from logweave.functions.stats import F12, describe


def pandas_stats(vals):
    s = pd.Series(vals, dtype="float64")
    n = s.count()
    mu = s.mean()
    out = {
        "mean": mu,
        "std": s.std(),
        "count": n,
        "nunique": s.nunique(),
        "max": s.max(),
        "min": s.min(),
        "median": s.median(),
        "sum": s.sum(),
        "skew": s.skew(),
        "mad": (s - mu).abs().mean(),
        "percentile_25": np.nanpercentile(s, 25) if n else np.nan,
        "percentile_75": np.nanpercentile(s, 75) if n else np.nan,
        "size": len(s),
    }
    return {k: (0.0 if v is None or (isinstance(v, float) and math.isnan(v)) else float(v)) for k, v in out.items()}


GROUPS = {
    "one": [5.0],
    "two": [1.0, 4.0],
    "three": [1.0, 2.0, 10.0],
    "const": [3.0, 3.0, 3.0, 3.0],
    "null": [1.0, None, 7.0, 7.0, 2.0],
    "allnull": [None, None],
    "many": [0.0, 1.0, 1.0, 2.0, 3.0, 5.0, 8.0, 13.0, 21.0, 34.0],
}


def test_describe_matches_pandas(spark):
    data = [(k, v) for k, vs in GROUPS.items() for v in vs]
    df = spark.createDataFrame(data, "k string, x double")
    stats = list(F12) + ["size"]
    got = {r["k"]: r.asDict() for r in describe(df, ["k"], "x", stats).collect()}
    for k, vs in GROUPS.items():
        exp = pandas_stats(vs)
        for s in stats:
            assert got[k][s] == pytest.approx(exp[s], abs=1e-9), (k, s)


def test_implicit_zeros_equal_materialised(spark):
    base = [("a", 3.0), ("a", 1.0), ("b", 2.0)]
    zeros = [("a", 2), ("b", 4)]
    dense = base + [("a", 0.0)] * 2 + [("b", 0.0)] * 4
    stats = ["mean", "std", "skew", "mad", "median", "percentile_25", "percentile_75", "min", "max", "std_pop", "ptp"]
    d1 = describe(
        spark.createDataFrame(base, "k string, x double"),
        ["k"], "x", stats,
        zeros=spark.createDataFrame(zeros, "k string, zeros long"),
    )
    d2 = describe(spark.createDataFrame(dense, "k string, x double"), ["k"], "x", stats)
    a = {r["k"]: r.asDict() for r in d1.collect()}
    b = {r["k"]: r.asDict() for r in d2.collect()}
    for k in a:
        for s in stats:
            assert a[k][s] == pytest.approx(b[k][s], abs=1e-12)


def test_null_poison_percentile(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0)], "k string, x double")
    r = describe(df, ["k"], "x", ["percentile_25", "median"], null_poison=True).first()
    assert r["percentile_25"] == 0.0  # numpy percentile with NaN -> NaN -> 0
    assert r["median"] == 2.0  # pandas median skips NaN
