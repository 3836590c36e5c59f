import pandas as pd

from logweave.operators.intervals import interval_features, open_intervals
from tests.conftest import rows


def brute(events, keys):
    pdf = pd.DataFrame(events, columns=["FileID", "CustomerID", "QueryTs", "ProductID"])
    pdf = pdf.sort_values("QueryTs", kind="stable")
    pdf["d"] = pdf.groupby(keys)["QueryTs"].diff()
    pdf = pdf.dropna()
    return sorted((*(r[k] for k in keys), int(r["QueryTs"]), int(r["d"])) for _, r in pdf.iterrows())


EVENTS = [
    ("f1", "c1", 100, "p1"),
    ("f1", "c2", 100, "p1"),  # same second -> interval 0
    ("f1", "c1", 3599, "p2"),
    ("f1", "c1", 3600, "p2"),  # crosses a chunk border
    ("f1", "c1", 7300, "p1"),
    ("f1", "c2", 90000, "p2"),
    ("f2", "c1", 50, "p1"),  # single event: no interval
    ("f3", "c3", 10, "p3"),
    ("f3", "c3", 10, "p3"),
]


def test_chunked_lag_equals_plain_lag(spark):
    df = spark.createDataFrame(EVENTS, "FileID string, CustomerID string, QueryTs long, ProductID string")
    for chunk in (1, 60, 3600, 10**9):
        got = rows(open_intervals(df, "", chunk_seconds=chunk), "FileID", "QueryTs", "QueryTsInterval")
        # multiset of intervals per key is what the features use
        per = {}
        for f, _, iv in got:
            per.setdefault(f, []).append(iv)
        exp = {}
        for f, _, iv in brute(EVENTS, ["FileID"]):
            exp.setdefault(f, []).append(iv)
        assert {k: sorted(v) for k, v in per.items()} == {k: sorted(v) for k, v in exp.items()}


def test_pair_intervals(spark):
    df = spark.createDataFrame(EVENTS, "FileID string, CustomerID string, QueryTs long, ProductID string")
    got = rows(open_intervals(df, "ProductCustomerID", chunk_seconds=60), "FileID", "ProductID", "CustomerID",
               "QueryTsIntervalProductCustomerID")
    exp = brute(EVENTS, ["FileID", "ProductID", "CustomerID"])
    assert sorted(g[3] for g in got) == sorted(e[4] for e in exp)


def test_interval_feature_names(spark):
    df = spark.createDataFrame(EVENTS, "FileID string, CustomerID string, QueryTs long, ProductID string")
    cols = interval_features(df, "CustomerID").columns
    assert "QueryTsIntervalPercentile_25CustomerID" in cols
    assert "QueryTsIntervalNuniqueCustomerID" in cols
