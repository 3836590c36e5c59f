import numpy as np
import pandas as pd
import pytest

from logweave.functions.stats import F5, F9
from logweave.operators import counts as C


def brute_dense(pdf, dim):
    """Reference rule: per batch pivot files x values seen in the batch, 0 fill;
    stack batches (NaN across batches); stats per (file, value) skipping NaN."""
    parts = []
    for b, g in pdf.groupby("batch_id"):
        pv = g.groupby(["FileID", dim]).size().unstack(fill_value=0)
        parts.append(pv)
    allv = pd.concat(parts, axis=0)
    out = {}
    for f, g in allv.groupby(level=0):
        for v in allv.columns:
            s = g[v].dropna().astype(float)
            if len(s) == 0 or s.sum() == 0:
                continue
            mu = s.mean()
            out[(f, v)] = {
                "mean": mu,
                "std": 0.0 if len(s) < 2 else s.std(),
                "max": s.max(),
                "min": s.min(),
                "median": s.median(),
                "skew": 0.0 if len(s) < 3 else (0.0 if np.isnan(s.skew()) else s.skew()),
                "mad": (s - mu).abs().mean(),
                "percentile_25": np.percentile(s, 25),
                "percentile_75": np.percentile(s, 75),
                "sum": s.sum(),
            }
    return out


BLOG = [
    # batch 0: hours 1 and 2 present; f2 lacks hour 2 -> 0
    (0, "f1", 1), (0, "f1", 1), (0, "f1", 2), (0, "f2", 1),
    # batch 1: only hour 1 present -> hour 2 is NULL for the batch
    (1, "f1", 1), (1, "f2", 1), (1, "f2", 1),
    # batch 2: f1 absent entirely; hour 2 present
    (2, "f2", 2), (2, "f3", 1),
]


def test_dense_stats_match_bruteforce(spark):
    df = spark.createDataFrame(BLOG, "batch_id int, FileID string, hour int")
    facts = C.dim_facts(df, "dim", df["hour"].cast("string"))
    got = {(r.FileID, r.dim): r.asDict() for r in C.dense_dim_stats(facts, "dim", list(F9) + ["sum"]).collect()}
    pdf = pd.DataFrame(BLOG, columns=["batch_id", "FileID", "hour"]).assign(dim=lambda d: d.hour.astype(str))
    exp = brute_dense(pdf, "dim")
    assert set(got) == set(exp)
    for k, e in exp.items():
        for s, v in e.items():
            assert got[k][s] == pytest.approx(v, abs=1e-12), (k, s)


def test_dense_table_cells(spark):
    df = spark.createDataFrame(BLOG, "batch_id int, FileID string, hour int")
    facts = C.dim_facts(df, "dim", df["hour"].cast("string"))
    cells = {(r.batch_id, r.FileID, r.dim): r.Count for r in C.dense_dim_table(facts, "dim").collect()}
    assert cells[(0, "f2", "2")] == 0
    assert (1, "f1", "2") not in cells  # hour 2 absent from batch 1: NULL, no cell
    assert cells[(1, "f2", "1")] == 2


def test_wide_product_features(spark):
    df = spark.createDataFrame(
        [(0, "f1", "p"), (0, "f1", "q"), (1, "f1", "p"), (1, "f2", "q")],
        "batch_id int, FileID string, ProductID string",
    )
    assert C.product_daily_stats(df).count() == 3 and C.product_daily_features(df, ["p"]).columns[1] == "p_sum"
    wide = C.product_daily_features(df, ["p", "q"])
    assert wide.columns[:3] == ["FileID", "p_sum", "p_mean"]
    r = {x.FileID: x for x in wide.collect()}
    # f2 has p only as a 0 cell in batch 1 -> all zero stats; q once in batch 1
    assert r["f2"]["p_sum"] == 0.0 and r["f2"]["q_sum"] == 1.0
    assert set(F5) <= {c.split("_", 1)[1] for c in wide.columns if c != "FileID"}


def test_row_normalize_zero_sum(spark):
    df = spark.createDataFrame([(1, 1.0, 3.0), (2, 0.0, 0.0)], "k int, a_sum double, b_sum double")
    out = {r.k: r for r in C.norm_percentage(df).collect()}
    assert out[1]["a_percentage"] == 0.25 and out[1]["b_percentage"] == 0.75
    assert out[2]["a_percentage"] is None


def test_batches_from_listed_days(spark, tmp_path):
    from logweave.operators.batches import assign_batches
    from logweave.sources.log import listed_days, read_query_log

    for day, rows in {"0301": ["fa,c1,100,p1", "fb,c2,200,055649"], "0302": ["fa,c1,90000,p1"], "0305": ["fb,c3,400000,p2"]}.items():
        (tmp_path / f"{day}.csv").write_text("\n".join(rows) + "\n")
    (tmp_path / "0306.csv").write_text("")  # empty day file
    days = listed_days(spark, str(tmp_path))
    assert days == ["0301", "0302", "0305", "0306"]
    log = read_query_log(spark, str(tmp_path))
    got = sorted((r.day, r.batch_id) for r in assign_batches(log, 2, days=days).select("day", "batch_id").distinct().collect())
    assert got == [("0301", 0), ("0302", 0), ("0305", 1)]
    assert sorted(r.ProductID for r in log.collect()) == ["55649", "p1", "p1", "p2"]
    derived = sorted((r.day, r.batch_id) for r in assign_batches(log, 2).select("day", "batch_id").distinct().collect())
    assert derived == [("0301", 0), ("0302", 0), ("0305", 1)]


def test_rows_without_a_day_stay(spark):
    from logweave.operators.batches import assign_batches

    rows = [("f", 86400 * 3 + 5), ("f", 86400 * 9), ("g", None)]
    log = spark.createDataFrame(rows, "FileID string, QueryTs long")
    assert sorted((r.FileID, r.batch_id) for r in assign_batches(log, 1).collect() if r.batch_id is not None) == [("f", 0), ("f", 1)]
    assert assign_batches(log, 1).where("batch_id is null").count() == 1


def test_a_row_that_does_not_parse_fails(spark, tmp_path):
    from logweave.sources.log import read_query_log

    (tmp_path / "0101.csv").write_text("f,c,12,p\nf,c,noon,p\n")
    with pytest.raises(Exception):
        read_query_log(spark, str(tmp_path)).collect()
    assert read_query_log(spark, str(tmp_path), mode="DROPMALFORMED").select("FileID", "QueryTs").collect() == [("f", 12)]
