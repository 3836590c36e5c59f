"""Reducers, mixed-type features, mixtures, repaired dumps, bucketed tables, sketches."""

import math
import os
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from logweave.operators import assemble as A
from logweave.operators import counts as C
from logweave.operators import mixed as X
from logweave.operators import mixtures as G
from logweave.operators import reduce as R
from logweave.operators.batches import assign_batches
from logweave.sources import sinks as SK

RNG = np.random.default_rng(4)


def vectors(spark, x):
    return spark.createDataFrame([(i, None if v is None else [float(a) for a in v]) for i, v in enumerate(x)], "id int, v array<double>")


# reducers


@pytest.mark.parametrize("reducer, centred", [(R.PCA(3), True), (R.TruncatedSVD(3), False)])
def test_projection_keeps_products_up_to_the_discarded_variance(spark, reducer, centred):
    x = RNG.standard_normal((300, 8)) * np.array([5, 4, 3, 0.1, 0.1, 0.1, 0.05, 0.05]) + 2
    fit = reducer.fit(vectors(spark, x), "v")
    base = x - x.mean(0) if centred else x
    want = np.linalg.svd(base, full_matrices=False)
    scale = 299 if centred else 1
    assert np.allclose(fit.variance * scale, want[1][:3] ** 2) and math.isclose(fit.total * scale, (base**2).sum(), rel_tol=1e-9)
    assert np.allclose(np.abs(fit.components.T @ want[2][:3].T), np.eye(3), atol=1e-8)
    assert all(c[np.abs(c).argmax()] > 0 for c in fit.components.T)
    got = fit.transform(vectors(spark, [*x[:50], None]), "v").orderBy("id").collect()
    assert got[-1].reduced is None
    p = np.array([r.reduced for r in got[:-1]])
    lost = np.sqrt((want[1][3:] ** 2).sum())
    assert np.abs(p @ p.T - base[:50] @ base[:50].T).max() <= lost**2 + 1e-9


def test_dim_reduc_takes_any_reducer(spark):
    class FirstTwo:
        def fit(self, df, vec="features"):
            return R.Projection(np.zeros(3), np.eye(3)[:, :2], np.zeros(2), 0.0)

    got = R.dim_reduc(vectors(spark, [[1, 2, 3]]), FirstTwo(), "v").first()
    assert got.reduced == [1.0, 2.0]
    with pytest.raises(ValueError):
        R.PCA(1).fit(vectors(spark, [None]), "v")


# mixed types

RAW = [
    (0, "x", "1", 1.5, None, "a"), (1, "y", "2.5", None, "q", "b"), (2, None, " 3 ", 2.0, "q", "a"), (3, "z", None, 0.0, None, "b"),
    (4, "x", "1e3", 4.0, "r", "a"), (5, "x", "-7", 1.0, "s", "c"), (6, "y", "0", 2.0, "s", "c"), (7, "", "4", 3.0, "q", "a"),
]
RAW_DDL = "id int, word string, number string, price double, flag string, lab string"


def test_type_probe(spark):
    df = spark.createDataFrame([(*r, None) for r in RAW], RAW_DDL + ", `all.null` string")
    cols = ["word", "number", "price", "flag", "all.null"]
    want = {"word": ("levels", True), "number": ("number", True), "price": ("number", True), "flag": ("levels", True), "all.null": ("number", True)}
    assert X.type_probe(df, cols) == want
    assert X.type_probe(df.limit(0), ["word"]) == {"word": ("number", False)}


def test_mixed_features_equal_dummies(spark):
    import pandas as pd

    df = spark.createDataFrame(RAW, RAW_DDL)
    got, names = X.mixed_features(df, ["word", "number", "price", "flag"])
    raw = pd.DataFrame(RAW, columns=[c.split()[0] for c in RAW_DDL.split(", ")])
    want = {}
    for c in ("word", "flag"):
        levels = sorted(v for v in raw[c].unique() if v is not None)
        want |= {f"{c}_{v}": (raw[c] == v).astype(float) for v in levels[1:]} | {f"{c}_null": raw[c].isnull().astype(float)}
    for c in ("number", "price"):
        want |= {c: pd.to_numeric(raw[c]).fillna(0), f"{c}_null": raw[c].isnull().astype(float)}
    assert sorted(names) == sorted(want)
    for r in got.withColumn("f", vector_to_array("features")).collect():
        assert dict(zip(names, r.f)) == {k: float(v[r.id]) for k, v in want.items()}


def test_proximity_from_a_raw_table_equals_the_pair_loop(spark):
    rows = [(i, r[1], r[2], float(i % 5), r[4], r[5]) for i, r in enumerate(RAW * 6)]
    df = spark.createDataFrame(rows, RAW_DDL).coalesce(1)
    cols = ["word", "number", "flag"]
    got = {(r.a, r.b): r.distance for r in X.proximity(df, "lab", "price", cols, trees=4).collect()}
    features, _ = X.mixed_features(df.withColumn("__target", F.col("price")), cols, "__features")
    forest = RandomForestRegressor(featuresCol="__features", labelCol="__target", numTrees=4, seed=42, leafCol="leaf").fit(features)
    leaves = [(r.lab, r.leaf.toArray()) for r in forest.transform(features).collect()]
    shared, size = defaultdict(int), Counter(lab for lab, _ in leaves)
    for i, (a, x) in enumerate(leaves):
        for b, y in leaves[: i + 1]:
            shared[a, b] += int((x == y).sum())
            if a != b:
                shared[b, a] += int((x == y).sum())
    assert set(got) == {(a, b) for a in size for b in size}
    for (a, b), d in got.items():
        assert math.isclose(d, 1 - shared[a, b] / (4 * size[a] * size[b]), abs_tol=1e-9)


# mixtures


def planted(kind, n=400):
    means = np.array([[0.0, 0.0], [12.0, 0.0], [0.0, 14.0]])
    tilt = np.array([[2.0, 1.2], [1.2, 1.0]])
    shapes = {
        "spherical": [np.eye(2) * s for s in (0.3, 1.0, 3.0)], "diag": [np.diag(s) for s in ([0.2, 3.0], [3.0, 0.2], [0.5, 4.0])],
        "tied": [tilt] * 3, "full": [tilt, np.eye(2), np.array([[1.0, -0.8], [-0.8, 1.5]])],
    }[kind]
    return means, np.concatenate([RNG.multivariate_normal(m, c, n) for m, c in zip(means, shapes)])


@pytest.mark.parametrize("kind", G.KINDS)
def test_mixture_finds_what_was_planted(spark, kind):
    means, x = planted(kind)
    df = vectors(spark, [*x, None]).cache()
    table, best = G.select_mixture(df, [3], features="v")
    assert best.kind == kind and table.count() == 4 and best.n == len(x)
    assert all(b >= a - 1e-6 * abs(a) for a, b in zip(best.likelihoods, best.likelihoods[1:]))
    order = [int(np.abs(best.means - m).sum(1).argmin()) for m in means]
    assert sorted(order) == [0, 1, 2] and np.abs(best.means[order] - means).max() < 0.4
    got = G.assign(df, best, "v").orderBy("id").collect()
    right = np.mean([order.index(r.prediction) == r.id // 400 for r in got[:-1]])
    assert right > 0.98 and got[-1].probability is None and math.isclose(sum(got[0].probability), 1)
    df.unpersist()


def test_mixture_of_one_is_the_normal_fit(spark):
    x = RNG.standard_normal((200, 2)) * [1, 3] + [5, 6]
    m = G.fit_mixture(vectors(spark, x), 1, "full", "v")
    assert np.allclose(m.means[0], x.mean(0)) and np.allclose(m.covariances[0], np.cov(x.T, bias=True) + 1e-6 * np.eye(2))
    assert m.parameters == 5 and G.fit_mixture(vectors(spark, x), 2, "spherical", "v").parameters == 7


# repaired dumps


def files(path):
    out = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.startswith("part-"):
                with open(os.path.join(folder, name), "rb") as f:
                    out[os.path.relpath(os.path.join(folder, name), path)] = f.read()
    return out


def test_repair_rewrites_only_the_buckets_of_bad_files(spark, tmp_path):
    ddl = "FileID string, QueryTs long, n long, split string"
    whole = [(f"f{i}", t, i + t, "train" if i % 3 else "test") for i in range(60) for t in range(5)]
    broken = [(f, t, 0 if f in ("f7", "f8") else n, s) for f, t, n, s in whole if f != "f9"]  # f9 is missing altogether
    path = str(tmp_path / "dump")
    SK.write_bucketed_series(spark.createDataFrame(broken, ddl), path, 32)
    before = files(path)
    bad = spark.createDataFrame([("f7",), ("f8",), ("f9",), ("f7",)], "FileID string")
    SK.repair_series(path, spark.createDataFrame(whole, ddl), bad, 32)
    after = files(path)
    assert Counter(tuple(r) for r in spark.read.parquet(path).select("FileID", "QueryTs", "n", "split").collect()) == Counter(whole)
    folders = lambda names: {os.path.dirname(n) for n in names}
    changed = folders(n for n in before.keys() | after.keys() if before.get(n) != after.get(n))
    assert 1 <= len(changed) <= 3 and len(folders(after)) > 20
    SK.repair_series(path, spark.createDataFrame(whole, ddl), bad.limit(0), 32)
    assert files(path) == after


def test_repair_of_a_file_that_the_source_lost(spark, tmp_path):
    ddl = "FileID string, QueryTs long, n long, split string"
    path = str(tmp_path / "dump")
    SK.write_bucketed_series(spark.createDataFrame([("a", 1, 1, "train"), ("b", 1, 2, "test")], ddl), path, 32)
    SK.repair_series(path, spark.createDataFrame([("b", 1, 2, "test")], ddl), spark.createDataFrame([("a",)], "FileID string"), 32)
    assert [tuple(r) for r in spark.read.parquet(path).select("FileID", "n").collect()] == [("b", 2)]


# bucketed feature tables


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    one = spark.createDataFrame([(f"f{i}", i) for i in range(50)], "FileID string, a int")
    two = spark.createDataFrame([(f"f{i}", i * 2) for i in range(25, 80)], "FileID string, b int")
    three = spark.createDataFrame([(f"f{i}", None) for i in range(3)], "FileID string, c int")
    try:
        SK.write_co_bucketed({"t_one": one, "t_two": two, "t_three": three}, "t_keys", str(tmp_path), buckets=8)
        got = A.assemble_bucketed(spark, "t_keys", ["t_one", "t_two", "t_three"])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        want = A.assemble([one, two, three])
        assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    finally:
        for t in ("t_one", "t_two", "t_three", "t_keys"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


# sketches


def test_daily_sketches_merge_into_batches(spark):
    rows = spark.range(60_000).selectExpr("concat('f', id % 2) AS FileID", "concat('c', id * 7 % 20011) AS CustomerID", "concat('p', id % 3) AS ProductID", "id % 10 AS day", "0L AS QueryTs")
    for field in ("uniqCustomer", "uniqProduct", "uniqProductCustomer"):
        facts = C.sketch_facts(rows, field).cache()
        for n in (3, 7):
            guess = {(r.batch_id, r.FileID): r[field] for r in C.uniq_from_sketches(facts, n, field).collect()}
            exact = {(r.batch_id, r.FileID): r[field] for r in C.uniq_facts(assign_batches(rows, n), field).collect()}
            assert guess.keys() == exact.keys() and max(abs(guess[k] / exact[k] - 1) for k in exact) < 0.03
        facts.unpersist()
    nulls = spark.createDataFrame([("f", None, "p", 1), ("f", "c", "p", 1)], "FileID string, CustomerID string, ProductID string, day int")
    assert C.sketch_facts(nulls, "uniqProductCustomer").select(F.hll_sketch_estimate("sketch")).first()[0] == 1  # as a distinct count
