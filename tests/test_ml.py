import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from logweave.operators import cluster as CL


def test_kmedoids_hand_matrix(spark):
    pts = {0: 0.0, 1: 1.0, 2: 2.0, 3: 10.0, 4: 11.0, 5: 30.0}
    rows = [(i, j, abs(a - b)) for i, a in pts.items() for j, b in pts.items()]
    dist = spark.createDataFrame(rows, "i int, j int, d double")
    assign, sil = CL.kmedoids(dist, [0, 3, 5])
    got = {r.point: r.medoid for r in assign.collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 3, 4: 3, 5: 5}  # medoid 0 moves to 1
    s = {r.medoid: r.silhouette for r in sil.collect()}
    assert s[5] is not None and s[1] > 0.8


def test_rf_proximity_matches_pair_loop(spark):
    rnd = random.Random(1)
    data = [(i, rnd.randint(0, 2), [rnd.random(), rnd.random()]) for i in range(40)]
    df = spark.createDataFrame(data, "id int, lab int, x array<double>")
    df = CL.as_vector(df, "x").withColumn("t", F.col("x")[0] + F.col("lab").cast("double"))
    prox = {(r.a, r.b): r.distance for r in CL.rf_proximity(df, "lab", "t", trees=5).collect()}
    # brute force of the reference loop over the same leaves
    from pyspark.ml.regression import RandomForestRegressor

    m = RandomForestRegressor(featuresCol="features", labelCol="t", numTrees=5, seed=42, leafCol="leaf").fit(df)
    leaves = [(r.lab, np.array(r.leaf)) for r in m.transform(df).select("lab", vector_to_array("leaf").alias("leaf")).collect()]
    num = {}
    for i, (li, vi) in enumerate(leaves):
        for j, (lj, vj) in enumerate(leaves):
            if i >= j:
                num[(li, lj)] = num.get((li, lj), 0) + int(np.count_nonzero(vi == vj))
                num[(lj, li)] = num[(li, lj)]
    n = {lab: sum(1 for l, _ in leaves if l == lab) for lab in {l for l, _ in leaves}}
    for (a, b), v in num.items():
        assert prox[(a, b)] == pytest.approx(1 - v / (5 * n[a] * n[b]))


def test_pca_variance_sums_and_gmm_aic(spark):
    rnd = np.random.default_rng(0)
    centers = [(-5, 0), (5, 0), (0, 6)]
    pts = [(i, [float(c[0] + rnd.normal()), float(c[1] + rnd.normal())]) for i in range(300) for c in [centers[i % 3]]]
    df = CL.as_vector(spark.createDataFrame(pts, "id int, x array<double>"), "x")
    sc = CL.standardize_vector(df)
    spec = CL.pca_spectrum(sc, 2).collect()
    assert sum(r.ratio for r in spec) == pytest.approx(1.0)
    table, best = CL.gmm_select(df, [2, 3], seed=3)
    aic = {r.k: r.aic for r in table.collect()}
    assert aic[3] < aic[2] and best.getK() == 3


def test_labels_without_a_common_leaf_are_far(spark):
    leaves = [("a", 0, 1), ("a", 1, 1), ("a", 0, 1), ("a", 1, 2), ("b", 0, 5), ("b", 1, 5), ("c", 0, 1), ("c", 1, 9)]
    df = spark.createDataFrame(leaves, "lab string, tree int, leaf int")
    got = {(r.a, r.b): r.distance for r in CL.leaf_distances(df, 2).collect()}
    assert len(got) == 9 and got[("a", "b")] == got[("b", "a")] == got[("b", "c")] == 1.0
    assert got[("a", "c")] == pytest.approx(1 - 2 / (2 * 2 * 1)) and got[("b", "b")] == 0.0


def test_leaf_pairs_of_many_labels(spark):
    leaves = [(f"l{i}", t, i // 2 if t else -i) for i in range(2100) for t in (0, 1)]
    df = spark.createDataFrame(leaves, "lab string, tree int, leaf int")
    with pytest.raises(ValueError):
        CL.leaf_distances(df, 2)
    got = {(r.a, r.b): r.distance for r in CL.leaf_pairs(df, 2).collect()}
    assert got == {(f"l{i}", f"l{j}"): 0.0 if i == j else 0.5 for i in range(2100) for j in (i, i ^ 1)}
    some = {(r.a, r.b): r.distance for r in CL.leaf_distances(df, 2, ["l0", "l1", "l9"]).collect()}
    assert len(some) == 9 and some[("l0", "l1")] == 0.5 and some[("l0", "l9")] == 1.0


def test_leaf_pairs_of_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(CL, "TILE_LABELS", 8)
    rng = np.random.default_rng(4)
    rows = [(f"l{rng.integers(50)}", tree, int(rng.integers(2 if tree % 2 else 40))) for _ in range(300) for tree in range(4)]
    rows += [("l1", 0, None), (None, 0, 1)]
    leaves = spark.createDataFrame(rows, "lab string, tree int, leaf int")
    out = CL.leaf_pairs(leaves, 4)
    # Pairs of labels aren't summed over the shuffle, which held one row per pair and leaf.
    assert "keys=[a#" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r.a, r.b): r.distance for r in out.collect()}
    count = {}
    for lab, tree, leaf in rows:
        if lab is not None:
            count.setdefault(lab, {}).setdefault((tree, leaf), 0)
            count[lab][tree, leaf] += 1
    size, want = {lab: sum(c.values()) // 4 for lab, c in count.items()}, {}
    for a in count:
        for b in count:
            s = sum(k * count[b].get(leaf, 0) for leaf, k in count[a].items() if leaf[1] is not None)
            if s:
                want[a, b] = 1 - ((s + 4 * size[a]) / 2 if a == b else s) / (4 * size[a] * size[b])
    assert len(got) == len(out.collect()) and got == want
