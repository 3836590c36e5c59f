"""Exact neighbours, oversampling and stratified splits against brute force."""

import math
from collections import Counter

import numpy as np
import pytest

from logweave.operators import neighbors as N
from logweave.operators.ranks import hash_ranks, stratified_split


def points(spark, ids, x):
    return spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "id bigint, vec array<double>")


def brute(ids, x, k):
    d = np.sqrt(((x[:, None, :] - x[None]) ** 2).sum(2))
    return {int(ids[i]): sorted((float(d[i, j]), int(ids[j])) for j in range(len(x)) if j != i)[:k] for i in range(len(x))}


RNG = np.random.default_rng(1)
CASES = {
    "even": RNG.standard_normal((400, 8)),
    "grid with ties": RNG.integers(0, 4, (300, 2)).astype(float),
    "a third equal": np.concatenate([np.zeros((150, 3)), RNG.standard_normal((300, 3))]),
    "clusters": np.concatenate([RNG.standard_normal((90, 5)) * 0.05 + 10 * c for c in range(5)]),
    "far from zero": 1e6 + RNG.standard_normal((200, 4)),
    "fewer than k": RNG.standard_normal((3, 2)),
    "one": np.ones((1, 2)),
}


@pytest.mark.parametrize("name", CASES)
def test_nearest_equals_brute_force(spark, name):
    x = CASES[name]
    ids = RNG.permutation(len(x))
    got = {int(i): {} for i in ids}
    for r in N.nearest(points(spark, ids, x), 5, block_rows=32).collect():
        got[r.id][r.rank] = (r.distance, r.neighbor)
    want = brute(ids, x, 5)
    for i, best in want.items():
        assert [got[i][k + 1][1] for k in range(len(best))] == [n for _, n in best] and len(got[i]) == len(best)
        assert all(math.isclose(got[i][k + 1][0], d, rel_tol=1e-9, abs_tol=1e-9) for k, (d, _) in enumerate(best))


def test_rings_out_of_reach_are_not_visited(spark):
    x = CASES["clusters"]
    centres = np.array([x[90 * c : 90 * c + 90].mean(0) for c in range(5)])
    nodes = points(spark, range(len(x)), x).selectExpr("id AS node", "vec", "1L AS copies")
    placed = N._cells(nodes, centres).repartitionByRange(2, "cell", "far").sortWithinPartitions("cell", "far")
    blocks = placed.mapInArrow(N._pack(30), N.BLOCK).cache()
    lines = blocks.select("block", "cell", "low", "high").collect()
    directory = tuple(np.array([r[k] for r in lines]) for k in range(4))
    visits = blocks.mapInArrow(N._visits(directory, centres, 6), N.PAIR).select("block", "other").collect()
    cell = {r.block: r.cell for r in lines}
    assert len(lines) >= 15 and all(cell[r.block] == cell[r.other] for r in visits)  # other clusters: never
    blocks.unpersist()


def test_tiles_read_a_block_once(spark, monkeypatch):
    monkeypatch.setattr(N, "TILE_BLOCKS", 3)
    monkeypatch.setattr(N, "TILES", 2)
    x = np.concatenate([CASES["even"][:, :4].astype(np.float32).astype(float), RNG.integers(0, 3, (200, 4))])
    got = {}
    for r in N.nearest(points(spark, range(600), x), 4, block_rows=50).collect():
        got.setdefault(r.id, []).append((r.rank, r.neighbor))
    want = brute(range(600), x, 4)
    assert all([n for _, n in sorted(got[i])] == [n for _, n in want[i]] for i in range(600))
    # Vectors that are floats move as floats, others whole.
    assert [len(N._packed(v)) for v in (x, x + 0.1)] == [1 + 4 * x.size, 1 + 8 * x.size]
    block = N.Best(np.arange(50), np.ones(50, np.int64), x[:50], 5)
    assert not any(list(block.meet(np.arange(400)[k : k + 50], x[k : k + 50])) for k in range(0, 400, 50))
    assert block.count <= block.room and sum(len(b) for b in block.left()) == 250  # not five per visited block


def test_nearest_leaves_null_vectors_out(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, None), (3, [1.0])], "id bigint, vec array<double>")
    assert sorted((r.id, r.neighbor) for r in N.nearest(df, 5).collect()) == [(1, 3), (3, 1)]
    assert N.nearest(df.where("false"), 5).collect() == []


def test_smote(spark):
    x = np.concatenate([RNG.standard_normal((40, 3)), 5 + RNG.standard_normal((170, 3))])
    y = [1] * 40 + [0] * 168 + [None] * 2
    df = spark.createDataFrame([(i, v.tolist(), c) for i, (v, c) in enumerate(zip(x, y))], "id bigint, v array<double>, y int")
    made = N.smote(df, "id", "v", "y", block_rows=16).collect()
    assert len(made) == 130 and len({(r.id, r.sample) for r in made}) == 130
    near = brute(range(40), x[:40], 5)
    per_row = Counter(r.id for r in made)
    assert set(per_row.values()) == {3, 4} and len(per_row) == 40
    for r in made:
        assert r.neighbor in {n for _, n in near[r.id]} and 0 <= r.gap < 1
        assert np.allclose(r.v, x[r.id] + r.gap * (x[r.neighbor] - x[r.id]))
    assert len({r.neighbor for r in made}) > 20 and np.std([r.gap for r in made]) > 0.2
    again = N.smote(df.repartition(5), "id", "v", "y").collect()
    assert {(r.id, r.sample, r.neighbor) for r in again} == {(r.id, r.sample, r.neighbor) for r in made}
    assert N.smote(df, "id", "v", "y", minority=0).collect() == []  # not the smaller class
    assert N.smote(df, "id", "v", "y", minority=7).collect() == []


@pytest.mark.parametrize("rows_per_bucket", [1, 20, 10**6])
def test_hash_ranks(spark, rows_per_bucket):
    rows = [(i, None if i % 3 == 0 else i % 3) for i in range(200)]
    got = hash_ranks(spark.createDataFrame(rows, "k int, s int"), "k", ["s"], 7, rows_per_bucket).collect()
    for s in (None, 1, 2):
        own = [r for r in got if r.s == s]
        assert sorted(r._rank for r in own) == list(range(len(own))) and {r._size for r in own} == {len(own)}
    plain = hash_ranks(spark.createDataFrame(rows, "k int, s int"), "k", (), 7, rows_per_bucket).orderBy("_rank").collect()
    import hashlib

    assert [r.k for r in plain] == sorted(range(200), key=lambda k: hashlib.md5(f"7:{k}".encode()).hexdigest())


def test_stratified_split(spark):
    rows = [(i, "rare" if i < 7 else None if i < 20 else "common") for i in range(200)]
    got = stratified_split(spark.createDataFrame(rows, "k int, y string"), "k", "y", 33, n_splits=2).collect()
    assert len(got) == 400
    for s in (0, 1):
        test = Counter(r.y for r in got if r.split_no == s and r.subset == "test")
        assert sum(test.values()) == 66  # ceil(0.33 * 200)
        assert abs(test["rare"] - 2.31) < 1 and abs(test[None] - 4.29) < 1 and abs(test["common"] - 59.4) < 1
    first, second = ({r.k for r in got if r.split_no == s and r.subset == "test"} for s in (0, 1))
    assert first != second
