import pytest

from logweave.operators import prep as P
from logweave.operators import select as SEL


def test_label_encode_nan_level(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "z"), (4, "a")], "i int, c string")
    got = {r.i: r.c for r in P.label_encode(df, ["c"]).collect()}
    # levels sorted: a, b, nan, z
    assert got == {1: 1, 2: None, 3: 3, 4: 0}


def test_one_hot_drop_first_unless_null(spark):
    df = spark.createDataFrame([(1, "x", "u"), (2, "y", None), (3, "y", "v")], "i int, a string, b string")
    out = P.one_hot(df, ["a", "b"])
    assert [c for c in out.columns if c != "i"] == ["a_y", "b_u", "b_v"]
    r = {x.i: x for x in out.collect()}
    assert (r[2].b_u, r[2].b_v) == (0, 0)


def test_one_hot_long_any_number_of_levels(spark):
    data = [(i, f"v{i % 1500:04d}", "u" if i % 3 else None, i % 7) for i in range(3000)]
    df = spark.createDataFrame(data, "i int, a string, b string, c int")
    with pytest.raises(ValueError):
        P.one_hot(df, ["a"])
    got = sorted(tuple(r) for r in P.one_hot_long(df, ["i"], ["a", "b", "c"]).collect())
    want = [(i, "a", a) for i, a, _, _ in data if a != "v0000"]
    want += [(i, "b", b) for i, _, b, _ in data if b] + [(i, "c", str(c)) for i, _, _, c in data if c]
    assert got == sorted(want)
    wide = P.one_hot(df, ["a"], levels={"a": ["v0000", "v1499"]})
    assert wide.columns == ["i", "b", "c", "a_v0000", "a_v1499"] and wide.agg({"a_v1499": "sum"}).first()[0] == 2


def test_single_level_column(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x")], "i int, a string")
    assert P.one_hot(df, ["a"]).columns == ["i"]


def test_impute_by_group_sizes_and_ties(spark):
    data = [("g4", v) for v in (1.0, 1.0, 9.0, None)] + [("g5", v) for v in (2.0, 4.0, 6.0, 8.0, None)] + [
        ("gn", None)
    ] * 6
    df = spark.createDataFrame(data, "g string, x double")
    glob_median = 4.0  # of 1,1,9,2,4,6,8
    out = P.impute_by_group(df, "g", {"x": "median"})
    got = sorted((r.g, r.x) for r in out.collect())
    assert ("g4", glob_median) in got  # group of 4 -> global
    assert ("g5", 5.0) in got  # group of 5 -> its own median
    assert all(x == glob_median for g, x in got if g == "gn")  # only NULLs -> global
    mode = P.impute_simple(spark.createDataFrame([(1,), (2,), (2,), (1,), (None,)], "x int"), {"x": "most_frequent"})
    assert sorted(r.x for r in mode.collect()) == [1, 1, 1, 2, 2]  # tie -> lowest


def test_constant_and_null_columns(spark):
    df = spark.createDataFrame([(1, 5, None, 1), (2, 5, None, None)], "a int, b int, c int, d int")
    assert P.constant_columns(df) == ["b", "c"]
    assert P.null_columns(df) == (["a", "b"], ["c", "d"])


def test_correlation_rules(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0, 3.0, None, 1.0), (2.0, 2.0, 3.0, 1.0, None), (3.0, 3.0, 3.0, 2.0, 5.0), (4.0, 4.0, 3.0, 4.0, 7.0)],
        "a double, b double, k double, p double, q double",
    )
    pairs = {(r.col_i, r.col_j): r.corr for r in SEL.correlation_pairs(df, ["a", "b", "k", "p", "q"]).collect()}
    assert pairs[("b", "a")] == pytest.approx(1.0)
    assert pairs[("k", "a")] is None  # constant column -> NULL
    assert pairs[("q", "p")] == pytest.approx(1.0)  # pairwise complete: rows 3,4 only
    drop = {r.column for r in SEL.low_corr_drop(SEL.correlation_pairs(df, ["a", "b", "k"]), 0.95).collect()}
    assert drop == {"b"}
    rows = [(a, b, v) for (a, b), v in pairs.items()]
    assert SEL.correlation_groups(rows, ["a", "b", "k"], 0.95) == ["a"]


def test_standardize_population(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, c double")
    got = [tuple(r) for r in SEL.standardize(df, ["x", "c"]).collect()]
    s = (2 / 3) ** 0.5
    assert [g[0] for g in got] == pytest.approx([-1 / s, 0.0, 1 / s])
    assert [g[1] for g in got] == [0.0, 0.0, 0.0]


def test_clean_log_and_union(spark):
    from logweave.sources.log import clean_log, union_train_test

    df = spark.createDataFrame([("f1", "c1", 1, "055649"), ("f2", "c2", 2, "7")],
                               "FileID string, CustomerID string, QueryTs long, ProductID string")
    assert sorted(r.ProductID for r in clean_log(df).collect()) == ["55649", "7"]
    tr = spark.createDataFrame([(1, 5.0)], "id int, target double")
    te = spark.createDataFrame([(2,)], "id int")
    got = sorted(tuple(r) for r in union_train_test(tr, te).collect())
    assert got == [(1, 5.0, "train"), (2, None, "test")]


def test_bounded_group_quantile_and_mode(spark):
    import random

    import numpy as np

    from logweave.functions.quantiles import group_mode, group_quantile

    rnd = random.Random(5)
    rows = [("hot", rnd.gauss(0, 1)) for _ in range(3000)] + [("hot", 0.25)] * 40
    rows += [("small", float(v)) for v in (3, 1, 2, 2)] + [("one", 7.0), ("nulls", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    for q in (0.0, 0.25, 0.5, 0.9, 1.0):
        got = {r.g: r.quantile for r in group_quantile(df, ["g"], "x", q, accuracy=200).collect()}
        for g in ("hot", "small", "one"):
            vals = [v for k, v in rows if k == g and v is not None]
            assert got[g] == pytest.approx(float(np.percentile(vals, q * 100)), abs=1e-12), (g, q)
        assert got.get("nulls") is None
    glob = group_quantile(df, [], "x", 0.5, accuracy=200).first().quantile
    assert glob == pytest.approx(float(np.median([v for _, v in rows if v is not None])))
    modes = {r.g: r.mode for r in group_mode(df, ["g"], "x").collect()}
    assert modes["hot"] == 0.25 and modes["small"] == 2.0
    s = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", "y"), ("a", "x"), ("b", "z")], "g string, v string")
    assert {r.g: r.mode for r in group_mode(s, ["g"], "v").collect()} == {"a": "x", "b": "z"}


def test_impute_by_cluster_fills_everything(spark):
    import random

    rnd = random.Random(2)
    rows = []
    for i in range(120):
        c = i % 3
        size = None if i % 7 == 0 else float(10 * c + rnd.randint(0, 2))
        brand = None if i % 11 == 0 else f"b{c}"
        rows.append((i, float(100 * c + rnd.random()), size, brand))
    df = spark.createDataFrame(rows, "k int, price double, size double, brand string")
    out = P.impute_by_cluster(df, {"size": "median"}, k=3, keep_groups=True)
    got = {r.k: r for r in out.collect()}
    assert len(got) == 120 and all(r.size is not None and r.brand is not None for r in got.values())
    assert {r.groups for r in got.values()} <= {0, 1, 2}
    for k, _, size, brand in rows:  # present values untouched
        if size is not None:
            assert got[k].size == size
        if brand is not None:
            assert got[k].brand == brand


def test_drop_constant_keeps_the_key(spark):
    df = spark.createDataFrame([("f", 1, 2)], "FileID string, a int, b int")
    assert P.drop_constant(df, keep=("FileID",)).columns == ["FileID"]


def test_cluster_fill_ignores_the_key(spark):
    rows = [(i, float(100 * (i % 2)) + (i * 37 % 11) / 10, None if i % 9 == 0 else float(i % 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, price double, size double")
    out = P.impute_by_cluster(df, {"size": "median"}, k=(2, 3), keys=("k",), keep_groups=True).collect()
    groups = {i % 2: {r.groups for r in out if r.k % 2 == i % 2} for i in (0, 1)}
    assert not groups[0] & groups[1]
    assert all(r.size == r.k % 2 for r in out)


def test_prepare_housing(spark):
    from logweave.plans.tabular import prepare_housing

    cols = "Id int, SalePrice double, Alley string, ExterQual string, YrSold int, MoSold int, MSZoning string, LotFrontage double, GarageCars double, PoolArea int"
    train = spark.createDataFrame(
        [(1, 10.0, "x", "Ex", 2008, 1, "RL", 60.0, 2.0, 1), (2, 20.0, None, "Po", 2009, 12, "RM", None, None, 0), (3, 5.0, None, "?", 2008, 1, "RL", 80.0, 1.0, 0)],
        cols,
    )
    test = spark.createDataFrame([(4, None, "Gd", 2010, 6, None, 100.0, 1.0, 0)], cols.replace("SalePrice double, ", "").replace("Id int", "Id int").replace("Alley string", "Alley string"))
    out = {r.Id: r for r in prepare_housing(train, test, delete=True).collect()}
    assert {i: r.part for i, r in out.items()} == {1: "train", 2: "train", 3: "train", 4: "test"}
    assert [out[i].ExterQual for i in (1, 2, 3, 4)] == [3, -1, 0, 2]
    assert out[2].LotFrontage == 80.0 and out[2].GarageCars == 0 and out[4].SalePrice is None
    assert out[4].MSZoning == out[1].MSZoning != out[2].MSZoning
    names = prepare_housing(train, test, delete=True).columns
    assert "Alley" not in names and "PoolArea" not in names and "YrSold" not in names
    assert "PoolArea" in prepare_housing(train, test).columns and "YMSold" in prepare_housing(train, test).columns
