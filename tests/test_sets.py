from logweave.functions.sets import set_intersect, set_symdiff, set_union
from logweave.operators import overlap as O
from logweave.operators.overlap import compare_sets


def test_set_null_rules(spark):
    df = spark.createDataFrame(
        [
            (1, None, None),
            (2, None, ["b"]),
            (3, ["a"], None),
            (4, ["a"], ["b"]),
            (5, ["a", "b"], ["b", "a"]),
            (6, ["a", "b"], ["b", "c"]),
        ],
        "i int, a array<string>, b array<string>",
    )
    out = {
        r.i: (r.u, r.s, r.x)
        for r in df.select("i", set_union("a", "b").alias("u"), set_symdiff("a", "b").alias("s"),
                           set_intersect("a", "b").alias("x")).collect()
    }
    assert out[1] == (None, None, None)
    assert out[2] == (["b"], ["b"], None)
    assert out[3] == (["a"], ["a"], None)
    assert out[4] == (["a", "b"], ["a", "b"], [])
    assert out[5] == (["a", "b"], [], ["a", "b"])
    assert out[6] == (["a", "b", "c"], ["a", "c"], ["b"])


def test_compare_sets_sides(spark):
    left = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    right = spark.createDataFrame([("b",), ("c",)], "k string")
    got = {r.k: r.side for r in compare_sets(left, right, ["k"]).collect()}
    assert got == {"a": "left", "b": "both", "c": "right"}


def test_sets_come_from_kept_pairs(spark, monkeypatch):
    log = spark.createDataFrame([("f1", "c1", 1, "p1"), ("f2", "c1", 2, "p1"), ("f1", "c2", 3, "p2"), ("f3", "c9", 4, "p9"), ("f2", None, 5, "p3")], "FileID string, CustomerID string, QueryTs long, ProductID string")
    ids = spark.createDataFrame([("f1", "train"), ("f2", "test")], "FileID string, split string")
    sets = O.train_test_sets(log, ids)
    # The log is joined once for all kinds, not again for each that is read.
    assert all("Join" not in t._jdf.queryExecution().executedPlan().toString() for t in sets.values())
    got = {k: sorted(tuple(r) for r in t.collect()) for k, t in sets.items()}
    assert got["product"] == [("test", "p1"), ("train", "p1"), ("train", "p2")]
    assert got["customer"] == [("test", "c1"), ("train", "c1"), ("train", "c2")]
    assert got["prod_cus"] == [("test", "p1", "c1"), ("train", "p1", "c1"), ("train", "p2", "c2")]
    plans = []
    keep = O.kept_table
    monkeypatch.setattr(O, "kept_table", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df, name))
    both, other = O.overlap_all(log, ids), O.overlap_all(log, ids, reverse=True)
    assert "Generate" not in "".join(plans) and sum("Join" in p for p in plans) == 2  # pairs aren't listed three times
    assert {k: sorted(tuple(r) for r in t.collect()) for k, t in both.items()} == {"product": [("p1",)], "customer": [("c1",)], "prod_cus": [("p1", "c1")]}
    assert {k: sorted(tuple(r) for r in t.collect()) for k, t in other.items()} == {"product": [("p2",)], "customer": [("c2",)], "prod_cus": []}
