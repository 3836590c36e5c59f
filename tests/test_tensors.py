import itertools

import numpy as np
import pytest

from logweave.operators import tensors as T


def ref_windows(n, step, width, mode, threshold):
    """The reference rule on row indices (0..n-1); padding as -1."""
    mat = list(range(n))
    out = []
    for i in range(0, n, step):
        block = mat[i:i + width]
        if len(block) < width:
            if len(block) < int(width * threshold):
                return out
            if mode == "lookback":
                block = mat[-width:]
            else:
                block = block + [-1] * (width - len(block))
            out.append(block)
            return out
        out.append(block)
    return out


def test_slide_windows_rule(spark):
    sizes = [1, 5, 8, 9, 10, 12]
    data = [(f"f{n}", b, n) for n in sizes for b in range(n)]
    ser = spark.createDataFrame(data, "FileID string, bucket long, n long")
    ser = ser.withColumn("CustomerIDCount", ser.bucket + 100).cache()
    for step, width, mode, thr in itertools.product([2, 3, 4], [4, 8], ["lookback", "padd"], [0.5, 0.8]):
        got = {}
        for r in T.slide_windows(ser, step, width, mode, thr, channels=["CustomerIDCount"]).collect():
            v = r.CustomerIDCount - 100 if r.CustomerIDCount else -1
            got.setdefault(r.FileID, {}).setdefault(r.window_no, {})[r.pos] = v
        for n in sizes:
            g = got.get(f"f{n}", {})
            got_l = [[g[w][p] for p in sorted(g[w])] for w in sorted(g)]
            assert got_l == ref_windows(n, step, width, mode, thr), (n, step, width, mode, thr)


def test_series_clip_gap_repeat(spark):
    # three events; one beyond 6 days (clipped); repeated second pre-aggregated
    log = spark.createDataFrame(
        [("f", "c1", 1000, "p"), ("f", "c2", 1000, "p"), ("f", "c1", 1000 + 7200, "p"),
         ("f", "c1", 1000 + T.SIX_DAYS + 5, "p")],
        "FileID string, CustomerID string, QueryTs long, ProductID string",
    )
    sec = T.per_second_counts(log)
    ser = T.series(sec, group_n=3600)
    got = {r.bucket: (r.CustomerIDCount, r.CustomerIDUniqCount, r.ProductIDUniqCount) for r in ser.collect()}
    assert len(got) == 144
    assert got[0] == (2, 2, 1) and got[2] == (1, 1, 1)
    assert sum(v[0] for v in got.values()) == 3  # the late event is clipped
    ten = T.tensor(ser, split_n=6).first().tensor
    assert np.array(ten).shape == (6, 24, 3)
    assert ten[0][2] == [1, 1, 1]
    rag = T.series(sec, group_n=3600, interval=None)
    assert rag.first().n == (T.SIX_DAYS + 5) // 3600 + 1


def test_tensor_refuses_a_remainder(spark):
    ser = spark.range(10).selectExpr("'f' as FileID", "id as bucket", "10L as n", *[f"id as {c}" for c in T.CHANNELS])
    assert T.tensor(ser, 5).count() == 1
    with pytest.raises(Exception, match="no reshape"):
        T.tensor(ser, 4).collect()


def test_health_check_finds_files_without_ids(spark):
    rows = [("good", "c", 5, "p"), ("bad", None, 5, "p"), ("bad", None, 6, "p")]
    log = spark.createDataFrame(rows, "FileID string, CustomerID string, QueryTs long, ProductID string")
    assert [tuple(r) for r in T.health_check(T.per_second_counts(log)).collect()] == [("bad", 3)]
