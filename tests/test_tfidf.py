import numpy as np
import pytest

from logweave.operators import tfidf as T


def brute(docs):
    """Vectorizer defaults by hand: lower-case, >= 2 word chars, smooth idf, l2."""
    import re

    toks = [[t for t in re.findall(r"(?u)\b\w\w+\b", d.lower())] for d in docs]
    vocab = sorted({t for ts in toks for t in ts})
    n = len(docs)
    tf = np.array([[ts.count(v) for v in vocab] for ts in toks], dtype=float)
    dfreq = (tf > 0).sum(axis=0)
    idf = np.log((1 + n) / (1 + dfreq)) + 1
    w = tf * idf
    norms = np.sqrt((w**2).sum(axis=1, keepdims=True))
    x = np.divide(w, norms, out=np.zeros_like(w), where=norms > 0)
    out = {}
    for j, v in enumerate(vocab):
        t = x[:, j]
        out[v] = dict(mean=t.mean(), median=np.median(t), std=t.std(), min=t.min(), max=t.max(),
                      ptp=np.ptp(t), q1=np.percentile(t, 25), q3=np.percentile(t, 75), idf=idf[j])
    return out


def test_tfidf_summary_matches_dense(spark):
    # doc -> FileIDs (token in all docs, in one, twice in one, 1-char, case twins)
    rows = [
        ("d1", "fa"), ("d1", "fb"), ("d1", "fb"), ("d1", "x"),
        ("d2", "fa"), ("d2", "FC"),
        ("d3", "fa"), ("d3", "fc"),
    ]
    log = spark.createDataFrame([(f, d) for d, f in rows], "FileID string, ProductID string")
    got = {r.FileID: r.asDict() for r in T.tfidf_summary(T.corpus(log, "ProductID"), "P").collect()}
    docs = {}
    for d, f in rows:
        docs.setdefault(d, []).append(f)
    exp = brute([" ".join(docs[d]) for d in sorted(docs)])
    assert set(got) == set(exp)  # 'x' vanished, 'FC'/'fc' merged
    for tok, e in exp.items():
        for k, v in e.items():
            col = f"P_idf" if k == "idf" else f"P_tfidf_{k}"
            assert got[tok][col] == pytest.approx(v, abs=1e-12), (tok, k)


def test_corpus_by_batch_of_the_overlap(spark):
    rows = [(0, "fa", "p1", "c1"), (0, "fb", "p1", "c2"), (0, "fa", "p1", "c1"), (1, "fb", "p2", "c1"), (2, "fc", "p2", "c2")]
    log = spark.createDataFrame(rows, "batch_id int, FileID string, ProductID string, CustomerID string")
    target = {
        "prod_cus": spark.createDataFrame([("p1", "c1"), ("p2", "c2")], "ProductID string, CustomerID string"),
        "product": spark.createDataFrame([("p1",)], "ProductID string"),
        "customer": spark.createDataFrame([("c1",)], "CustomerID string"),
    }
    empty = {("0", None, 0), ("1", None, 0), ("2", None, 0)}
    got = lambda *a: {tuple(r) for r in T.corpus_by_batch(log, *a).collect()}
    assert got(target) == empty | {("0", "fa", 2), ("2", "fc", 1)}
    assert got(target, "product") == empty | {("0", "fa", 2), ("0", "fb", 1)}
    assert got() == {("0", "fa", 2), ("0", "fb", 1), ("1", "fb", 1), ("2", "fc", 1)}
    # Batch 1 is empty but counts: idf of a token of one of three documents.
    idf = {r.FileID: r.d_idf for r in T.tfidf_summary(T.corpus_by_batch(log, target), "d").collect()}
    assert idf["fa"] == pytest.approx(np.log(4 / 2) + 1)
