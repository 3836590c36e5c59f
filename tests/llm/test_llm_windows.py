"""Substring dedup, whitening and periodic runs against brute force."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logweave.llm import queries, runs, substrings, whitening

SCHEMA = "doc_id bigint, text string"

# substring dedup


def brute_dedup(rows, window=35):
    words = [(doc, (text or "").encode().split()) for doc, text in rows]
    count = Counter(tuple(w[i : i + window]) for _, w in words for i in range(len(w) - window + 1))
    out = []
    for doc, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), kept.decode()))
    return sorted(out, key=str)


def passages(seed=1):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(300)}"
    shared = [" ".join(word() for _ in range(n)) for n in (34, 35, 36, 80)]
    rows = []
    for i in range(120):
        parts = [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(3)]
        rows.append((i, f"{parts[0]} {shared[i % 4]}\n\t{parts[1]}  {shared[(i // 4) % 4] if i % 3 else ''} {parts[2]}"))
    rows += [(200, None), (201, ""), (202, " \n\x0b "), (None, rows[5][1]), (5, rows[5][1]), (203, "a " * 900), (204, "a b c " * 40)]
    rows += [(205, "é x\x1cy  " * 50), (206, "solo " + " ".join(f"u{i}" for i in range(400)))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 2000, "bucket_bytes": 400}, {"chunk_bytes": 500, "bucket_bytes": 1 << 20}])
def test_substrings(spark, sizes):
    rows = passages()
    got = substrings.dedup(spark.createDataFrame(rows, SCHEMA).repartition(3), **sizes)
    assert sorted(map(tuple, got.collect()), key=str) == brute_dedup(rows)


def test_substrings_other_window(spark):
    rows = passages(2)
    got = substrings.dedup(spark.createDataFrame(rows, SCHEMA), window=8).collect()
    assert sorted(map(tuple, got), key=str) == brute_dedup(rows, 8)


def test_hot_minimisers_travel_by_window(spark, monkeypatch):
    rng = random.Random(4)
    hot = " ".join(f"h{i}" for i in range(40))
    own = lambda n: " ".join(f"x{rng.randrange(10**9)}" for _ in range(n))
    rows = [(i, f"{own(50)} {hot} {own(50)}") for i in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(substrings, "FEW", 2)
    found = substrings.hot_minimisers(docs, 40, 4000, 35)
    assert 0 < len(found) < 40
    sent = substrings.sent(docs, found, 40, 4000, 35).groupBy("bucket").agg(F.sum(F.length("words")).alias("n")).collect()
    plain = substrings.sent(docs, np.empty(0, np.uint64), 40, 4000, 35).groupBy("bucket").agg(F.sum(F.length("words")).alias("n")).collect()
    assert max(r.n for r in sent) < 0.6 * max(r.n for r in plain)  # no bucket holds what all share
    got = substrings.dedup(docs, chunk_bytes=4000, bucket_bytes=7000).collect()
    assert sorted(map(tuple, got), key=str) == brute_dedup(rows)
    assert {r.n_removed for r in got} == {40}


def test_equal_hashes_are_compared_word_by_word(monkeypatch):
    monkeypatch.setattr(substrings, "rolled", lambda own, size: np.zeros(max(0, len(own) - size + 1), np.uint64))
    own = np.array([1, 2, 3, 4, 1, 2, 3, 5], np.uint32)
    at = np.arange(6)
    assert substrings.repeated(own, at, np.ones(6, np.int64), 3).tolist() == [True, False, False, False, True, False]


def test_substrings_empty_and_extra_columns(spark):
    assert substrings.digests(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = spark.createDataFrame(passages(), SCHEMA).selectExpr("doc_id", "text", "1 AS chunk", "'x' AS words", "2 AS n_words", "3 AS bucket")
    assert substrings.digests(docs).count() == len(passages())


# whitening


def eigen(x, k=4):
    u = np.unique(x, axis=0)
    mean = u.mean(0)
    values, vectors = np.linalg.eigh((u - mean).T @ (u - mean) / len(u))
    return u, values[::-1][:k], vectors[:, ::-1][:, :k]


def test_whitening(spark):
    rng = np.random.default_rng(1)
    c = rng.standard_normal((900, 40)) * np.linspace(1.5, 0.2, 40)
    c = np.concatenate([c, np.repeat(c[:1], 400, 0)])  # a hot vector counts once
    rows = [(i, v.tolist(), i) for i, v in enumerate(c)]
    bad = [(-1, None, 0), (-2, [], 0), (-3, [None] * 40, 0), (-4, [math.nan] * 40, 0), (-5, [math.inf] * 40, 0), (-6, [0.5] * 39, 0)]
    df = spark.createDataFrame(rows + bad + [(None, c[3].tolist(), 0), (3, c[3].tolist(), 0)], "vec_id bigint, embedding array<double>, n int")
    got = whitening.whiten(df).collect()
    assert len(got) == 4 * (len(rows) + 2) and min(r.vec_id for r in got if r.vec_id is not None) == 0
    x = np.floor(256 * c).astype(np.int64)
    u, values, vectors = eigen(x)
    n, sums = len(u), u.sum(0)
    white = ((x - sums / n) @ vectors) / np.sqrt(values)
    for r in got:
        if r.vec_id is None:
            continue
        want = white[r.vec_id, r.component - 1]
        assert r.n == n and math.isclose(abs(r.whitened), abs(want), rel_tol=1e-8, abs_tol=1e-9)
        assert r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[r.vec_id], sums))
        assert math.isclose(r.explained, values[r.component - 1] / np.trace(np.cov(u.T, bias=True)), rel_tol=1e-10)
        assert r.identity_error < 1e-10
    for k in range(4):  # one sign for all rows
        by_id = {r.vec_id: r.whitened for r in got if r.component == k + 1}
        own = np.array([by_id[i] for i in range(900)])
        assert abs(abs(own[:900] @ white[:900, k]) / (np.linalg.norm(own[:900]) * np.linalg.norm(white[:900, k])) - 1) < 1e-9


def test_whitening_close_eigenvalues(spark):
    """Flat spectrum: many rounds, still to rounding."""
    rng = np.random.default_rng(2)
    c = rng.standard_normal((3000, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(c)], "vec_id bigint, embedding array<double>")
    fit = whitening.fit(whitening.whole(df))
    _, values, vectors = eigen(np.floor(256 * c).astype(np.int64))
    assert np.allclose(fit.values, values, rtol=1e-12) and fit.residual < 1e-11
    assert np.abs(np.abs((fit.vectors * vectors).sum(0)) - 1).max() < 1e-10


@pytest.mark.parametrize("rows, components", [([], 0), ([[1.0, 2.0]] * 3, 0), ([[0.0, 0.0], [1.0, 1.0]], 1), ([[0.0], [1.0], [5.0]], 1), ([[1e300, 0.0], [0.0, 1.0]], 1)])
def test_whitening_few_directions(spark, rows, components):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "vec_id bigint, embedding array<double>")
    got = whitening.whiten(df).collect()
    assert len(got) == components * len(rows)
    assert all(math.isfinite(r.whitened) and r.identity_error < 1e-4 for r in got)


def test_exact_deviation_beyond_64_bits():
    x, sums = np.array([[2**31, -5]]), [2**33, 7]
    assert whitening.deviations(x, 10, sums) == [(10 * 2**31 - 2**33) ** 2 + 57**2]


# periodic runs


def brute_runs(words, least=24, times=3):
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((start, length, q) for (start, length), q in found.items())


def test_runs_of_numbers():
    rng = random.Random(1)
    for _ in range(1500):
        n, k = rng.randint(0, 70), rng.choice([1, 2, 2, 3, 5])
        w = [rng.randrange(k) for _ in range(n)]
        if n > 4 and rng.random() < 0.6:
            a, p = rng.randrange(n), rng.randint(1, n // 3 + 1)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(n)] = rng.randrange(k)
        least, times = rng.choice([(24, 3), (4, 2), (2, 2), (6, 3)])
        assert runs.find_runs(np.array(w, np.int64), least, times) == brute_runs(w, least, times)


@pytest.mark.parametrize("period", [1, 7, 1000])
def test_runs_of_long_texts(period):
    own = np.arange(300_000) % period
    assert runs.find_runs(own) == [(0, 300_000, period)]


def test_bounds_walk_on_when_jumps_end(monkeypatch):
    monkeypatch.setattr(runs, "JUMPS", 1)
    rng = random.Random(2)
    for _ in range(200):
        lcp = np.array([0] + [rng.randrange(6) for _ in range(40)] + [0])
        at = np.flatnonzero(lcp)
        low, high = runs.bounds(lcp, at)
        for p, a, b in zip(at, low, high):
            assert a == max(q for q in range(p) if lcp[q] <= lcp[p]) and b == min(q for q in range(p + 1, 42) if lcp[q] < lcp[p])


def test_runs(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcde") for _ in range(rng.randint(0, 200)))) for i in range(150)]
    rows += [(i, "x " * (i % 60) + "a b c " * (i % 30) + "tail " + "y z " * 12) for i in range(200, 260)]
    rows += [(300, None), (301, ""), (302, " \t\n"), (None, "q r " * 30), (3, rows[3][1]), (303, "word " * 40_000)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id", "text", "1 AS runs", "2 AS start").repartition(3)
    got = sorted(map(tuple, runs.runs(docs, chunk_bytes=3000).select("doc_id", "n_words", "runs", "text").collect()), key=str)
    want = []
    for doc, text in rows:
        words = (text or "").split()
        found = brute_runs(words) if doc != 303 else [(0, 40_000, 1)]
        gone = {i for a, n, q in found for i in range(a + q, a + n)}
        want.append((doc, len(words), [tuple(r) for r in found], " ".join(w for i, w in enumerate(words) if i not in gone)))
    assert [(a, b, [tuple(r) for r in c], d) for a, b, c, d in got] == sorted(want, key=str)
    digest = runs.runs(docs, finish=runs.as_digests, schema=runs.DIGESTS)
    for r in digest.collect():
        if r.doc_id == 303:
            assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (1, 0, 40_000, 1, 40_000_000)
            assert r.runs_sha256 == hashlib.sha256(b"0,40000,1\n").hexdigest()
            assert r.collapsed_sha256 == hashlib.sha256(b"word").hexdigest()
        if r.doc_id == 301:
            assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (0, None, None, None, None)
    assert runs.runs(spark.createDataFrame([], SCHEMA)).collect() == []


def test_strongest_run():
    assert runs.strongest([(5, 30, 10), (0, 24, 8), (40, 48, 16), (2, 25, 9)]) == (0, 24, 8)
    assert runs.strongest([(9, 24, 1), (3, 24, 1), (0, 23_000, 1000)]) == (3, 24, 1)


def test_repeated_tail():
    words = [str(i).encode() for i in range(50)]
    changed = {d for d in range(200) if queries.repeated_tail(d, words) != words}
    assert 10 <= len(changed) <= 30 and queries.repeated_tail(None, words) == words
    assert all(len(queries.repeated_tail(d, words)) == 50 and queries.repeated_tail(d, []) == [] for d in changed)
