"""Near-duplicates, search, PII and the classifier against brute force."""

import hashlib
import math
import random
import re
from collections import Counter
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from logweave.llm import cotrain, neardup, pii, search

# near-duplicates


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_distance():
    rng = random.Random(1)
    for _ in range(20_000):
        a = [rng.choice("abc") for _ in range(rng.randint(0, 14))]
        b = [x if rng.random() < 0.8 else rng.choice("abcd") for x in a if rng.random() < 0.9]
        if rng.random() < 0.3:
            b = [rng.choice("abc") for _ in range(rng.randint(0, 14))]
        limit, want = rng.randint(0, 6), edit_distance(a, b)
        got = neardup.distance(a, b, limit)
        assert got == want if want <= limit else got > limit


def test_labels_keep_order_and_occurrence():
    words = [f"w{i}".encode() for i in range(40)]
    own = neardup.labelled(words)
    assert len(own) == 36 and len(set(own.tolist())) == 36
    assert len(set(neardup.labelled([b"a"] * 40).tolist())) == 36  # copies of a k-mer differ
    one, two = neardup.sketch(words)[0], neardup.sketch(words[20:] + words[:20])[0]
    assert len(set(one) & set(two)) < neardup.SKETCHES  # the same k-mers in another order
    assert neardup.sketch([b"a"])[0] != neardup.sketch([b"b"])[0]


def texts(rng, n, length):
    return [" ".join(f"w{rng.randrange(4000)}" for _ in range(length)) for _ in range(n)]


def changed(rng, text, share):
    return " ".join(w if rng.random() > share else f"x{rng.randrange(10**6)}" for w in text.split())


def planted():
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(60))
    rows, group = [], []
    for k, base in enumerate(texts(rng, 25, 150)):
        for copy in range(1 + k % 6):
            rows.append(changed(rng, base, 0.03) if copy else base)
            group.append(k)
    for k in range(40):  # unlike texts that share a passage
        rows.append(passage + " " + texts(rng, 1, 200)[0])
        group.append(1000 + k)
    hot = texts(rng, 1, 120)[0]
    for _ in range(150):
        rows.append(changed(rng, hot, 0.04))
        group.append(2000)
    for _ in range(80):
        rows.append(hot)
        group.append(2000)
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [rows[i] for i in order], [group[i] for i in order]


def test_classes(spark):
    rows, group = planted()
    own = [(i, t, "k") for i, t in enumerate(rows)]
    more = [(9000, None, "k"), (9001, "", None), (9002, " \n", "k"), (9003, "", "k"), (None, "alone without id", "k"), (9004, "short", ""), (9005, "short", "")]
    docs = spark.createDataFrame([*own, *more, own[0]], "doc_id bigint, text string, key string").repartition(6)
    out = neardup.classes(docs).collect()
    assert len(out) == len(own) + len(more) + 1
    found = {r.doc_id: r.class_id for r in out}
    want = {}
    for i, g in enumerate(group):
        want.setdefault(g, i)
    assert {i: found[i] for i in range(len(rows))} == {i: want[g] for i, g in enumerate(group)}
    assert [found[i] for i in (9000, 9001, 9002, 9003, None, 9004, 9005)] == [9000, 9001, 9002, 9003, None, 9004, 9004]
    kept = neardup.first_of_class(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([*want.values(), 9000, 9001, 9002, 9003, 9004, None])
    assert neardup.classes(docs.limit(0)).count() == 0 and neardup.first_of_class(docs.limit(0)).count() == 0


def replaced(rng, text, n):
    """Exactly ``n`` words replaced, at random places."""
    words = text.split()
    for i in rng.sample(range(len(words)), n):
        words[i] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def test_pairs_at_the_threshold(spark):
    """Planted pairs of edit similarity 0.80, 0.82 and 0.85, and pairs just below."""
    rng = random.Random(8)
    rows = []
    for n in (60, 54, 45, 61):
        for base in texts(rng, 60, 300):
            rows += [base, replaced(rng, base, n)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").repartition(5)
    found = {r.doc_id: r.class_id for r in neardup.classes(docs).collect()}
    assert found == {i: i if i >= 360 else i - i % 2 for i in range(len(rows))}


def test_links_between_texts_that_unlike_pivots_absorb(spark, monkeypatch):
    """Texts put together from two passages for each place: every bucket holds many
    unlike texts, which its pivot absorbs.  Two are similar if at most 8 of 40 differ."""
    rng = random.Random(12)
    picks = [[rng.randrange(2) for _ in range(40)] for _ in range(300)]
    for own in picks[:60]:
        places = set(rng.sample(range(40), 8))
        picks.append([1 - x if i in places else x for i, x in enumerate(own)])
    rows = [" ".join(f"w{i}v{x}n{n}" for i, x in enumerate(own) for n in range(8)) for own in picks]
    want = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if want[a] != want[b] and sum(map(int.__ne__, picks[a], picks[b])) <= 8:
                assert neardup.similar(rows[a].split(), rows[b].split())
                low, high = sorted((want[a], want[b]))
                want = [low if x == high else x for x in want]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").repartition(5)
    monkeypatch.setattr(neardup, "TILE", 7, raising=False)
    assert {r.doc_id: r.class_id for r in neardup.classes(docs).collect()} == dict(enumerate(want))


def test_tiles_hold_every_pair_of_two_classes():
    rng = np.random.default_rng(4)
    bags = rng.integers(0, 3, (40, neardup.BINS)).astype(np.uint8)
    bits = bytes(neardup.BITS)
    rows = [(bytes([i]), 400, bits, b.tobytes(), i % 3, 2) for i, b in enumerate(bags)]
    near = {(a, b) for a in range(40) for b in range(a) if a % 3 != b % 3 and neardup.lacking(bags[[a]], bags[b].astype(np.int16))[0] <= 80}
    got = neardup.tile_pairs(rows, None)
    assert {tuple(sorted((x[0], y[0]), reverse=True)) for x, y in got} == near and len(got) == len(near)
    assert Counter(x[0] for x, _ in neardup.tile_pairs(rows, 1)) == {i: 2 for i in range(40)}


def test_pairs_of_a_common_passage_stay_few():
    """Long texts over the same frequent words that share a passage: the bags let nearly
    all pairs through, the marks only those whose words may do."""
    rng = np.random.default_rng(14)
    passage = [b"p%d" % i for i in range(200)]
    body = [b"w%d" % w for w in (rng.zipf(1.3, 200_000) % 3000)]
    words = [passage + body[1000 * i : 1000 * i + 600] for i in range(60)]
    words += [[x if rng.random() < 0.9 else b"x%d" % rng.integers(9) for x in w] for w in words[:20]]
    bits = bytes(neardup.BITS)
    by_bags = [(bytes([i]), len(w), bits, neardup.bag(w), i, 2) for i, w in enumerate(words)]
    by_marks = [(*r[:3], neardup.marks(w), *r[4:]) for r, w in zip(by_bags, words, strict=True)]
    loose, near = (set(neardup.tile_pairs(r, None, f)) for r, f in ((by_bags, neardup.by_bags), (by_marks, neardup.by_marks)))
    want = {(bytes([i]), bytes([j])) for j in range(len(words)) for i in range(j) if neardup.similar(words[i], words[j])}
    assert len(want) >= 20 and want <= near <= loose and len(near) <= len(loose) / 4
    met = {r[1] for r in neardup.tile_members(5, by_bags)}
    assert met == {k for pair in loose for k in pair}


def test_buckets_of_one_tile_are_not_multiplied(spark, monkeypatch):
    monkeypatch.setattr(neardup, "TILE", 4)
    label = lambda e, k: 7 if k < (1 if e == 1 else 5) else k
    rows = [(e, bytes([k]), 20, b"", label(e, k), 7, 1 if e == 1 else 5, n) for e, n in ((1, 4), (2, 11)) for k in range(n)]
    members = spark.createDataFrame(rows, "entry bigint, key binary, n_words int, bits binary, label bigint, major bigint, most bigint, n bigint")
    bounds = spark.createDataFrame([(bytes([k]), b"") for k in range(11)], "key binary, own binary")
    placed = neardup.dealt(members, bounds).collect()
    assert [(r.kind, r.i, r.j, r.side) for r in placed if r.entry == 1] == [(0, 0, 0, 2)] * 4
    met = set()
    for r in placed:
        for o in placed:
            if (r.entry, r.kind, r.i, r.j) == (o.entry, o.kind, o.i, o.j) and r.label != o.label and (r.side == 2 or r.side != o.side):
                met.add((r.entry, *sorted((r.key[0], o.key[0]))))
    want = {(e, a, b) for e, n in ((1, 4), (2, 11)) for b in range(n) for a in range(b) if label(e, a) != label(e, b)}
    assert met == want


def test_bags_bound_the_distance():
    rng = random.Random(13)
    for _ in range(300):
        a = [b"%d" % rng.randrange(60) for _ in range(rng.randint(1, 40))]
        b = [x if rng.random() < 0.8 else b"%d" % rng.randrange(90) for x in a if rng.random() < 0.9]
        x, y = (np.frombuffer(neardup.bag(w), np.uint8) for w in (a, b))
        assert neardup.lacking(x[None, :], y.astype(np.int16))[0] <= edit_distance(a, b)


def test_candidates_at_the_threshold():
    rng = random.Random(9)

    def met(one, two):
        (a, x), (b, y) = neardup.sketch(one.encode().split()), neardup.sketch(two.encode().split())
        return bool(set(a) & set(b)) and sum(map(int.__eq__, x, y)) >= neardup.AGREE

    pairs = [(t, replaced(rng, t, 60)) for t in texts(rng, 400, 300)]
    assert sum(met(*p) for p in pairs) >= 398
    every_fifth = [(t, " ".join("x" if i % 5 == 2 else w for i, w in enumerate(t.split()))) for t in texts(rng, 400, 300)]
    assert sum(met(*p) for p in every_fifth) >= 380


def test_short_texts_against_brute_force(spark):
    rng = random.Random(10)
    rows = []
    for n in [1, 2, 3, *range(4, 15), *range(4, 15)]:
        base = [f"w{rng.randrange(4000)}" for _ in range(n)]
        rows += [base, [*base[: n // 2], "y", *base[n // 2 + 1 :]], base[: n // 2] + base[n // 2 + 1 :]]
        for _ in range(4):
            copy = [w if rng.random() > 0.15 else f"x{rng.randrange(4)}" for w in base if rng.random() > 0.08]
            rows.append(copy + ["z"] * (rng.random() < 0.2))
    rows += [[rng.choice("ab") for _ in range(rng.randint(1, 14))] for _ in range(40)]
    rows = [r for r in rows if 0 < len(r) < neardup.SHORT]
    want = list(range(len(rows)))
    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            if 5 * edit_distance(a, b) <= max(len(a), len(b)) and want[i] != want[j]:
                low, high = sorted((want[i], want[j]))
                want = [low if w == high else w for w in want]
    docs = spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], "doc_id bigint, text string").repartition(5)
    found = {r.doc_id: r.class_id for r in neardup.classes(docs).collect()}
    assert found == dict(enumerate(want))


def test_rows_that_meet():
    for entries, want in (([], []), ([1], [1]), ([1, 2, 3], [1, 0, 1]), ([1, 2, 2, 3, 4], [1, 1, 1, 0, 1]), ([1, 1, 2], [1, 1, 1])):
        assert neardup._met(np.array(entries, np.int64)).tolist() == list(map(bool, want))


def test_repeated_ids_with_other_texts(spark):
    rng = random.Random(4)
    a, b = texts(rng, 2, 80)
    docs = spark.createDataFrame([(1, a), (1, b), (2, a), (3, b), (1, a)], "doc_id bigint, text string")
    left = neardup.first_of_class(docs).collect()
    assert sorted((r.doc_id, r.text) for r in left) == sorted([(1, a), (1, b)])


def test_components_of_a_chain(spark):
    key = lambda i: hashlib.md5(str(i).encode()).digest()
    chain = [(key(i), key(i + 1)) for i in range(60)] + [(key(100), key(101)), (key(101), key(102)), (key(100), key(102))]
    links = spark.createDataFrame([(min(x), max(x)) for x in chain], "a binary, b binary")
    out = {bytes(r.node): bytes(r.root) for r in neardup.components(links).collect()}
    first, second = min(key(i) for i in range(61)), min(key(i) for i in (100, 101, 102))
    assert out == {key(i): first for i in range(61) if key(i) != first} | {key(i): second for i in (100, 101, 102) if key(i) != second}


# search


def slow_search(rows, k):
    terms = [re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower()) for _, t in rows]
    n, mean = len(rows), sum(map(len, terms)) / len(rows)
    df = Counter(x for t in terms for x in set(t))
    idf = {x: math.log(1 + (n - c + 0.5) / (c + 0.5)) for x, c in df.items()}
    tf = [Counter(t) for t in terms]
    out = Counter()
    for q, (i, _) in enumerate(rows):
        if i is None or i % 20:
            continue
        scores = []
        for d, (j, _) in enumerate(rows):
            norm = search.K1 * (1 - search.B + search.B * len(terms[d]) / mean)
            s = sum(c * idf[x] * tf[d][x] * (search.K1 + 1) / (tf[d][x] + norm) for x, c in tf[q].items() if x in tf[d])
            if s > 0:
                scores.append((-round(s, 6), j is None, j or 0))
        for rank, (s, null, j) in enumerate(sorted(scores)[:k], 1):
            out[(i, rank, None if null else j, -s)] += 1
    return out


@pytest.mark.parametrize("shard_bytes", [3000, 1 << 30])
def test_search(spark, monkeypatch, shard_bytes):
    rng = random.Random(5)
    common = ["the", "of", "Été", "a1"]
    rows = []
    for i in range(300):
        words = [rng.choice(common) if rng.random() < 0.5 else f"t{int(rng.paretovariate(0.6)) % 500}" for _ in range(rng.choice([1, 5, 30, 200]))]
        rows.append((i, ", ".join(words)))
    rows += [(400, None), (420, ""), (440, "zz zz"), (None, rows[3][1]), (20, rows[20][1]), (500, "THE the éTÉ"), (7, rows[20][1])]
    monkeypatch.setattr(search, "CHUNK_BYTES", 700)
    monkeypatch.setattr(search, "BLOCK_QUERIES", 5)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("score", F.lit("clash")).repartition(3)
    out = search.search(docs, F.col("doc_id") % 20 == 0, k=7, shard_bytes=shard_bytes).collect()
    assert Counter(tuple(r) for r in out) == slow_search(rows, 7)
    assert search.search(docs.limit(0), F.col("doc_id") % 20 == 0).count() == 0


def test_blocks_are_skipped(monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(search, "DENSE", 2)
    monkeypatch.setattr(search, "DOCS_PER_BLOCK", 4)
    texts = [b" ".join(b"w%d" % x for x in sorted(rng.zipf(1.3, 60) % 3000)) for _ in range(4000)]
    texts[77] = texts[5] + b" w2 w3"
    own = search.invert(np.arange(4000), texts)
    shard = search.Shard(own, 60)
    query = search.invert(np.arange(1), [texts[5]])
    asked = [(query["hashes"], query["counts"].astype(float))]
    ((docs, scores),) = shard.top(asked, np.zeros(1), 2)
    shard.seen = shard.skipped = 0
    ((again, _),) = shard.top(asked, scores[-1:], 2)  # a threshold from shards before
    assert {5, 77} == set(docs.tolist()) == set(again.tolist()) and shard.skipped > shard.seen / 2


# PII


def luhn(digits):
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def slow_feistel(cells, kind, key):
    half = len(cells) // 2
    for i in range(pii.ROUNDS):
        moving = [(k < half) == (i % 2 == 0) for k in range(len(cells))]
        other = ",".join(str(x) for (x, _), m in zip(cells, moving) if not m)
        d = hashlib.sha512(f"{key}|{kind}|{i}|{other}".encode()).hexdigest()
        cells = [((x + int(d[8 * (k % 16) : 8 * (k % 16) + 8], 16)) % r, r) if m else (x, r) for k, ((x, r), m) in enumerate(zip(cells, moving))]
    return [x for x, _ in cells]


def slow_card(p, key):
    digits = re.sub("[^0-9]", "", p)
    body = slow_feistel([(int(c), 10) for c in digits[:-1]], "card", key)
    body = "".join(map(str, body))
    whole = iter(body + next(c for c in "0123456789" if luhn(body + c)))
    return re.sub("[0-9]", lambda m: next(whole), p)


def slow_date(day, key):
    at = (day - date(1900, 1, 1)).days
    a, b = slow_feistel([(at // 4297, 17), (at % 4297, 4297)], "date", key)
    return date(1900, 1, 1) + timedelta(a * 4297 + b)


def one(spark, values, key="k"):
    docs = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id bigint, text string")
    return [r.text for r in pii.pseudonymise(docs, key).orderBy("doc_id").collect()]


def test_short_addresses(spark):
    short = ["a@b.c", "x@y.z", "a@b.co", "q7@b.c", "ab@c.de"]
    docs = spark.createDataFrame([(i, f"to {x}, or") for i, x in enumerate([*short, "a@b"])], "doc_id bigint, text string")
    out = [r.text for r in pii.pseudonymise(docs, "k").orderBy("doc_id").collect()]
    for x, text in zip(short, out, strict=False):
        local, domain = x.split("@")
        cells = [(int(c), 10) if c.isdigit() else (ord(c) - 97, 26) for c in local]
        new = "".join(str(v) if r == 10 else chr(97 + v) for v, (_, r) in zip(slow_feistel(cells, "email", "k"), cells))
        assert text == f"to {new}@{domain}, or" and new != local
    assert out[-1] == "to a@b, or"


def test_cards_and_dates(spark):
    cards = ["4845168114407329", "4845-1681-1440-7329", "4845 1681 1440 7329", "378282246310005", "3782 822463 10005"]
    days = [date(1980, 2, 29), date(1900, 1, 1), date(2099, 12, 31)]
    out = one(spark, [f"é pay {c}, ok" for c in cards] + [d.isoformat() for d in days])
    assert out[:5] == [f"é pay {slow_card(c, 'k')}, ok" for c in cards]
    assert all(luhn(re.sub("[^0-9]", "", t)) for t in out[:5])
    assert out[5:] == [slow_date(d, "k").isoformat() for d in days]
    iso, dmy, mdy, slash = one(spark, ["1980-02-29", "29.02.1980", "02/29/1980", "1980/02/29"])
    y, m, d = iso.split("-")
    assert (dmy, mdy, slash) == (f"{d}.{m}.{y}", f"{m}/{d}/{y}", f"{y}/{m}/{d}")
    assert one(spark, ["4845168114407329"], "other")[0] != one(spark, ["4845168114407329"])[0]


def test_other_kinds(spark):
    out = one(spark, ["+1 (017) 555-7713 x", "017-555-7713 x", "9.8.7.255,", "ab.55@mail4.example.com", "123-45-6789", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"'])
    assert re.fullmatch(r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4} x", out[0]) and re.sub("[^0-9]", "", out[0])[1:] == re.sub("[^0-9]", "", out[1])
    assert all(int(o) < 256 for o in out[2].rstrip(",").split("."))
    assert re.fullmatch(r"[a-z]{2}\.[0-9]{2}@mail4\.example\.com", out[3])
    assert re.fullmatch(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}", out[4])
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', out[5])
    assert len(set(out)) == 6 and not any("017" in t and "7713" in t for t in out)


def test_clean_texts_stay(spark):
    same = ["9807915762804490", "1981-02-30", "666-45-6789", "1.2.3.4.5", "300.1.1.1", "room 12, 2012.", "", None, "a@b", "x" * 70_000, "deadbeef" * 4, "1" * 40, "3.5 million", "1899-01-01"]
    assert one(spark, same) == same


def test_the_key_comes_from_the_session(spark):
    docs = spark.createDataFrame([(1, "born 1981-02-03")], "doc_id bigint, text string")
    with pytest.raises(ValueError):
        pii.pseudonymise(docs)
    spark.conf.set(pii.SETTING, "one")
    try:
        own = pii.pseudonymise(docs).first().text
        assert own == pii.pseudonymise(docs, "one").first().text != pii.pseudonymise(docs, "two").first().text
        assert pii.session_key(spark, "other") == "one"
    finally:
        spark.conf.unset(pii.SETTING)


def test_dates_are_permuted(spark):
    days = spark.range(73049).select(F.col("id").alias("doc_id"), F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).cast("string").alias("text"))
    assert pii.pseudonymise(days, "k").agg(F.countDistinct("text"), F.min("text"), F.max("text")).first() == (73049, "1900-01-01", "2099-12-31")


def test_columns_stay(spark):
    docs = spark.createDataFrame([(None, "ip 10.20.30.40", "a", 14), (1, None, None, 5), (1, "x", "", 1)], "doc_id bigint, text string, __new string, n_chars bigint")
    out = pii.pseudonymise(docs, "k").collect()
    assert pii.pseudonymise(docs, "k").columns == docs.columns and [r["__new"] for r in out] == ["a", None, ""]
    assert out[0].n_chars == len(out[0].text) and out[1].n_chars == 5
    assert pii.pseudonymise(docs.limit(0), "k").count() == 0


# classifier


def labelled(spark, n=900, unlabelled=300):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n + unlabelled):
        bad = i % 4 == 0
        words = [f"w{rng.randrange(3000)}" + ("$$$" if bad and rng.random() < 0.8 else "") for _ in range(rng.randint(40, 120))]
        # the source tells most of it too
        rows.append((i, " ".join(words), "en", ("junk" if rng.random() < 0.9 else "fine") if bad else ("fine" if rng.random() < 0.95 else "junk"), len(words) * 5, "m"))
        if i < n:
            labels.append((i, int(not bad), 0))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, __m string")
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_cotraining(spark):
    docs, labels = labelled(spark)
    out = {r.doc_id: r for r in cotrain.score(docs, labels).collect()}
    assert len(out) == 1200
    held = range(900, 1200)
    right = [(out[i].p_good >= 0.5) == bool(i % 4) for i in held]
    assert np.mean(right) > 0.97
    assert np.mean([out[i].kept for i in held if i % 4]) > 0.97 and np.mean([out[i].kept for i in held if not i % 4]) < 0.3
    assert np.mean([(out[i].p_meta >= 0.5) == bool(i % 4) for i in held]) > 0.85  # each view works alone
    odd = spark.createDataFrame([(None, "a b", None, None, None, None), (5000, None, "xx", "new", 0, ""), (5000, None, "xx", "new", 0, "")], docs.schema)
    left = cotrain.keep_good(docs.unionByName(odd), labels)
    assert left.columns == docs.columns and left.where("__m = 'm'").count() > 870
    assert cotrain.score(docs.limit(0), labels).count() == 0


def test_exchange_reads_all_unlabelled(spark):
    docs, labels = labelled(spark, 600, 500)
    gone = spark.createDataFrame([(10_000 + i, 1, 0) for i in range(3000)], labels.schema)  # labels of no document
    rows = cotrain.prepared(docs, labels.unionByName(gone), max_labelled=600).cache()
    assert rows.where("__y is not null").count() == 600
    model = cotrain.fit(rows, max_pseudo=40)
    assert len(model["exchanges"]) == cotrain.ROUNDS and all(e[None, "all"] == 500 for e in model["exchanges"])
    limits = {"text": {0: -0.5, 1: 0.5}, "meta": {0: None, 1: 0.2}}
    margins = rows.where("__y is null")
    for v in cotrain.VIEWS:
        margins = cotrain.scored(model["models"][v], margins, f"__m_{v}")
    found = margins.select("__m_text", "__m_meta").collect()
    taught, counts = cotrain.exchanged(rows, model["models"], limits, 0, 10**6)
    want = {("text", 0): sum(a <= -0.5 for a, _ in found), ("text", 1): sum(a >= 0.5 for a, _ in found), ("meta", 0): 0, ("meta", 1): sum(b >= 0.2 for _, b in found)}
    assert {k: n for k, n in counts.items() if k[0]} == want and min(n for k, n in want.items() if k != ("meta", 0)) > 20
    for v, other in (("text", "meta"), ("meta", "text")):
        got = Counter(r[0] for r in taught[other].select("__y").collect())
        assert got == Counter({float(label): want[v, label] for label in (0, 1) if want[v, label]})
        assert taught[other].columns == ["__y", f"__{other}"]
    drawn = [cotrain.exchanged(rows, model["models"], limits, turn, 60)[0]["meta"] for turn in (0, 1)]
    assert all(20 < d.where("__y = 1").count() < 120 for d in drawn)  # about 60, others each round
    assert {tuple(r[1].indices) for r in drawn[0].collect()} is not None and drawn[0].count() + drawn[1].count() > 100
    rows.unpersist()


def test_cotraining_ties_long_texts_and_a_hot_id(spark):
    docs, labels = labelled(spark, 200, 50)
    same = docs.where("doc_id < 40")
    long = spark.createDataFrame([(7000, "word " * 200_000, "en", "fine", 10**6, "m")], docs.schema)
    many = docs.unionByName(long)
    for _ in range(20):
        many = many.unionByName(same)
    rows = cotrain.prepared(many, labels, 150)
    assert rows.count() == 251 + 800 and rows.where("__y is not null").select("__id").distinct().count() == 150
    out = cotrain.score(many, labels)
    assert out.count() == 251 + 800
    assert out.groupBy("doc_id").agg(F.countDistinct("p_good").alias("n")).where("n > 1").count() == 0  # equal rows, equal scores


def test_no_labels_keep_all(spark):
    docs, labels = labelled(spark, 20, 0)
    out = cotrain.score(docs, labels.where("quality = 1")).collect()
    assert len(out) == 20 and all(r.kept and r.p_good is None for r in out)
    assert cotrain.keep_good(docs, labels.limit(0)).count() == 20


@pytest.mark.parametrize("n", [16, 20, 30, 50, 51, 63, 64, 80])
def test_every_fifth_word_replaced_is_found(n):
    """The worst spread of changes at a similarity of 0.8: candidates by shared entries."""
    rng, found = random.Random(n), 0
    for _ in range(100):
        a = [f"w{rng.randrange(5000)}".encode() for _ in range(n)]
        b = [w if i % 5 else f"x{rng.randrange(10**6)}".encode() for i, w in enumerate(a)]
        for k, fits in ((neardup.K, n >= neardup.BRIEF[0]), (neardup.BRIEF_K, n < neardup.BRIEF[1])):
            if fits:
                (x, xb), (y, yb) = neardup.sketch(a, k), neardup.sketch(b, k)
                if set(x) & set(y) and sum(p == q for p, q in zip(xb, yb)) >= neardup.AGREE:
                    found += 1
                    break
    assert found >= 90 and all(n2 < neardup.BRIEF[1] for n2 in range(51) if n2 * 4 / 5 < neardup.BRIEF[0])


def test_brief_texts_meet_across_the_limits(spark):
    rng = random.Random(8)
    rows = []
    for n in (20, 48, 52, 62, 66):
        for _ in range(8):
            a = [f"w{rng.randrange(9000)}" for _ in range(n)]
            b = [w for i, w in enumerate(a) if i % 6]  # shorter by a sixth
            rows += [" ".join(a), " ".join(b)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in neardup.classes(docs).collect()}
    assert sum(got[i + 1] == got[i] == i for i in range(0, len(rows), 2)) >= 0.9 * len(rows) / 2
    assert len(set(got.values())) >= len(rows) / 2


def test_confident_needs_precision():
    margin, y = np.array([3.0, 2, 1, 0, -1, -2] * 20), np.array([1, 1, 1, 0, 0, 0] * 20)
    assert cotrain.confident(margin, y, 1, 0.95) == 1 and cotrain.confident(margin, y, 0, 0.95) == 0
    assert cotrain.confident(np.arange(120) % 5.0, np.array([1, 0] * 60), 1, 0.95) is None
