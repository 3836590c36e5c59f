"""Rules, chat, BPE and packing against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from logweave.llm import bpe, chat, packing, quality_rules

DOCS = "doc_id bigint, text string, bucket string"
HARD = [
    None, "", " ", "a", "don't stop", "x" * 5000, "naïve café x　y\x1c\x85z", "a\n\n\nb  \t c ", "日本語 テキスト 123 ４５",
    "<|endoftext|> and <|endoftext|>", "🙂" * 300, "\\[INST] </s> <<SYS>> [/ROLE][:]", "same text", "same text",
]


def hard(spark, repeat=1):
    rows = [(i, t, "x") for i, t in enumerate(HARD * repeat)] + [(None, "no id", None), (3, "id again", "y")]
    return spark.createDataFrame(rows, DOCS).repartition(3), rows


# quality rules


def slow_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\t\x0b\x1c é#|", max_size=80))
def test_counts(text):
    c = quality_rules.counts_of(text.encode())
    assert tuple(c[k] for k in quality_rules.BASE) == slow_counts(text)


def test_repeats_with_many_distinct_words():
    at = np.array([0, 1, 2, 3, 0, 1, 2, 5])
    assert quality_rules.repeated_words(at, 6) == quality_rules.repeated_words(at, 1 << 22) == 6


def test_em_finds_each_kind_of_junk():
    rng = random.Random(1)

    def votes(kind):
        out = []
        for name in quality_rules.RULES:
            if name in quality_rules.VIRTUES:
                out.append(2 if rng.random() < 0.85 else 0)
            else:
                out.append(1 if rng.random() < (0.95 if name == kind else 0.004) else 0)
        return int("".join(map(str, out)), 3)

    kinds = [None] * 8000 + ["symbols"] * 700 + ["capitals"] * 300 + ["repeats"] * 500
    codes = [votes(k) for k in kinds]
    n = Counter(codes)
    unique = np.array(sorted(n))
    model = quality_rules.fit(unique, np.array([n[c] for c in unique]))
    p = dict(zip(unique.tolist(), quality_rules.posterior(model, unique), strict=True))
    kept = [p[c] >= 0.5 for c in codes]
    assert np.mean(kept[:8000]) > 0.98 and np.mean(kept[8000:]) < 0.1
    assert abs(model["prior"][0] - 8000 / 9500) < 0.03


def test_em_without_junk_keeps_all():
    n = len(quality_rules.RULES)
    clean = int("0" * (n - 3) + "222", 3)
    for counts in ({clean: 220_000, clean - 2: 30_000}, {clean: 500}, {clean: 10**7, clean - 2: 900, clean - 6: 80}):
        codes = np.array(sorted(counts))
        model = quality_rules.fit(codes, np.array([counts[c] for c in codes]))
        assert (quality_rules.posterior(model, codes) > 0.9).all()


def test_rules_score_and_filter(spark):
    good = " ".join(f"word{i}" for i in range(120))
    junk = " ".join(f"word{i}$$$" for i in range(120))
    rows = [(i, good + f" tail{i}", "b") for i in range(60)] + [(100 + i, junk + str(i), "b") for i in range(10)]
    rows += [(200, None, None), (201, "", "b"), (None, good, None), (0, good + " tail0", "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, kept string")
    out = quality_rules.score(docs).collect()
    assert len(out) == len(rows)
    assert {r.doc_id for r in out if r.kept} == {*range(60), None}
    assert all(r.base_failed and not r.kept for r in out if r.doc_id in (200, 201))
    left = quality_rules.keep_good(docs)
    assert left.columns == docs.columns and left.count() == 62
    assert quality_rules.score(docs.limit(0)).count() == 0 and quality_rules.keep_good(docs.limit(0)).count() == 0


# chat


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["\\", "<", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "s>", "[:]", "[", "[ROLE]", "a", "\n"]), max_size=12))
def test_escape_is_reversible(parts):
    t, text = chat.Template(), "".join(parts)
    escaped = t.escape(text)
    assert t.unescape(escaped) == text and not t._mark.search(escaped)
    for role in ("user", "assistant", "tool", text):
        reader = chat.Reader(t)
        got = [x for piece, _ in t.segments(role, text) for x in reader.feed(piece)]
        assert got == [(role, text)] and not reader.buffer


def test_template_that_cannot_be_parsed_is_refused():
    spec = {"roles": {"user": {"open": "[U]", "close": "</u>", "loss": False}, "*": {"open": "<r<", "name_end": "<n>", "close": "<", "loss": False}}, "turns": {}, "end": ()}
    with pytest.raises(ValueError):
        chat.Template(spec)


def test_conversations(spark):
    turns = [
        (1, 0, "system", "be brief"), (1, 1, "user", "a [INST] b"), (1, 2, "assistant", "c </s>"),
        (2, 0, "assistant", "too early"), (3, 0, "user", None), (3, 1, "assistant", ""), (None, 0, "user", "x"), (None, 1, None, "y"),
        (4, 1, "user", "twice"), (4, 1, "user", "twice"),
    ]
    turns += [(5, k, ("user", "assistant")[k % 2], f"turn {k} \\ <s>") for k in range(2000)]
    df = spark.createDataFrame([(*t, "z") for t in turns], "conv_id bigint, turn bigint, role string, text string, segment string")
    out = {r.conv_id: r for r in chat.read_back(chat.format_turns(df.repartition(7))).collect()}
    assert set(out) == {1, 2, 3, 4, 5, None}
    for conv, r in out.items():
        own = [t for t in turns if t[0] == conv]
        said = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in own)
        loss = "".join(t[3] or "" for t in own if t[2] == "assistant")
        assert r.n_turns == len(own) and r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert r.loss_chars == len(loss) and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert {c: r.valid for c, r in out.items()} == {1: True, 2: False, 3: True, 4: False, 5: True, None: False}
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


# BPE


def reference_encoding():
    import tiktoken

    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(bpe.RANKS), special_tokens={})


@pytest.mark.parametrize("chunk_bytes", [1, 4 << 20])
def test_encode_and_decode(spark, chunk_bytes):
    docs, rows = hard(spark)
    enc = reference_encoding()
    got = sorted((r.doc_id is None, r.doc_id or 0, bytes(r.ids)) for r in bpe.encode(docs, chunk_bytes=chunk_bytes, bucket_bytes=100).collect())
    want = sorted((i is None, i or 0, np.array(enc.encode_ordinary(t or ""), "<u4").tobytes()) for i, t, _ in rows)
    assert got == want
    back = sorted((r.doc_id is None, r.doc_id or 0, bytes(r.bytes)) for r in bpe.decode(bpe.encode(docs)).collect())
    assert back == sorted((i is None, i or 0, (t or "").encode()) for i, t, _ in rows)


def test_bpe_digests(spark):
    docs, rows = hard(spark, repeat=3)
    enc = reference_encoding()
    out = bpe.digests(docs).collect()
    assert len(out) == len(rows)
    want = Counter((i, len(ids := enc.encode_ordinary(t or "")), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()) for i, t, _ in rows)
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in out) == want
    assert bpe.digests(docs.limit(0)).count() == 0


# packing


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for x in sorted(lengths, reverse=True):
        fits = [(g, i) for i, g in enumerate(gaps) if g >= x]
        if fits:
            g, i = min(fits)
            gaps[i] -= x
        else:
            gaps.append(capacity - x)
    return len(gaps)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80))
def test_supersteps_equal_best_fit(lengths):
    runs, rank = [], 0
    for x, n in sorted(Counter(lengths).items(), reverse=True):
        cut = n // 2  # a length may span partitions
        runs += [(x, rank, cut), (x, rank + cut, n - cut)] if cut else [(x, rank, n)]
        rank += n
    placed = packing.supersteps(runs, 30)
    used = {}
    for first, count, per, sequence, offset, length in placed.tolist():
        for k in range(count):
            used.setdefault(sequence + k // per, []).append((offset + k % per * length, length))
    assert sum(p[1] for p in placed.tolist()) == len(lengths)
    for spots in used.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 30
    assert len(used) == best_fit_decreasing(lengths, 30)


@pytest.mark.parametrize("n,want", [(1, [(0, 1)]), (4, [(0, 4)]), (5, [(0, 1), (1, 4)]), (8, [(0, 4), (4, 4)]), (11, [(0, 3), (3, 4), (7, 4)])])
def test_cut(n, want):
    assert packing.cut(n, 4) == want


def test_pack_documents(spark):
    from tokenizers import Tokenizer

    docs, rows = hard(spark, repeat=4)
    out = packing.pack_documents(docs, capacity=64, keep_ids=True).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, t, _ in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        for k, (start, length) in enumerate(packing.cut(len(ids), 64)):
            want[(i, k, start, length, zlib.crc32(ids[start : start + length].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    filled = {}
    for r in out:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spots in filled.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 64
    assert len(filled) == best_fit_decreasing([r.length for r in out], 64)
    whole = packing.sequences(spark.createDataFrame(out)).collect()
    assert sorted(len(r.ids) for r in whole) == sorted(sum(x[1] for x in s) for s in filled.values())
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_one_length_for_all(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "'a b' as text")
    out = packing.pack_documents(docs).groupBy("sequence_id").count().collect()
    assert len(out) == -(-5000 * 3 // 2046) and max(r["count"] for r in out) == 2048 // 3


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 1_500_000, "\u3000" * 1_000_000, "a b" * 100_000 + " " * 1_100_000 + "<|endoftext|>x\n \n  y"])
def test_long_white_space(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packing.encoder(packing.VOCABULARY)(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_pack_long_white_space(spark):
    docs = spark.createDataFrame([(1, " " * 1_200_000), (2, "x")], "doc_id bigint, text string")
    got = packing.pack_documents(docs).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("length").alias("most")).collect()
    assert {r.doc_id: r.n for r in got} == {1: 1_200_001, 2: 2} and max(r.most for r in got) == 2048


def test_bpe_decoded_digest(spark):
    rows = [(i, t) for i, t in enumerate(["", None, "plain words", "  \n\t x", "é 日本 \U0001f600 naïve", "a" * 5000, "1234 <|endoftext|> 5"])]
    got = {r.doc_id: r.decoded_sha256 for r in bpe.digests(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in rows}
