"""Weak supervision: rules vote or abstain, EM weighs them, the posterior decides.

Every rule reads a document's counts and votes good (2), bad (1) or abstains
(0).  No rule has the last word: expectation-maximisation over *all* documents
estimates how often each rule errs, and a document stays if its posterior
probability of being good reaches ``keep_at``.

Scale: a vote pattern is one integer below ``3 ** len(RULES)``, so the corpus
is summed up by a count per pattern (map-side combined, at most that many
rows), EM runs on those counts and the posterior by pattern (the same bound)
travels back to the tasks that score the documents.  Nothing is joined and no
text is shuffled; the two passes compute the same row-local votes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import utf8

MIN_WORDS, REPEAT_PERCENT = 50, 50
SYMBOLS = list(b"#*$%&|<>")
SPACES = b" \t\n\v\f\r"
UPPER = slice(ord("A"), ord("Z") + 1)
LOWER = slice(ord("a"), ord("z") + 1)
CONTINUED = slice(0x80, 0xC0)  # bytes inside a code point
KEEP_AT = 0.5
#: At most this share of the good documents shows any one symptom.  Without such
#: a limit two kinds of junk can make one kind a habit of "good" documents.
FALSE_ALARMS = 0.005
#: At least this share of them lacks any one virtue: no single abstention condemns.
LACKS = 0.1
#: A kind of junk shows its symptom in at least this share of its documents, and
#: has no virtue more often than good documents: else a junk class could take
#: over clean documents where there is no junk to explain.
SHOWS = 0.9


def counts_of(text: bytes) -> dict[str, int]:
    """Counts of one whole text (UTF-8).

    ``bytes.split()`` splits at exactly the six ASCII spaces, so its parts are
    the words ``[^\\x20\\x09-\\x0D]+``.
    """
    words = text.split()
    n = len(words)
    ids: dict[bytes, int] = {}
    add = ids.setdefault
    at = np.fromiter([add(w, len(ids)) for w in words], np.int64, n)
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper = int(seen[UPPER].sum())
    return {
        "n_words": n,
        "word_chars": len(text) - int(seen[list(SPACES)].sum() + seen[CONTINUED].sum()),
        "n_symbols": int(seen[SYMBOLS].sum()),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated_words(at, len(ids)),
        "n_lines": len(lines),
        "n_distinct": len(ids),
        "n_upper": upper,
        "n_letters": upper + int(seen[LOWER].sum()),
    }


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(at: np.ndarray, n_distinct: int) -> int:
    """Words inside a 3-word window whose words occur twice or more in the text."""
    if len(at) < 4:
        return 0
    pairs = at[:-1] * n_distinct + at[1:]
    if n_distinct >= 1 << 21:  # the third power passes 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * n_distinct + at[2:]
    ordered = np.sort(windows)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    _, which, seen = np.unique(windows, return_inverse=True, return_counts=True)
    twice = seen[which] > 1
    inside = np.zeros(len(at), bool)
    for k in range(3):
        inside[k : len(at) - 2 + k] |= twice
    return int(inside.sum())


def base_failed(c: dict[str, int]) -> bool:
    return c["n_words"] < MIN_WORDS or 100 * c["n_repeat_words"] > REPEAT_PERCENT * c["n_words"]


def symptom(part: str, whole: str, from_share: float):
    """Bad from a share on; a document without the symptom gets no vote."""
    return lambda c: 1 if c[part] >= from_share * max(1, c[whole]) else 0


def virtue(part: str, whole: str, to_share: float):
    """Good up to a share; more of it is no vote."""
    return lambda c: 2 if c["n_words"] and c[part] <= to_share * max(1, c[whole]) else 0


def word_length(c: dict[str, int]) -> int:
    return 0 if 3 <= c["word_chars"] / max(1, c["n_words"]) <= 12 else 1


def variety(c: dict[str, int]) -> int:
    """Few distinct words, against the root of the length, which long texts reach anyway."""
    return 1 if c["n_distinct"] < 2 * c["n_words"] ** 0.5 else 0


#: Each rule votes one way or abstains: a symptom's absence says little.
RULES = {
    "symbols": symptom("n_symbols", "n_words", 0.2),
    "dup_lines": symptom("n_dup_lines", "n_lines", 0.5),
    "repeats": symptom("n_repeat_words", "n_words", 0.4),
    "capitals": symptom("n_upper", "n_letters", 0.5),
    "word_length": word_length,
    "variety": variety,
    "plain": virtue("n_symbols", "n_words", 0.05),
    "fresh": virtue("n_repeat_words", "n_words", 0.1),
    "long": lambda c: 2 if c["n_words"] >= 2 * MIN_WORDS else 0,
}
VIRTUES = ("plain", "fresh", "long")


def pattern(c: dict[str, int]) -> int:
    """The votes of all rules as the digits of one number to base 3."""
    code = 0
    for rule in RULES.values():
        code = 3 * code + rule(c)
    return code


def votes(code: np.ndarray) -> np.ndarray:
    """Inverse of :func:`pattern`: a row of votes for each code."""
    digits = [code // 3**k % 3 for k in range(len(RULES))]
    return np.stack(digits[::-1], axis=1)


def fit(codes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> dict:
    """EM over vote patterns: how likely each vote (also none) of each rule is for
    good documents and for each kind of junk.

    Junk comes in kinds that don't show each other's symptoms, so there is a
    latent class per symptom, started with that symptom in 90 % of its documents
    and the others in 20 %; good documents start at 1 % and are 85 % of all.
    Class 0 is good and stays it by the limits above.
    """
    v = votes(codes)
    alarm = np.array([name not in VIRTUES for name in RULES])
    one_hot = np.stack([v == k for k in range(3)], axis=2).astype(float)
    kinds = np.flatnonzero(alarm)
    prior = np.array([0.85, *[0.15 / len(kinds)] * len(kinds)])
    rate = np.empty((len(prior), len(RULES), 3))
    for c in range(len(prior)):
        for r in range(len(RULES)):
            share = (0.01 if c == 0 else 0.9 if r == kinds[c - 1] else 0.2) if alarm[r] else 0.8 if c == 0 else 0.6
            rate[c, r] = (1 - share, share, 1e-3) if alarm[r] else (1 - share, 1e-3, share)
    rate /= rate.sum(axis=2, keepdims=True)
    weight = counts.astype(float)
    for _ in range(rounds):
        share = class_shares(prior, rate, one_hot)
        seen = np.einsum("n,nc,nrk->crk", weight, share, one_hot) + 0.5
        rate = seen / seen.sum(axis=2, keepdims=True)
        rate[0, alarm, 1] = np.minimum(rate[0, alarm, 1], FALSE_ALARMS)
        rate[0, ~alarm, 2] = np.minimum(rate[0, ~alarm, 2], 1 - LACKS)
        own = np.arange(1, len(prior))
        rate[own, kinds, 1] = np.maximum(rate[own, kinds, 1], SHOWS)
        rate[own, kinds, 2] = np.minimum(rate[own, kinds, 2], (1 - SHOWS) / 2)
        rate[1:, ~alarm, 2] = np.minimum(rate[1:, ~alarm, 2], rate[:1, ~alarm, 2])
        rate[:, :, 0] = np.maximum(1 - rate[:, :, 1:].sum(axis=2), 1e-9)
        prior = (weight @ share + 1) / (weight.sum() + len(prior))
    return {"prior": prior, "rate": rate}


def class_shares(prior: np.ndarray, rate: np.ndarray, one_hot: np.ndarray) -> np.ndarray:
    """Posterior of each class, by pattern."""
    log = np.log(prior) + np.einsum("nrk,crk->nc", one_hot, np.log(rate))
    share = np.exp(log - log.max(axis=1, keepdims=True))
    return share / share.sum(axis=1, keepdims=True)


def posterior(model: dict, codes: np.ndarray) -> np.ndarray:
    """P(good) of each vote pattern."""
    v = votes(codes)
    one_hot = np.stack([v == k for k in range(3)], axis=2).astype(float)
    return class_shares(model["prior"], model["rate"], one_hot)[:, 0]


def pattern_counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All documents by vote pattern: at most ``3 ** len(RULES)`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = [pattern(counts_of(t)) for t in utf8(b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int32())], ["code"])

    found = docs.select("text").mapInArrow(run, "code int").groupBy("code").agg(F.count("*").alias("n")).collect()
    found.sort()
    return np.array([r[0] for r in found], np.int64), np.array([r[1] for r in found], np.int64)


def learn(docs: DataFrame, keep_at: float = KEEP_AT) -> tuple[dict[int, float], float]:
    """Posterior by vote pattern, from all documents.  An empty table gives none."""
    codes, counts = pattern_counts(docs)
    if not len(codes):
        return {}, keep_at
    return dict(zip(codes.tolist(), posterior(fit(codes, counts), codes).tolist(), strict=True)), keep_at


def judge(text: bytes, known: dict[int, float], keep_at: float) -> tuple[dict[str, int], float, bool, bool]:
    c = counts_of(text)
    p = known.get(pattern(c), 0.0)
    failed = base_failed(c)
    return c, p, failed, not failed and p >= keep_at


def score(docs: DataFrame, keep_at: float = KEEP_AT) -> DataFrame:
    """One row per document: its counts, posterior, ``base_failed`` and ``kept``.

    Null and empty texts have no words, hence fail the base.  Repeated rows and
    null ids each keep their row; other columns are not read.
    """
    known, keep_at = learn(docs, keep_at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [judge(t, known, keep_at) for t in utf8(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([r[0][k] for r in rows], pa.int64()) for k in BASE)]
                + [pa.array([r[1] for r in rows], pa.float64())]
                + [pa.array([r[k] for r in rows], pa.bool_()) for k in (2, 3)],
                ["doc_id", *BASE, "p_good", "base_failed", "kept"],
            )

    schema = "doc_id bigint, " + ", ".join(f"{k} bigint" for k in BASE)
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, f"{schema}, p_good double, base_failed boolean, kept boolean"
    )


def keep_good(docs: DataFrame, keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns as they are."""
    known, keep_at = learn(docs, keep_at)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([judge(t, known, keep_at)[3] for t in utf8(b.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
