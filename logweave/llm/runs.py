"""Periodic runs in texts, by the branching-tandem test on an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q that is at least
``LEAST`` words and ``TIMES`` periods long and that no neighbouring word extends.

1. Words are numbered per document, and many documents form one array: words of
   different documents never are equal, so one suffix array serves all of them.
   It is built by doubling; only suffixes that still tie are sorted again.
2. The ranks of each doubling give the common prefixes (LCP) of neighbours.
3. Two suffixes i and i+d with exactly d common words are a square that can't be
   shifted right: a branching tandem.  Every LCP interval of depth d splits at
   its places of value d; at each, the suffixes i of the smaller side test
   whether the rank of i+d or i-d lies in the other side (Stoye and Gusfield's
   test, as intervals of the array: bounds come from the nearest smaller values,
   no tree is built).
4. Squares that end at the same word are rotated left as far as the period
   holds, least period first; multiples of a period inside its run are merged.

Scale: a text is worked on where it is read, in chunks of about ``CHUNK_BYTES``
(or one longer text), so nothing is shuffled.  Work is n log n of a chunk,
also for texts of one repeated word; memory is 4 bytes per word for each
doubling that its longest repeat needs, and about 100 bytes per word besides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import spans, utf8

LEAST, TIMES = 24, 3
CHUNK_BYTES = 1 << 20
#: Suffixes tested at a time.
BLOCK = 1 << 20
#: Rounds of pointer jumps before the few bounds left are walked one by one.
JUMPS = 24


def suffix_array(own: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Suffixes in order, the rank of each, and for each power of two the groups of
    suffixes that agree on so many numbers (named by their first rank; -1 at the end)."""
    n = len(own)
    order = np.argsort(own, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], own[order][1:] != own[order][:-1]]))
    rank = np.full(n + 1, -1, np.int64)
    rank[order] = np.repeat(first, np.diff(np.concatenate([first, [n]])))
    levels, length = [], 1
    size = np.repeat(np.diff(np.concatenate([first, [n]])), np.diff(np.concatenate([first, [n]])))
    open_ = order[size > 1]
    while len(open_):
        levels.append(rank.astype(np.int32))
        group = rank[open_]
        key = group * (n + 1) + rank[open_ + length] + 1
        by = np.argsort(key, kind="stable")
        open_, key, group = open_[by], key[by], group[by]
        at = np.arange(len(open_))
        old = np.concatenate([[True], group[1:] != group[:-1]])
        new = np.concatenate([[True], key[1:] != key[:-1]])
        head = np.maximum.accumulate(np.where(new, at, 0))
        rank[open_] = group + head - np.maximum.accumulate(np.where(old, at, 0))
        alone = new & np.concatenate([new[1:], [True]])
        open_ = open_[~alone]
        length *= 2
    order = np.empty(n, np.int64)
    order[rank[:n]] = np.arange(n)
    return order, rank, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """For each suffix in order, how many numbers it shares with the one before; 0
    for the first, and one more 0 at the end."""
    lcp = np.zeros(len(order) + 1, np.int64)
    if not levels:
        return lcp
    at = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    a, b = order[at - 1], order[at]
    got = np.zeros(len(at), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        got += (levels[k][a + got] == levels[k][b + got]).astype(np.int64) << k
    lcp[at] = got
    return lcp


def bounds(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the places ``at`` (of values above 0): the nearest place before with a value
    that isn't larger, and the nearest after with a smaller one."""
    out = []
    for step, over in ((-1, np.greater), (1, np.greater_equal)):
        near = np.arange(len(lcp)) + step
        active = at
        for _ in range(JUMPS):
            active = active[over(lcp[near[active]], lcp[active])]
            if not len(active):
                break
            near[active] = near[near[active]]
        active = active[over(lcp[near[active]], lcp[active])]
        for p in np.sort(active)[:: -step].tolist():
            q = int(near[p])
            while over(lcp[q], lcp[p]):
                q = int(near[q])
            near[p] = q
        out.append(near[at])
    return out[0], out[1]


def tandems(order: np.ndarray, rank: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All branching tandems (start, period): suffixes start and start + period share
    exactly ``period`` numbers."""
    n = len(order)
    at = np.flatnonzero(lcp[:n] > 0)
    if not len(at):
        return at, at
    low, high = bounds(lcp, at)
    depth = lcp[at]
    left = at - low <= high - at
    begin, size = np.where(left, low, at), np.where(left, at - low, high - at)
    other, stop = np.where(left, at, low), np.where(left, high, at)
    starts, periods = [], []
    total = np.cumsum(size)
    cut = 0
    while cut < len(at):
        done = total[cut - 1] if cut else 0
        upto = max(cut + 1, int(np.searchsorted(total, done + BLOCK, "right")))
        own = np.repeat(np.arange(cut, upto), size[cut:upto])
        i = order[begin[own] + np.arange(len(own)) - (total[own] - size[own] - done)]
        d = depth[own]
        for shift in (d, -d):
            j = i + shift
            inside = (j >= 0) & (j < n)
            there = rank[np.where(inside, j, n)]
            hit = np.flatnonzero((there >= other[own]) & (there < stop[own]))
            starts.append(np.minimum(i[hit], j[hit]))
            periods.append(d[hit])
        cut = upto
    return np.concatenate(starts), np.concatenate(periods)


def rotations(own: np.ndarray, start: int, period: int) -> int:
    """How often the square at ``start`` can be shifted left."""
    done, width = 0, 64
    while start > done:
        width = min(width, start - done)
        a = start - done - width
        unlike = np.flatnonzero(own[a : a + width] != own[a + period : a + period + width])
        if len(unlike):
            return done + width - 1 - int(unlike[-1])
        done, width = done + width, 2 * width
    return done


def find_runs(own: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of an array of numbers, in this order."""
    order, rank, levels = suffix_array(own)
    start, period = tandems(order, rank, common_prefixes(order, levels))
    # A square must go on to the left for a run's length.
    more = np.maximum(least, times * period) - 2 * period
    before = start - np.maximum(more, 0)
    fits = before >= 0
    fits[fits] = (own[before[fits]] == own[before[fits] + period[fits]])
    start, period = start[fits], period[fits]
    runs, known, end = [], [], -1
    for k in np.lexsort((period, start + 2 * period)).tolist():
        q = int(period[k])
        if int(start[k]) + 2 * q != end:
            known, end = [], int(start[k]) + 2 * q
        if any(q % p == 0 and 2 * q <= length for p, length in known):
            continue
        length = 2 * q + rotations(own, int(start[k]), q)
        known.append((q, length))
        if length >= max(least, times * q):
            runs.append((end - length, length, q))
    return sorted(runs)


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, list[int]]:
    """The words of many texts as numbers, others for each text, and where texts end."""
    own: list[int] = []
    ends, base = [], 0
    for words in texts:
        number: dict[bytes, int] = {}
        add = number.setdefault
        own += [add(w, base + len(number)) for w in words]
        base += len(number)
        ends.append(len(own))
    return np.array(own, np.int64), ends


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that any run holds after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, k in zip(words, np.cumsum(gone).tolist()) if k <= 0]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run with the greatest length / period; of equal ones that with the
    smallest start, then period."""

    def order(a: tuple, b: tuple) -> int:
        return b[1] * a[2] - a[1] * b[2] or (a[0] > b[0]) - (a[0] < b[0]) or a[2] - b[2]

    return min(runs, key=cmp_to_key(order))


Found = tuple[int | None, list[bytes], list[tuple[int, int, int]]]

RUNS = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, text string"


def as_runs(found: Iterator[Found]) -> pa.Table:
    """Rows of ``RUNS``; ``text`` holds the words that stay when runs collapse."""
    rows = [(doc, len(words), runs, b" ".join(collapsed(words, runs)).decode("utf-8", "replace")) for doc, words, runs in found]
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    names = ["start", "length", "period"]
    runs = [[dict(zip(names, r, strict=True)) for r in row[2]] for row in rows]
    return pa.table({
        "doc_id": pa.array([r[0] for r in rows], pa.int64()), "n_words": pa.array([r[1] for r in rows], pa.int64()),
        "runs": pa.array(runs, pa.list_(run)), "text": pa.array([r[3] for r in rows], pa.string()),
    })


DIGESTS = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
)


def as_digests(found: Iterator[Found]) -> pa.Table:
    """Rows of ``DIGESTS``: the strongest run, and checksums of all runs and of the
    words that stay."""
    rows = []
    for doc, words, runs in found:
        start, length, period = strongest(runs) if runs else (None, None, None)
        said = "".join(f"{a},{n},{q}\n" for a, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
        rows.append((
            doc, len(runs), start, length, period, 1000 * length // period if runs else None,
            hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest(),
        ))
    names = [f.split()[0] for f in DIGESTS.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.string()] * 2
    return pa.table({name: pa.array([r[k] for r in rows], kind) for k, (name, kind) in enumerate(zip(names, kinds, strict=True))})


def runs(
    docs: DataFrame,
    least: int = LEAST,
    times: int = TIMES,
    chunk_bytes: int = CHUNK_BYTES,
    change: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
    finish=as_runs,
    schema: str = RUNS,
) -> DataFrame:
    """doc_id, n_words, the runs (start, length, period, in words) and the collapsed
    text of every document, or what ``finish`` makes of (doc_id, words, runs).

    Words are stretches without ASCII white space; ``change`` may replace the words
    of a document first.  Null and empty texts have no words and no runs.  Null
    and repeated ids are documents of their own; other columns aren't read; an
    empty table gives no rows.
    """

    def chunk(ids: list, texts: list[bytes]) -> Iterator[Found]:
        words = [t.split() for t in texts]
        if change:
            words = [change(doc, w) for doc, w in zip(ids, words, strict=True)]
        own, ends = numbered(words)
        found: list[list] = [[] for _ in ids]
        begins = [0, *ends[:-1]]
        for start, length, period in find_runs(own, least, times):
            k = int(np.searchsorted(ends, start, "right"))
            found[k].append((start - begins[k], length, period))
        yield from zip(ids, words, found, strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(0).to_pylist(), list(utf8(b.column(1)))
            for i, j in spans(map(len, texts), chunk_bytes):
                yield from finish(chunk(ids[i:j], texts[i:j])).to_batches()

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, schema)
