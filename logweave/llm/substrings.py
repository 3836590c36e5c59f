"""Substring dedup: words in repeated windows go, found by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document.  Its minimiser is the
least hash among its runs of ``MINIMISER`` words.  Consecutive windows that share
a minimiser overlap in all but a few words, so they travel as one packed string
(a piece) to the bucket of that minimiser: equal windows have equal minimisers,
hence meet.  A bucket numbers its words, sorts its windows by a hash of these
numbers, compares neighbours word by word and counts equal ones exactly.  The
stretches of words to remove go back to the chunks that sent the pieces.

Scale: a chunk holds about ``chunk_bytes`` of text (or one longer one) and sends
each distinct piece once, with the places where it starts, so copies of a
document cost a bucket one piece per chunk.  The pieces of a chunk for one
bucket are compressed together; in prose a piece has about 16 windows in 50
words, so about three times the text is shuffled.  Buckets hold about
``bucket_bytes`` of pieces; their number follows the input.  A minimiser with
more pieces than an average bucket (a passage that many documents share, with
other words around it) would fill its bucket: its windows travel alone, dealt
by a hash of the whole window.  There are fewer such minimisers than buckets, so
the list of them that is broadcast has at most 8 bytes per bucket.

Chunks follow the order of rows in the input's partitions, which must be the same
when read again (as of files); a checksum of the texts notices a difference and
fails the job.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.bpe import pack_words, packed, unpack_words, unpacked
from logweave.llm.common import spans, utf8, written

WINDOW = 35
MINIMISER = 5
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
#: Shuffled bytes of pieces per byte of text, for the number of buckets.
SPREAD = 3
#: Windows of one piece at most (texts of one repeated word have a single minimiser).
LONGEST = 256
ODD = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(32))) * ODD[3]
    x = (x ^ (x >> np.uint64(32))) * ODD[3]
    return x ^ (x >> np.uint64(32))


def rolled(own: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive numbers, put together from stretches of
    powers of two; empty where there are fewer."""
    out, done, part, width = None, 0, own, 1
    while width <= size:
        if size & width:
            out = part if out is None else out[: len(part) - done] * ODD[0] + part[done:]
            done += width
        part, width = mix(part[: max(0, len(part) - width)] * ODD[1] + part[width:] * ODD[2]), 2 * width
    return out[: max(0, len(own) - size + 1)]


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` consecutive numbers."""
    width = 1
    while 2 * width <= size:
        x, width = np.minimum(x[:-width], x[width:]), 2 * width
    return np.minimum(x[: len(x) - (size - width)], x[size - width :]) if size > width else x


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after the other, and how many each text has."""
    texts = pc.ascii_trim_whitespace(texts)
    texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), None, texts)
    lists = pc.ascii_split_whitespace(texts)
    return lists.flatten(), pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def numbers(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words as numbers, equal ones the same, and the distinct words."""
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.uint32), coded.dictionary


class Chunk:
    """The distinct pieces of a chunk of texts: ``pieces`` as (first word, words),
    the words at which each starts (``places``), its minimiser (``least``) and the
    hash that chooses its bucket (``chosen``)."""

    def __init__(self, texts: pa.Array, hot: np.ndarray, window: int):
        self.words, counts = split_words(texts)
        self.pieces, self.places = [], []
        self.least = self.chosen = np.empty(0, np.uint64)
        n = len(self.words) - window + 1
        if n <= 0:
            return
        own, distinct = numbers(self.words)
        hashed = mix(np.fromiter(map(zlib.crc32, distinct.cast(pa.binary()).to_pylist()), np.uint64, len(distinct)) + ODD[0])[own]
        least = sliding_min(mix(rolled(hashed, MINIMISER)), window - MINIMISER + 1)
        # A window starts where its text has as many words left.
        left = np.cumsum(counts)
        inside = np.repeat(left, counts)[:n] - np.arange(n) >= window
        alone = np.isin(least, hot) if len(hot) else np.zeros(n, bool)
        first = inside & np.concatenate([[True], ~inside[:-1] | (least[1:] != least[:-1])])
        # Longer pieces are cut after LONGEST windows; those of a hot minimiser after each.
        begin = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        first |= inside & (alone | ((np.arange(n) - begin) % LONGEST == 0))
        begin = np.flatnonzero(first)
        upto = np.cumsum(np.concatenate([[0], inside]))
        sizes = upto[np.concatenate([begin[1:], [n]])] - upto[begin] + window - 1
        found: dict[bytes, int] = {}
        for a, size in zip(begin.tolist(), sizes.tolist(), strict=True):
            k = found.setdefault(own[a : a + size].tobytes(), len(self.pieces))
            if k == len(self.pieces):
                self.pieces.append((a, size))
                self.places.append([a])
            else:
                self.places[k].append(a)
        heads = np.fromiter((a for a, _ in self.pieces), np.int64, len(self.pieces))
        self.least = least[heads]
        whole = rolled(hashed, window)[heads] if alone.any() else self.least
        self.chosen = mix(np.where(alone[heads], whole, self.least) + ODD[1])

    def joined(self) -> tuple[bytes, list[int]]:
        """All words joined by one space, and where each begins."""
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(self.words)], pa.int32()), self.words), " ")
        ends = np.cumsum(pc.binary_length(self.words).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        return text.cast(pa.binary())[0].as_py(), [0, *ends.tolist()]


def chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[tuple[int, int, list, pa.Array]]:
    """(chunk, checksum, ids, texts), numbered by the partition of the input."""
    chunk = TaskContext.get().partitionId() << 32
    for b in batches:
        ids, texts = b.column(0).to_pylist(), b.column(1)
        for i, j in spans(pc.binary_length(texts).fill_null(0).to_pylist(), chunk_bytes):
            check = zlib.crc32(repr(ids[i:j]).encode())
            for t in utf8(texts[i:j]):
                check = zlib.crc32(t, zlib.crc32(b"\0", check))
            yield chunk, check, ids[i:j], texts[i:j]
            chunk += 1


def batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], [name for name, _ in fields]
    )


def source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


LOADS = "minimiser bigint, n bigint"
#: Pieces that no bucket is too small for.
FEW = 16


def hot_minimisers(docs: DataFrame, n_buckets: int, chunk_bytes: int, window: int) -> np.ndarray:
    """Minimisers with more pieces than an average bucket: fewer than ``n_buckets``."""
    none = np.empty(0, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, texts in chunks(batches, chunk_bytes):
            least, n = np.unique(Chunk(texts, none, window).least, return_counts=True)
            own = pa.array(least.view(np.int64).tolist() + [None], pa.int64())  # null: all pieces of the chunk
            yield pa.RecordBatch.from_arrays([own, pa.array(np.append(n, n.sum()))], ["minimiser", "n"])

    loads = source(docs).mapInArrow(run, LOADS).groupBy("minimiser").agg(F.sum("n").alias("n"))
    many = written(loads.where((F.col("n") >= FEW) | F.col("minimiser").isNull()), "minimisers")
    total = many.where("minimiser is null").first()
    mean = (total.n if total else 0) / n_buckets
    many = many.where("minimiser is not null")
    return np.sort(np.array([r.minimiser for r in many.where(F.col("n") > mean).collect()], np.int64).view(np.uint64))


PIECES = "bucket int, chunk bigint, check bigint, words binary, sizes binary, copies binary, starts binary"


def sent(docs: DataFrame, hot: np.ndarray, n_buckets: int, chunk_bytes: int, window: int) -> DataFrame:
    """Each chunk's distinct pieces, packed by bucket, with their places."""
    known = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(3).compress
        for chunk, check, _, texts in chunks(batches, chunk_bytes):
            own = Chunk(texts, known.value, window)
            text, at = own.joined()
            bucket = (own.chosen % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            rows = []
            for some in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
                some = some.tolist()
                picked = [own.pieces[k] for k in some]
                copies = np.fromiter((len(own.places[k]) for k in some), np.int64, len(some))
                starts = np.fromiter((a for k in some for a in own.places[k]), np.int64, int(copies.sum()))
                sizes = np.fromiter((size for _, size in picked), np.int64, len(some))
                data = zip_(b"".join(text[at[a] : at[a + size]] for a, size in picked))
                rows.append((int(bucket[some[0]]), chunk, check, data, packed(sizes), packed(copies), packed(starts)))
            yield batch(PIECES, rows)

    return source(docs).mapInArrow(run, PIECES)


FOUND = "chunk bigint, check bigint, starts binary, sizes binary"


def repeated(own: np.ndarray, at: np.ndarray, weight: np.ndarray, window: int) -> np.ndarray:
    """Which of the windows that start at ``at`` occur more than once: sorted by a
    hash of their numbers, neighbours compared number by number."""
    hashes = rolled(mix(own.astype(np.uint64) + ODD[2]), window)[at]
    order = np.argsort(hashes, kind="stable")
    hashes, at = hashes[order], at[order]
    same = hashes[1:] == hashes[:-1]
    group = np.concatenate([[0], np.cumsum(~same)])
    pairs = np.flatnonzero(same)
    unlike = np.zeros(len(pairs), bool)
    for k in range(window):
        unlike |= own[at[pairs] + k] != own[at[pairs + 1] + k]
    total, extra = int(group[-1]) + 1, {}
    for g in np.unique(group[pairs[unlike]]).tolist():  # windows that differ in spite of equal hashes
        for i in np.flatnonzero(group == g).tolist():
            group[i] = extra.setdefault(own[at[i] : at[i] + window].tobytes(), total + len(extra))
    counts = np.bincount(group, weights=weight[order])
    out = np.empty(len(order), bool)
    out[order] = counts[group] > 1
    return out


def count_bucket(window: int):
    """All windows of one bucket: back to each chunk the stretches of words that
    repeated windows cover."""

    def run(rows: pa.Table) -> pa.Table:
        unzip = zstandard.ZstdDecompressor().decompress
        flat = numbers(split_words(pa.array([unzip(w.as_py()) for w in rows["words"]], pa.binary()).view(pa.string()))[0])[0]
        sizes, copies, starts = ([unpacked(k.as_py()) for k in rows[name]] for name in ("sizes", "copies", "starts"))
        size, copy = np.concatenate(sizes), np.concatenate(copies)
        begin = np.cumsum(size) - size
        piece = np.repeat(np.arange(len(size)), size - window + 1)
        at = np.arange(len(piece)) + (begin - (np.cumsum(size - window + 1) - (size - window + 1)))[piece]
        flag = np.zeros(len(flat) + 1, bool)
        flag[at] = repeated(flat, at, copy[piece], window)
        # Pieces end in words that start no window, so no stretch goes on into the next piece.
        edge = np.flatnonzero(flag != np.concatenate([[False], flag[:-1]]))
        first, last = edge[::2], edge[1::2]
        owner = np.searchsorted(begin, first, "right") - 1
        times = copy[owner]
        # Every place of a piece: its places follow one another.
        base = np.repeat((np.cumsum(copy) - copy)[owner] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
        place = np.concatenate(starts)[base] + np.repeat(first - begin[owner], times)
        length = np.repeat(last - first + window - 1, times)
        row_of_piece = np.repeat(np.arange(len(rows)), [len(s) for s in sizes])
        row = np.repeat(row_of_piece[owner], times)
        cut = np.searchsorted(row, np.arange(len(rows) + 1))
        full = [k for k in range(len(rows)) if cut[k + 1] > cut[k]]
        return pa.table({
            "chunk": rows["chunk"].take(pa.array(full, pa.int64())),
            "check": rows["check"].take(pa.array(full, pa.int64())),
            "starts": pa.array([packed(place[cut[k] : cut[k + 1]]) for k in full], pa.binary()),
            "sizes": pa.array([packed(length[cut[k] : cut[k + 1]]) for k in full], pa.binary()),
        })

    return run


TEXTS = "chunk bigint, check bigint, ids array<bigint>, texts binary"


def kept_texts(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """The texts of each chunk, compressed together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, check, ids, texts in chunks(batches, chunk_bytes):
            yield batch(TEXTS, [(chunk, check, ids, pack_words(list(utf8(texts))))])

    return source(docs).mapInArrow(run, TEXTS)


KEPT = "doc_id bigint, n_words bigint, n_removed bigint, text string"
DIGESTS = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


def as_text(kept: bytes) -> str:
    return kept.decode("utf-8", "replace")


def as_digest(kept: bytes) -> str:
    return hashlib.sha256(kept).hexdigest()


def dedup(
    docs: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES, finish=as_text, schema: str = KEPT
) -> DataFrame:
    """doc_id, n_words, n_removed and the text of the words that stay, joined by one
    space (or what ``finish`` makes of its bytes), of every document.

    Words are stretches without ASCII white space.  A word goes if it lies in a
    window whose words also start anywhere else, in the same document or another;
    all copies go.  Null and empty texts, and those under ``window`` words, lose
    nothing.  Null and repeated ids are documents of their own; other columns
    aren't read; an empty table gives no rows.
    """
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(8, math.ceil(SPREAD * total / bucket_bytes))
    hot = hot_minimisers(docs, n_buckets, chunk_bytes, window)
    pieces = sent(docs, hot, n_buckets, chunk_bytes, window)
    found = pieces.groupBy("bucket").applyInArrow(count_bucket(window), FOUND)
    name, kind = schema.split(", ")[-1].split()

    def run(_key: tuple, chunk: pa.Table, stretches: pa.Table) -> pa.Table:
        rows = []
        if set(stretches["check"].to_pylist()) - set(chunk["check"].to_pylist()):
            raise RuntimeError("the input changed between the passes")
        for ids, texts in zip(chunk["ids"].to_pylist(), chunk["texts"], strict=True):
            words = [t.split() for t in unpack_words(texts.as_py())]
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            depth = np.zeros(int(sizes.sum()) + 1, np.int64)
            for a, n in zip(stretches["starts"], stretches["sizes"], strict=True):
                start, size = unpacked(a.as_py()), unpacked(n.as_py())
                np.add.at(depth, start, 1)
                np.add.at(depth, start + size, -1)
            gone = np.cumsum(depth[:-1]) > 0
            ends = np.cumsum(sizes)
            for doc, own, a, b in zip(ids, words, (ends - sizes).tolist(), ends.tolist(), strict=True):
                mark = gone[a:b]
                lost = int(mark.sum())
                left = [w for w, off in zip(own, mark.tolist(), strict=True) if not off] if lost else own
                rows.append((doc, len(own), lost, finish(b" ".join(left))))
        return pa.Table.from_batches([batch(schema, rows)])

    return kept_texts(docs, chunk_bytes).groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(run, schema)


def digests(docs: DataFrame) -> DataFrame:
    """Counts and a checksum of the words that stay, for every document."""
    return dedup(docs, finish=as_digest, schema=DIGESTS)
