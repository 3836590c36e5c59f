"""Byte-level BPE through a global shuffle of distinct words, and decoding.

1. Chunks of documents are split into pre-tokens (``PATTERN``).  A chunk keeps
   its documents as positions: for each pre-token the number of its word among
   the chunk's distinct words, or a mark where a word comes for the first time.
2. The distinct words of each chunk are shuffled by a hash of the word; every
   bucket of words encodes each distinct word once.
3. Ids go back to the chunks that sent the word, which reassemble their
   documents by position.
Decoding looks every id up in the token-byte table (bounded by the vocabulary,
hence broadcast) and joins the bytes.

Scale: a very frequent word is sent once per chunk, not once per occurrence,
so no bucket is hot; words travel packed, many to a row, in rows bounded by
the chunk.  A chunk holds about ``chunk_bytes`` of text (or one longer one).
The number of buckets follows the input.  Chunks follow the order of rows in the
input's partitions, which must be the same when read again (as of files); a
difference is noticed and fails the job.
"""

from __future__ import annotations

import base64
import hashlib
import math
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import spans, strings, utf8

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20


@lru_cache(2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(1)
def splitter():
    import regex

    return regex.compile(public_tokenizers.PATTERN).findall


def packed(values: np.ndarray) -> bytes:
    """Numbers below 2 ** 32, compressed byte by byte of equal weight."""
    return zstandard.compress(np.ascontiguousarray(values.astype("<u4").view("u1").reshape(-1, 4).T).tobytes(), 6)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), "u1").reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def pack_words(words: list[bytes]) -> bytes:
    """Words with their lengths, compressed together."""
    sizes = np.fromiter(map(len, words), "<u4", len(words))
    return zstandard.compress(len(words).to_bytes(4, "little") + sizes.tobytes() + b"".join(words), 3)


def unpack_words(data: bytes) -> list[bytes]:
    data = zstandard.decompress(data)
    n = int.from_bytes(data[:4], "little")
    ends = 4 + 4 * n + np.cumsum(np.frombuffer(data, "<u4", n, 4), dtype=np.int64)
    return [data[a:b] for a, b in zip([4 + 4 * n, *ends[:-1].tolist()], ends.tolist(), strict=True)]


#: kind 0: a chunk's documents (ids, sizes, positions); kind 1: its words of one bucket.
SPLIT = "kind int, chunk bigint, bucket int, ids array<bigint>, words binary, positions binary"
SPLIT_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary()]


def split_chunk(chunk: int, ids: list, texts: list[str], n_buckets: int) -> list[tuple]:
    """One chunk's rows of ``SPLIT``.  Words are numbered as they first occur, so
    that a first occurrence needs no number (0) and a later one is its number
    plus 1: most distinct words occur once."""
    number: dict[str, int] = {}
    add, find = number.setdefault, splitter()
    at = [[add(w, len(number)) for w in find(t)] for t in texts]
    sizes = np.fromiter(map(len, at), np.int64, len(at))
    flat = np.fromiter((k for a in at for k in a), np.int64, int(sizes.sum()))
    del at
    known = np.concatenate([[-1], np.maximum.accumulate(flat)[:-1]]) if len(flat) else flat
    rows = [(0, chunk, None, ids, packed(sizes), packed(np.where(flat > known, 0, flat + 1)))]
    words = [w.encode("utf-8", "surrogatepass") for w in number]
    bucket = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words)) % n_buckets
    order = np.argsort(bucket, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
        data = pack_words([words[i] for i in own.tolist()])
        rows.append((1, chunk, int(bucket[own[0]]), None, data, packed(np.diff(own, prepend=0))))
    return rows


def split(docs: DataFrame, n_buckets: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Pass 1: documents as positions, and each chunk's distinct words by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for b in batches:
            ids, texts = b.column(0).to_pylist(), list(strings(b.column(1)))
            for i, j in spans(map(len, texts), chunk_bytes):
                rows = split_chunk(chunk, ids[i:j], texts[i:j], n_buckets)
                chunk += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), SPLIT_TYPES, strict=True)],
                    [f.split()[0] for f in SPLIT.split(", ")],
                )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, SPLIT)


def encode_bucket(ranks_path: str):
    """All words of one bucket, each distinct one encoded once."""

    def run(rows: pa.Table) -> pa.Table:
        encode = word_encoder(ranks_path)
        known: dict[bytes, bytes] = {}
        sizes, ids = [], []
        for data in rows["words"]:
            own = unpack_words(data.as_py())
            for w in own:
                if w not in known:
                    known[w] = encode(w)
            got = [known[w] for w in own]
            sizes.append(packed(np.fromiter(map(len, got), np.int64, len(got)) // 4))
            ids.append(packed(np.frombuffer(b"".join(got), "<u4")))
        return pa.table(
            {"chunk": rows["chunk"].combine_chunks(), "positions": rows["positions"].combine_chunks()}
            | {"sizes": pa.array(sizes, pa.binary()), "ids": pa.array(ids, pa.binary())}
        )

    return run


def word_encoder(ranks_path: str):
    """Bytes of one pre-token to its ids (as 32-bit numbers), by the ranks."""
    import tiktoken

    ranks = load_ranks(ranks_path)
    one = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    single = one._core_bpe.encode_single_piece
    return lambda w: array("I", [ranks[w]] if w in ranks else single(w)).tobytes()


def reassemble(docs: pa.Table, words: pa.Table) -> Iterator[tuple[int | None, np.ndarray]]:
    """One chunk's documents as ids: the words' ids, taken by position."""
    parts = [tuple(unpacked(words[c][k].as_py()) for c in ("positions", "sizes", "ids")) for k in range(len(words))]
    n_words = sum(len(p[0]) for p in parts)
    size, start, base = np.zeros(n_words, np.int64), np.zeros(n_words, np.int64), 0
    for steps, sizes, ids in parts:
        numbers = np.cumsum(steps)
        size[numbers] = sizes
        start[numbers] = base + np.cumsum(sizes) - sizes
        base += len(ids)
    table = np.concatenate([p[2] for p in parts]).astype("<u4") if parts else np.empty(0, "<u4")
    del parts
    for data, sizes, ids in zip(docs["positions"], docs["words"], docs["ids"], strict=True):
        at = unpacked(data.as_py())
        first = at == 0
        if np.count_nonzero(first) != n_words:
            raise RuntimeError("the input changed between the passes")
        at = np.where(first, np.cumsum(first) - 1, at - 1)
        ends = np.cumsum(unpacked(sizes.as_py())).tolist()
        for doc, a, b in zip(ids.as_py(), [0, *ends[:-1]], ends, strict=True):
            own = at[a:b]
            n = size[own]
            yield doc, table[np.repeat(start[own] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]


ENCODED = "doc_id bigint, ids binary"


def as_ids(_ranks_path: str):
    """Rows of ``ENCODED``."""

    def finish(found: Iterator[tuple[int | None, np.ndarray]]) -> pa.Table:
        rows = [(doc, ids.tobytes()) for doc, ids in found]
        return pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "ids": pa.array([r[1] for r in rows], pa.binary())})

    return finish


DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def as_digests(ranks_path: str):
    """Rows of ``DIGESTS``: the ids, and the bytes that they decode to."""

    def finish(found: Iterator[tuple[int | None, np.ndarray]]) -> pa.Table:
        table = token_bytes(ranks_path)
        token, decimal = table.__getitem__, decimals(len(table)).__getitem__
        rows = []
        for doc, ids in found:
            ids = ids.tolist()
            said = hashlib.sha256(b" ".join(map(decimal, ids))).hexdigest()
            rows.append((doc, len(ids), said, hashlib.sha256(b"".join(map(token, ids))).hexdigest()))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = [f.split()[0] for f in DIGESTS.split(", ")]
        return pa.table({name: pa.array([r[k] for r in rows], kind) for k, (name, kind) in enumerate(zip(names, kinds, strict=True))})

    return finish


def encode(
    docs: DataFrame,
    ranks_path: str = RANKS,
    chunk_bytes: int = CHUNK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    finish=as_ids,
    schema: str = ENCODED,
) -> DataFrame:
    """doc_id and ids (binary: unsigned 32-bit, little-endian) of every document,
    or what ``finish`` makes of a chunk's (doc_id, ids).

    Null and empty texts have no ids.  Null and repeated ids keep their rows;
    other columns aren't read; an empty table gives no rows.
    """
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    # Read twice, for its words and for its positions: splitting a file split again
    # costs less than keeping both on disk, and gives the same chunks.
    parts = split(docs, max(8, math.ceil(total / bucket_bytes)), chunk_bytes)
    words = parts.where("kind = 1").select("bucket", "chunk", "words", "positions")
    ids = words.groupBy("bucket").applyInArrow(encode_bucket(ranks_path), "chunk bigint, positions binary, sizes binary, ids binary")
    places = parts.where("kind = 0").select("chunk", "ids", "words", "positions")

    def run(_key: tuple, chunk: pa.Table, found: pa.Table) -> pa.Table:
        return finish(ranks_path)(reassemble(chunk, found))

    return places.groupBy("chunk").cogroup(ids.groupBy("chunk")).applyInArrow(run, schema)


@lru_cache(2)
def token_bytes(ranks_path: str = RANKS) -> list[bytes]:
    """The token-byte table: bytes by id."""
    ranks = load_ranks(ranks_path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, k in ranks.items():
        table[k] = token
    return table


@lru_cache(1)
def decimals(n: int) -> list[bytes]:
    return [str(k).encode() for k in range(n)]


def decode(encoded: DataFrame, ranks_path: str = RANKS) -> DataFrame:
    """doc_id and bytes of every row of ``encode``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = token_bytes(ranks_path).__getitem__
        for b in batches:
            out = [b"".join(map(token, np.frombuffer(x, "<u4").tolist())) for x in utf8(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, bytes binary")


def digests(docs: DataFrame, ranks_path: str = RANKS) -> DataFrame:
    """Every document encoded, then decoded from its ids: counts and checksums."""
    return encode(docs, ranks_path, finish=as_digests, schema=DIGESTS)
