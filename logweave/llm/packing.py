"""Bulk-synchronous best-fit packing of token sequences.

1. Documents are tokenised in tasks and cut into pieces of ``capacity`` tokens
   at most (table of pieces, written once).
2. Pieces are range-sorted by falling length (and id, so that a length that a
   third of all rows share spreads over many tasks); a piece's place in that
   order is its rank.
3. Supersteps, one per distinct length, longest first: all pieces of the
   length, in bulk, sweep to their successor gaps (the narrowest that hold
   them); conflicts for gaps are resolved by rank (lower ranks get the lower
   sequences); gaps are updated, and the next length follows.  Pieces that no
   gap holds open new sequences, so the outcome is that of best-fit-decreasing.
4. Every piece finds its placement by its rank, in its own task.

Scale: pieces of one length are interchangeable, and so are gaps of one width,
so both sorted lists are kept as runs (first rank, count).  A superstep works
on runs: there are at most ``capacity`` lengths plus one run per partition
that a length spans, and a sequence holds few distinct lengths (63 of 2048), so
the runs and the placements made from them are bounded by the capacity and
the number of partitions, not by the documents.  Only they pass the driver.
"""

from __future__ import annotations

import heapq
import re
import zlib
from bisect import insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.bpe import load_ranks, splitter, word_encoder
from logweave.llm.common import strings, written

CAPACITY = 2048
END = 0
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
SPECIAL = {"<|endoftext|>": 50256}
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


#: From so many characters on a text is split here: the library's splitter gives up
#: on a run of about a million white-space characters.
LONG = 200_000


def encoder(vocabulary: str):
    """Text to ids by the byte-level BPE of ``byte_bpe_50k.json``, through its rank
    file: the same vocabulary and ids as the ``tokenizers`` library gives (tests
    compare them), its special token included, at several times the speed."""
    import tiktoken

    ranks = load_ranks(vocabulary)
    whole = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    piece, special = word_encoder(vocabulary), re.compile("(" + "|".join(map(re.escape, SPECIAL)) + ")")

    def encode(text: str) -> np.ndarray:
        if len(text) < LONG:
            return np.array(whole.encode(text, allowed_special="all"), "<u4")
        known: dict[str, bytes] = {}
        out = []
        for part in special.split(text):
            if part in SPECIAL:
                out.append(SPECIAL[part].to_bytes(4, "little"))
                continue
            for word in splitter()(part):
                if word not in known:
                    known[word] = piece(word.encode("utf-8", "surrogatepass"))
                out.append(known[word])
        return np.frombuffer(b"".join(out), "<u4")

    return encode


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: all full but the first."""
    starts = [0, *range(n % capacity or capacity, n, capacity)]
    return list(zip(starts, np.diff([*starts, n]).tolist(), strict=True))


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, if kept) of every piece.

    A null or empty text is the end token alone.  Null and repeated ids are
    documents of their own; other columns aren't read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for b in batches:
            ids, text_column = b.column(0).to_pylist(), b.column(1)
            rows: list[tuple] = []
            for doc, text in zip(ids, strings(text_column), strict=True):
                own = np.append(encode(text), np.array([END], "<u4"))
                for k, (start, length) in enumerate(cut(len(own), capacity)):
                    part = own[start : start + length]
                    rows.append((doc, k, start, length, zlib.crc32(part.tobytes()), part if keep_ids else None))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)][: 5 + keep_ids],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + keep_ids],
            )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, PIECES + ", ids array<bigint>" * keep_ids
    )


class Gaps:
    """Open gaps as runs (first sequence, count) by width."""

    def __init__(self) -> None:
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.widths: list[int] = []

    def add(self, width: int, first: int, count: int) -> None:
        if width <= 0 or count <= 0:
            return
        if not self.runs[width]:
            insort(self.widths, width)
        heapq.heappush(self.runs[width], (first, count))

    def successor(self, length: int) -> tuple[int, int, int] | None:
        """The lowest run of the narrowest gaps that hold ``length``; taken out."""
        from bisect import bisect_left

        k = bisect_left(self.widths, length)
        if k == len(self.widths):
            return None
        width = self.widths[k]
        first, count = heapq.heappop(self.runs[width])
        if not self.runs[width]:
            self.widths.pop(k)
        return width, first, count


def supersteps(runs: list[tuple[int, int, int]], capacity: int) -> np.ndarray:
    """Placements from document runs (length, first rank, count).

    A placement (first rank, count, per sequence, first sequence, offset,
    length) puts ``per sequence`` consecutive ranks into each sequence from
    ``first sequence`` on, the first of them at ``offset``.
    """
    gaps, made, opened = Gaps(), [], 0
    for length, rank, left in sorted(runs, key=lambda r: (-r[0], r[1])):
        while left:
            found = gaps.successor(length)
            if found is None:  # nothing holds them: the rest opens new sequences
                found = capacity, opened, -(-left // (capacity // length))
                opened += found[2]
            width, first, count = found
            per = width // length
            full = min(count, left // per)
            if full:
                made.append((rank, full * per, per, first, capacity - width, length))
                gaps.add(width - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            if full < count:
                if left:  # fewer than one gap takes
                    made.append((rank, left, left, first + full, capacity - width, length))
                    gaps.add(width - left * length, first + full, 1)
                    rank, left, full = rank + left, 0, full + 1
                gaps.add(width, first + full, count - full)
    return np.array(made, np.int64).reshape(-1, 6)


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to a table of pieces (column ``length``, from 1
    to ``capacity``); other columns are carried.  Empty tables give no rows."""
    names = parts.columns
    rank = "__rank"
    while rank in names:
        rank += "_"
    parts = written(parts, "pieces")
    order = [F.col("length").desc(), *[F.col(c) for c in ("doc_id", "piece") if c in names]]
    tasks = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = parts.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    ranked = written(ordered.withColumn(rank, F.monotonically_increasing_id()), "ranked")
    runs = ranked.groupBy("length", F.shiftright(rank, 33).alias("part")).agg(F.min(rank), F.count("*")).collect()
    placements = supersteps([(r[0], r[2], r[3]) for r in runs], capacity)
    placements = placements[np.argsort(placements[:, 0])]
    shared = parts.sparkSession.sparkContext.broadcast(placements)  # bounded: see the module's text
    at = ranked.columns.index(rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(at).to_numpy(zero_copy_only=False)
            p = shared.value[np.searchsorted(shared.value[:, 0], own, side="right") - 1]
            nth = own - p[:, 0]
            sequence, offset = p[:, 3] + nth // p[:, 2], p[:, 4] + nth % p[:, 2] * p[:, 5]
            kept = [c for k, c in enumerate(b.columns) if k != at]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return ranked.mapInArrow(run, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, keep_ids: bool = False) -> DataFrame:
    """Tokenises, cuts and packs ``docs``: a row per piece with its place."""
    return pack(pieces(docs, capacity, vocabulary, keep_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id and its ids (at most the
    capacity), from pieces that kept their ids."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("ids"))
