"""Near-duplicates by Order MinHash, verified by banded alignment.

1. Every text becomes occurrence-labelled k-mers of three words (the k-th copy
   of a k-mer is another element).  Each of ``SKETCHES`` hash functions samples
   the two smallest and keeps them in text order: texts agree on an entry if
   they share these k-mers in the same order, so the sketch follows edit
   similarity, not only set overlap (Marcais et al., 2019).
   Texts under ``SHORT`` words are also filed under all that is left of them
   after deleting up to a fifth of their words: similar ones meet there exactly.
2. Equal texts are one node.  Nodes that share an entry meet in a bucket; each
   is paired with the bucket's pivots that could be similar (length, agreement
   of the smallest k-mers), and is a pivot itself if none is.
3. Pairs are verified on their whole texts: edit distance over words within
   the band that the similarity allows.  Verified links join texts to classes.
4. A pivot that absorbs a text may turn out to be unlike it, and a pivot found later
   isn't compared with the texts absorbed before it.  So buckets that absorbed a text
   and still hold several classes are gone through again: first each text with the
   nearest one of every other class, then, with the classes that these links left,
   all pairs of texts of different classes that were not verified yet.

Scale: one pass over texts for the sketches; buckets are range-sorted by entry
and a hash of the node, so that a hot bucket spreads over partitions (what the
parts share is compared by their pivots in a second, small round).  A group of
n near copies gives about n pairs per order, not n * n; entries are swept in
two opposite orders, so a text that an early pivot absorbs is also met by texts
that resemble only it.  Step 4 is dealt in tiles of at most two times ``TILE`` texts;
the largest class of a bucket is not compared with itself.  What reaches verification
there has passed an exact bound (words that one text has and the other lacks), first
by 64 counts, then, for members that these let through, by the set of all words; texts
of unlike classes with nearly the same words remain quadratic within their bucket.
Only texts that may occur in a pair are read again, once.
Components come from alternating large-star and small-star joins on tables in
the shared folder; nothing but two numbers per round reaches the driver.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.common import utf8, written

#: Words of a k-mer.  With a fifth of the words replaced, three words keep an overlap
#: of 0.34 (0.25 if it is every fifth word); five words keep 0.2 (none).
K = 3
#: Two texts share an entry with about the square of their overlap: one of 64 with a
#: chance of 0.999 at the overlap 0.34.
SKETCHES = 64
#: Similar if at most one fifth of the longer text's words differ: 0.8 or more.
PART = 5
#: Of the first 32 smallest k-mers, so many agree for a pair worth verifying: with a
#: chance of 0.9998 at the overlap 0.34 and 0.993 at 0.25, the least of similar texts.
BITS, AGREE = 32, 3
#: Texts of fewer words meet by deletions: at most two words, 106 ways.
SHORT = 15
#: Texts of fewer than the second number of words are sketched by 2-mers, of which a
#: change spoils fewer; texts of the first number or more by K-mers.  No two similar
#: texts are so unlike in length that they have no kind in common.
BRIEF_K, BRIEF = 2, (51, 64)
#: Words are counted in so many bins; counts end at 255, which only lowers the bound.
BINS = 64
#: Texts of a side of a tile.
TILE = 2048
PRIME = np.uint64(0x9E3779B97F4A7C15)
SEEDS = np.random.default_rng(5).integers(1, 2**63, SKETCHES, np.uint64) * np.uint64(2) + np.uint64(1)
SALTS = np.random.default_rng(6).integers(0, 2**63, SKETCHES, np.uint64)
WEIGHTS = np.random.default_rng(7).integers(1, 2**63, 8, np.uint64) * np.uint64(2) + np.uint64(1)
WIDE = 4096


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def labelled(words: list[bytes], k: int = 5) -> np.ndarray:
    """Hashes of the occurrence-labelled k-mers, in text order.  A text of fewer
    than k words is one k-mer."""
    own = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    if len(own) < k:
        own = np.concatenate([own, np.full(k - len(own), 1 << 40, np.uint64)])
    n = len(own) - k + 1
    kmers = mix(sum(own[j : j + n] * WEIGHTS[j] for j in range(k)))
    order = np.argsort(kmers, kind="stable")
    same = kmers[order]
    first = np.concatenate([[True], same[1:] != same[:-1]])
    at = np.arange(n)
    nth = np.empty(n, np.uint64)
    nth[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return mix(kmers + nth * PRIME)


def sketch(words: list[bytes], k: int = K) -> tuple[list[int], bytes]:
    """Entries (one per hash function: the two smallest k-mers in text order) and
    a byte of the smallest k-mer of the first BITS functions."""
    own = labelled(words, k)
    low = np.empty((2, SKETCHES), np.int64)
    step = SKETCHES if len(own) <= WIDE else 1
    for j in range(0, SKETCHES, step):
        z = (own[None, :] ^ SALTS[j : j + step, None]) * SEEDS[j : j + step, None]
        z ^= z >> np.uint64(29)
        row = np.arange(len(z))
        low[0, j : j + step] = z.argmin(1)
        if len(own) > 1:
            z[row, low[0, j : j + step]] = np.uint64(2**64 - 1)
        low[1, j : j + step] = z.argmin(1)
    a, b = own[low.min(0)], own[low.max(0)]
    entries = mix(a * PRIME + mix(b + SALTS))
    bits = (mix(own[low[0, :BITS]]) & np.uint64(255)).astype(np.uint8)
    return entries.view(np.int64).tolist(), bits.tobytes()


def deletions(words: list[bytes]) -> list[tuple[int, int]]:
    """(hash of the words left, shape) for all ways to delete at most a fifth of the
    words of a short text; the shape says from which gaps how many were deleted."""
    n, out = len(words), []
    for count in range(n // PART + 1 if n < SHORT else 0):
        for at in combinations(range(n), count):
            left = hashlib.blake2b(b" ".join(w for i, w in enumerate(words) if i not in at), digest_size=8).digest()
            out.append((int.from_bytes(left, "big", signed=True), sum((i - j + 1) * SHORT**j for j, i in enumerate(at))))
    return out


def bag(words: list[bytes]) -> bytes:
    """Counts of the words by a hash, a byte each."""
    own = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % np.uint32(BINS)
    return np.minimum(np.bincount(own, minlength=BINS), 255).astype(np.uint8).tobytes()


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, key (MD5 of the text), n_words, entries, bits, deletions and bag of every
    row; texts without words have none of these.  Brief texts have entries and
    bits of 2-mers, those between the limits of both kinds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in utf8(b.column(1)):
                words = text.split()
                entries, bits = sketch(words) if len(words) >= BRIEF[0] else ([], b"")
                brief, brief_bits = sketch(words, BRIEF_K) if 0 < len(words) < BRIEF[1] else ([], b"")
                rows.append((hashlib.md5(text).digest(), len(words), entries, bits, brief, brief_bits, deletions(words) if words else [], bag(words)))
            columns = list(zip(*rows, strict=True)) or [()] * 8
            cuts = pa.list_(pa.struct([("rest", pa.int64()), ("shape", pa.int64())]))
            kinds = [pa.binary(), pa.int32(), *[pa.list_(pa.int64()), pa.binary()] * 2, cuts, pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True))],
                ["doc_id", "key", "n_words", "entries", "bits", "brief", "brief_bits", "cuts", "bag"],
            )

    part = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    kinds = "doc_id bigint, key binary, n_words int, entries array<bigint>, bits binary, brief array<bigint>, brief_bits binary, cuts array<struct<rest: bigint, shape: bigint>>, bag binary"
    return part.mapInArrow(run, kinds)


MEMBERS = "entry bigint, key binary, n_words int, bits binary, pivot binary"
MEMBER_TYPES = [pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]


class Bucket:
    """The pivots of one entry."""

    def __init__(self, entry: int):
        self.entry, self.rows, self.absorbed = entry, [], False
        self.bits, self.words = np.empty((8, BITS), np.uint8), np.empty(8, np.int64)

    def meet(self, row: tuple) -> list[bytes]:
        """Pivots that the row may be similar to; without any it becomes one."""
        _, _, words, bits = row
        n, own = len(self.rows), np.frombuffer(bits, np.uint8)
        if n:
            ahead = (self.bits[:n] == own).sum(1) >= AGREE
            known = self.words[:n]
            ahead &= PART * np.abs(known - words) <= np.maximum(known, words)
            if ahead.any():
                self.absorbed = True
                return [self.rows[i][1] for i in np.flatnonzero(ahead).tolist()]
        if n == len(self.words):
            self.bits, self.words = (np.concatenate([x, np.empty_like(x)]) for x in (self.bits, self.words))
        self.bits[n], self.words[n] = own, words
        self.rows.append(row)
        return []


def sweep(open_ends: bool):
    """Streams over members in order of entry: rows with a pivot are pairs; rows
    without are pivots of the buckets that the partition's ends may have cut.  Pivots
    of other buckets that absorbed a row are paired with themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, first = None, True
        for b in batches:
            out: list[tuple] = []
            b = b.filter(pa.array(_met(b.column(0).to_numpy())))
            for row in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if bucket is None or row[0] != bucket.entry:
                    if bucket is not None and open_ends and (first or bucket.absorbed):
                        out += [(*r, None if first else r[1]) for r in bucket.rows]
                    first = bucket is None
                    bucket = Bucket(row[0])
                out += [(*row, p) for p in bucket.meet(row)]
            yield _members(out)
        if bucket is not None and open_ends:
            yield _members([(*r, None) for r in bucket.rows])

    return run


def _met(entries: np.ndarray) -> np.ndarray:
    """Which rows of a batch may meet another one: all but those inside the batch
    that are alone with their entry."""
    same = np.concatenate([[True], entries[1:] == entries[:-1], [True]])
    return (same[1:] | same[:-1])[: len(entries)]


def _members(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, kind in zip(columns, MEMBER_TYPES, strict=True)], [f.split()[0] for f in MEMBERS.split(", ")]
    )


def _order() -> Column:
    order = F.xxhash64("key")
    return F.when(F.col("entry") % 2 == 0, order).otherwise(F.bitwise_not(order))


def meetings(nodes: DataFrame) -> DataFrame:
    """The sweep's rows: pairs, and the pivots of buckets that absorbed a row or may be cut."""
    filed = "transform({0}, e -> struct(e AS entry, {1} AS bits))".format
    both = F.expr(f"concat({filed('entries', 'bits')}, {filed('brief', 'brief_bits')})")
    members = nodes.select("key", "n_words", F.explode(both).alias("__e")).select("__e.entry", "key", "n_words", "__e.bits")
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.repartitionByRange(tasks, "entry", _order()).sortWithinPartitions("entry", _order())
    return written(dealt.mapInArrow(sweep(True), MEMBERS), "met")


def candidates(nodes: DataFrame, met: DataFrame | None = None) -> DataFrame:
    """Distinct pairs (a, b) of node keys to verify, a < b."""
    met = meetings(nodes) if met is None else met
    cut = met.where("pivot is null").drop("pivot").repartition("entry").sortWithinPartitions("entry", _order())
    pairs = met.where("pivot is not null").unionByName(cut.mapInArrow(sweep(False), MEMBERS))
    pairs = pairs.select("key", "pivot").unionByName(short_pairs(nodes))
    return pairs.select(F.least("key", "pivot").alias("a"), F.greatest("key", "pivot").alias("b")).where("a < b").distinct()


def lacking(bags: np.ndarray, own: np.ndarray) -> np.ndarray:
    """For each row of bags a lower bound of the edit distance to ``own``: the words
    that one text has more often than the other."""
    more = bags.astype(np.int16) - own
    return np.maximum(np.maximum(more, 0).sum(1), np.maximum(-more, 0).sum(1))


def marks(words: list[bytes]) -> bytes:
    """The set of the words by a 16-bit hash of word and occurrence, in order."""
    return np.unique(labelled(words, 1) & np.uint64(0xFFFF)).astype(np.uint16).tobytes()


def by_bags(bags: tuple[bytes, ...]):
    """Lower bounds of the distances of rows ``at`` to row i, by their bags."""
    counts = np.frombuffer(b"".join(bags), np.uint8).reshape(-1, BINS)
    return lambda at, i: lacking(counts[at], counts[i].astype(np.int16))


def by_marks(sets: tuple[bytes, ...]):
    """The same by their marks: each mark that only one of two texts has is a word of it."""
    own = [np.frombuffer(x, np.uint16) for x in sets]
    sizes, there = np.array([len(x) for x in own], np.int64), np.zeros(1 << 16, bool)

    def far(at: np.ndarray, i: int) -> np.ndarray:
        there[own[i]] = True
        both = [np.empty(0, np.int64)]
        for some in (at[j : j + 256] for j in range(0, len(at), 256)):
            hits = there[np.concatenate([own[j] for j in some.tolist()])]
            both.append(np.add.reduceat(hits, np.cumsum(sizes[some]) - sizes[some], dtype=np.int64))
        there[own[i]] = False
        return np.maximum(sizes[at], sizes[i]) - np.concatenate(both)

    return far


def meets(rows: list[tuple], bound, once: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For rows (key, n_words, bits, bag or marks, label, side) of side 0 or 2 the places of
    those of another label that may be similar, and bounds of their distances: of side 0
    with side 1, of side 2 with one another, each pair ``once`` or from both ends."""
    _, words, bits, own, labels, sides = zip(*rows, strict=True)
    words, labels, sides = (np.array(x, np.int64) for x in (words, labels, sides))
    bits, bound = np.frombuffer(b"".join(bits), np.uint8).reshape(-1, BITS), bound(own)
    for i in np.flatnonzero(sides != 1).tolist():
        may = (labels != labels[i]) & (PART * np.abs(words - words[i]) <= np.maximum(words, words[i]))
        if sides[i] == 0:
            may &= sides == 1
        elif once:
            may[: i + 1] = False
        at = np.flatnonzero(may)
        at = at[(bits[at] == bits[i]).sum(1) >= AGREE]
        far = bound(at, i)
        near = PART * far <= np.maximum(words[at], words[i])
        yield i, at[near], far[near]


def tile_pairs(rows: list[tuple], most: int | None, bound=by_bags) -> list[tuple[bytes, bytes]]:
    """Pairs of rows of a tile that may be similar.  With ``most``, each row's nearest ones
    of every other label, so many of each."""
    out, labels = [], np.array([r[4] for r in rows], np.int64)
    for i, at, far in meets(rows, bound, most is None):
        if most is not None and len(at) > 1:
            order = np.lexsort((far, labels[at]))
            at = at[order]
            first = np.flatnonzero(np.diff(labels[at], prepend=labels[at[0]] - 1))
            at = at[np.arange(len(at)) - np.repeat(first, np.diff(first, append=len(at))) < most]
        out += [(rows[i][0], rows[j][0]) for j in at.tolist()]
    return out


def tile_members(entry: int, rows: list[tuple]) -> list[tuple]:
    """Rows of a tile, as members, that may be similar to one of another label by their bags."""
    hit = np.zeros(len(rows), bool)
    for i, at, _ in meets(rows, by_bags, True):
        hit[at] = True
        hit[i] |= len(at) > 0
    return [(entry, *rows[i][:3], None) for i in np.flatnonzero(hit).tolist()]


def divided(members: DataFrame, roots: DataFrame) -> DataFrame:
    """The distinct members (entry, key, n_words, bits) of buckets that hold several classes:
    with their class's label, the label and size of the bucket's largest class and its size."""
    bucket, group = Window.partitionBy("entry"), Window.partitionBy("entry", "label")
    label = F.xxhash64(F.coalesce("root", "key")).alias("label")
    # One exchange by key serves repeated rows and, at every size, the join; one by entry the buckets.
    members = members.select("entry", "key", "n_words", "bits").repartition("key").distinct()
    members = members.join(roots.withColumnRenamed("node", "key").hint("merge"), "key", "left").select("entry", "key", "n_words", "bits", label)
    members = members.repartition("entry").withColumn("own", F.count("*").over(group))
    members = members.withColumns({"largest": F.max(F.struct("own", "label")).over(bucket), "n": F.count("*").over(bucket)})
    members = members.where("largest.own < n")
    return members.select("entry", "key", "n_words", "bits", "label", F.col("largest.label").alias("major"), F.col("largest.own").alias("most"), "n")


PLACE = ["entry", "kind", "i", "j"]


def dealt(members: DataFrame, bounds: DataFrame) -> DataFrame:
    """The members, as ``divided`` gives them, by tile with their ``bounds`` (key, own)."""
    sized = members.withColumns(
        {"one": F.col("n") <= TILE, "minors": F.ceil((F.col("n") - F.col("most")) / TILE), "majors": F.ceil(F.col("most") / TILE)}
    )
    # In large buckets: texts outside the largest class meet one another and those of the largest class.
    part = "pmod(xxhash64(key), {})".format
    cell = "struct({} AS kind, {} AS i, {} AS j, {} AS side)".format
    minor = f"transform(sequence(0L, minors - 1), x -> {cell(0, 'least(at, x)', 'greatest(at, x)', 'CASE WHEN at = x THEN 2 WHEN at < x THEN 0 ELSE 1 END')})"
    across = f"transform(sequence(0L, majors - 1), x -> {cell(1, 'at', 'x', 0)})"
    major = f"transform(sequence(0L, minors - 1), x -> {cell(1, 'x', 'at', 1)})"
    cells = F.expr(f"CASE WHEN label = major THEN {major} ELSE concat({minor}, {across}) END")
    large = sized.where(~F.col("one")).withColumn("at", F.expr(f"CASE WHEN label = major THEN {part('majors')} ELSE {part('minors')} END"))
    large = large.select("*", F.explode(cells).alias("c")).select("entry", "c.kind", "c.i", "c.j", "key", "n_words", "bits", "label", "c.side")
    # A bucket of one tile goes there as it is.
    whole = [F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("i"), F.lit(0).cast("bigint").alias("j")]
    small = sized.where("one").select("entry", *whole, "key", "n_words", "bits", "label", F.lit(2).alias("side"))
    placed = small.unionByName(large).join(bounds, "key").select(*PLACE, "key", "n_words", "bits", "own", "label", "side")
    return placed.repartition(*PLACE).sortWithinPartitions(*PLACE, "key")


def by_tile(found, packed):
    """Streams over rows as ``dealt`` deals them: ``packed`` what ``found`` finds in each tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, rows = None, []
        for b in batches:
            out = []
            place = zip(*(b.column(k).to_pylist() for k in range(4)), strict=True)
            for at, row in zip(place, zip(*(b.column(k).to_pylist() for k in range(4, 10)), strict=True), strict=True):
                if at != tile:
                    out += found(tile[0], rows) if len(rows) > 1 else []
                    tile, rows = at, []
                rows.append(row)
            yield packed(out)
        yield packed(found(tile[0], rows) if len(rows) > 1 else [])

    return run


def crossing_members(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those members, as ``divided`` gives them, that may be similar to one of another class."""
    rows = dealt(members, nodes.select("key", F.col("bag").alias("own")))
    return rows.mapInArrow(by_tile(tile_members, _members), MEMBERS).drop("pivot")


def crossing(members: DataFrame, sets: DataFrame, tested: DataFrame, most: int | None) -> DataFrame:
    """Pairs (a, b), a < b, of different classes that share a bucket, may be similar by their
    marks (``sets``: key, own) and weren't tested; ``members`` as ``divided`` gives them."""

    def found(_entry: int, rows: list[tuple]) -> list[tuple[bytes, bytes]]:
        return tile_pairs(rows, most, by_marks)

    pairs = dealt(members, sets).mapInArrow(by_tile(found, _pairs), "key binary, other binary")
    pairs = pairs.select(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b")).distinct()
    return pairs.join(tested, ["a", "b"], "left_anti")


def marked(texts: DataFrame) -> DataFrame:
    """key and marks (own) of texts (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = pa.array([marks(t.split()) for t in utf8(b.column(1))], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), own], ["key", "own"])

    return texts.select("key", "text").mapInArrow(run, "key binary, own binary")


def ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key")))


def _pairs(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 2
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["key", "other"])


def short_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (key, pivot) whose similar ones connect all similar short texts.

    If two are similar, an optimal alignment leaves the same words of both, and
    neither loses more than a fifth of its own.  Texts with the same rest and shape
    are all similar, and of two shapes of a rest all texts are as far apart as that
    alignment or nearer.  So each text is paired with the head of its shape, and
    the heads of a rest (at most 106 shapes) with one another."""
    cuts = nodes.select("key", F.inline("cuts"))
    heads = cuts.groupBy("rest", "shape").agg(F.min("key").alias("pivot"))
    own = cuts.join(heads, ["rest", "shape"]).select("key", "pivot")
    among = heads.groupBy("rest").agg(F.array_sort(F.collect_set("pivot")).alias("all")).where("size(all) > 1")
    among = among.select("all", F.posexplode("all").alias("i", "pivot"))
    return own.unionByName(among.select(F.explode(F.expr("slice(all, i + 2, size(all))")).alias("key"), "pivot"))


def distance(a: list, b: list, limit: int) -> int:
    """Edit distance of two sequences, exact if at most ``limit`` (else larger
    than it).  Bit-parallel over the band of ``limit`` around the diagonal:
    bits are the vertical differences of the band's part of one column."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    head = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    a, b = a[head:], b[head:]
    tail = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b))) if x != y), min(len(a), len(b)))
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not a or not b:
        return len(a) + len(b)
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    low, top, base = 0, min(len(a), limit), 0
    up, down = (1 << top) - 1, 0
    for j, x in enumerate(b):
        if top < len(a) and top < j + 1 + limit:  # the band's next row begins one above its neighbour
            up |= 1 << top - low
            top += 1
        if low < j - limit:  # the lowest row leaves the band
            base += (up & 1) - (down & 1)
            up, down, low = up >> 1, down >> 1, low + 1
        mask = (1 << top - low) - 1
        equal = places.get(x, 0) >> low & mask
        diagonal = (((equal & up) + up ^ up) | equal | down) & mask
        right = (down | mask & ~(diagonal | up)) << 1 | 1
        left = (up & diagonal) << 1
        up, down = (left | ~(diagonal | right)) & mask, right & diagonal & mask
        base += 1
    return base + up.bit_count() - down.bit_count()


def similar(a: list, b: list) -> bool:
    longer = max(len(a), len(b))
    return PART * distance(a, b, longer // PART) <= longer


def text_key() -> Column:
    """The key of a row's text, as ``sketches`` gives it."""
    return F.unhex(F.md5(F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b""))))


def picked(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """key and text of the distinct texts with these keys."""
    texts = docs.select(text_key().alias("key"), F.col("text").cast("string").alias("text"))
    # A merge join at every size: whole texts move once, whatever the number of keys.
    return texts.join(keys.distinct().hint("merge"), "key", "left_semi").dropDuplicates(["key"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those pairs whose texts (key, text) are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, words = None, []
        for b in batches:
            keep = []
            for key, one, two in zip(b.column(1).to_pylist(), utf8(b.column(2)), utf8(b.column(3)), strict=True):
                if key != last:
                    last, words = key, two.split()
                keep.append(similar(one.split(), words))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one, two = texts.toDF("a", "text_a"), texts.toDF("b", "text_b")
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
    return written(both.mapInArrow(run, "a binary, b binary"), "links")


def components(links: DataFrame, most_rounds: int = 50) -> DataFrame:
    """node, root (the smallest node of its component) for all nodes with a link."""
    edges = links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct()
    edges, before = written(edges, "edges"), None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        # Large star: neighbours above a node go to its smallest neighbour.
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("u < v").distinct()
        # Small star: a node and its neighbours below go to the smallest of them.
        lower = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(lower, "v").select(F.explode(F.array("u", "v")).alias("v"), F.col("m").alias("u"))
        edges = written(small.where("u < v").distinct(), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
        before = state
    raise RuntimeError(f"no fixed point after {most_rounds} rounds")


def rooted(links: DataFrame) -> DataFrame:
    """node, root for all nodes with a link, once each, roots too."""
    roots = components(links).unionByName(links.select(F.least("a", "b").alias("node"), F.least("a", "b").alias("root")))
    # A root stands for itself; other nodes that are the smaller end of a link have their row above.
    return roots.groupBy("node").agg(F.min("root").alias("root"))


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after further links: the classes are the nodes that these join."""
    ends = links.join(roots.toDF("a", "__a"), "a", "left").join(roots.toDF("b", "__b"), "b", "left")
    ends = written(ends.select("a", "b", F.coalesce("__a", "a").alias("of_a"), F.coalesce("__b", "b").alias("of_b")), "ends")
    above = rooted(ends.select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))).toDF("root", "above")
    new = ends.select("a", "of_a").union(ends.select("b", "of_b")).toDF("node", "root")
    every = roots.unionByName(new).distinct()
    return every.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root"))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text), root (of the class) and class_id, the smallest id
    of the class, of every row.

    Equal texts are one class; texts that are similar, directly or through
    others, too.  Null, empty and wordless texts are each a class of their own.
    Repeated rows keep their rows; null ids count as larger than all others, and
    an empty table gives no rows.  Other columns aren't read.
    """
    own = sketches(docs).where("n_words > 0")
    nodes = own.groupBy("key").agg(
        F.min("doc_id").alias("least"), *[F.first(c).alias(c) for c in ("n_words", "entries", "bits", "brief", "brief_bits", "cuts", "bag")]
    )
    nodes = written(nodes, "nodes")
    met = meetings(nodes)
    tested = written(candidates(nodes, met), "tested")
    # Whole texts are picked once: of all that a pair names, and of pivots that may still get one.
    texts = written(picked(docs, met.select("key").unionByName(ends(tested))), "texts")
    roots = written(rooted(verified(tested, texts)), "roots")
    members = written(crossing_members(written(divided(met, roots), "divided"), nodes), "members")
    keys = written(members.select("key").distinct(), "keys")
    few = written(texts.join(keys, "key", "left_semi"), "few")
    sets = written(marked(few), "marks")
    for most in (1, None):
        more = written(crossing(written(divided(members, roots), "divided"), sets, tested, most), "more")
        if more.isEmpty():
            continue
        links = verified(more, written(few.join(ends(more).distinct(), "key", "left_semi"), "fewer"))
        tested = tested.unionByName(more)
        if not links.isEmpty():
            roots = written(merged(roots, links), "roots")
    least = nodes.select(F.col("key").alias("node"), "least").join(roots, "node", "left")
    least = least.withColumn("root", F.coalesce("root", "node"))
    class_of = least.groupBy("root").agg(F.min("least").alias("class_id"))
    known = least.join(class_of, "root").select(F.col("node").alias("key"), "root", "class_id")
    every = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key().alias("key"))
    # Texts without words are no nodes.
    found = every.join(known.withColumn("__node", F.lit(True)), "key", "left")
    return found.select("doc_id", "key", "root", F.when(F.col("__node"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"))


def first_of_class(docs: DataFrame) -> DataFrame:
    """One row of each class of ``docs``, with all its columns; every row without
    words stays.  Among rows with the class's id, equal ones leave one."""
    found = written(classes(docs), "classes")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    names, key = docs.columns, "__key"
    while key in names:
        key += "_"
    keyed = docs.withColumn(key, F.unhex(F.md5(F.encode(text, "UTF-8"))))
    wordless = F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")) == 0
    # Rows of the class's id may differ in their texts (repeated ids): the smallest key stands for it.
    chosen = found.where("root is not null and doc_id <=> class_id").groupBy("root", "class_id", "key").agg(F.count("*").alias("n"))
    chosen = chosen.groupBy("root", "class_id").agg(F.min(F.struct("key", "n")).alias("own"))
    chosen = chosen.select(F.col("class_id").alias("__class"), F.col("own.key").alias("__own"), F.col("own.n").alias("__n"))
    match = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__class")) & (F.col(key) == F.col("__own"))
    kept = keyed.where(~wordless).join(chosen, match)
    once = kept.where("__n = 1").select(*names)
    again = kept.where("__n > 1").dropDuplicates(["doc_id", key]).select(*names)
    return docs.where(wordless).unionByName(once).unionByName(again)
