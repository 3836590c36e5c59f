"""Exact k nearest neighbours of all rows, and oversampling (SMOTE) by them.

1. Equal vectors become one node with its rows' smallest ids.
2. Pivots cut the nodes into cells (nearest pivot).  Nodes are range-sorted by
   cell and distance to its pivot and cut into blocks, so a crowded cell
   spreads over many blocks and tasks; a block knows the least and greatest
   distance (a ring around the pivot).
3. Inside its own block every node finds an upper bound of its k-th distance.
   By the triangle inequality only rings that this bound reaches can hold a
   neighbour: those pairs of blocks are visited, and no others.
4. Neighbouring blocks form tiles: a task holds a tile, reads each block that any of
   its blocks visits once, and keeps the k + 1 best candidates per node (and ties).

Work follows the pairs of blocks that bounds can't exclude: few in data with
structure, all of them (in blocks) where distances hardly differ.  Matrix
products screen; distances are taken from differences, so they are exact to
rounding.  Vectors move as packed blocks, in single precision where that is exact; each block
moves to as many tiles as there are, whose number is fixed up to ``TILE_BLOCKS`` each.  The driver and the tasks hold the
pivots and one line per block (28 bytes for ``BLOCK_ROWS`` vectors).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.operators.ranks import fraction, hash_ranks, seeded
from logweave.session import cut_lineage

BLOCK_ROWS = 1024
#: Blocks of a tile (at most), and tiles that keep a cluster's cores busy.
TILE_BLOCKS, TILES = 256, 24
#: Pivots: the square root of the number of vectors, this many at most.
MAX_PIVOTS = 2048
#: Bounds give way by this much, for rounding.
SLACK = 1e-9


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances between rows of two matrices, by a matrix product."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def rounding(a: np.ndarray, b: np.ndarray) -> float:
    """How far ``apart`` may be off: the root of the error of a squared distance."""
    largest = max((a * a).sum(1).max(initial=0), (b * b).sum(1).max(initial=0))
    return 4 * math.sqrt(largest * (a.shape[1] + 4) * 2.3e-16)


def _cells(nodes: DataFrame, pivots: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                x = matrix(b.column(1))
                cell = apart(x, pivots).argmin(1)
                far = np.sqrt(np.square(x - pivots[cell]).sum(1))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32)), pa.array(far)], [*b.schema.names, "cell", "far"])

    return nodes.mapInArrow(run, "node bigint, vec array<double>, copies bigint, cell int, far double")


BLOCK = "block bigint, cell int, low double, high double, nodes binary, copies binary, vectors binary"
BLOCK_TYPES = [pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary()]


def _batch(rows: list[tuple], schema: str, kinds: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], [f.split()[0] for f in schema.split(", ")])


def _pack(rows: int):
    """Consecutive rows of a cell as blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for b in batches:
            if not len(b):
                continue
            cell, far, x = b.column("cell").to_numpy(), b.column("far").to_numpy(), matrix(b.column("vec"))
            node, copies = b.column("node").to_numpy(), b.column("copies").to_numpy()
            cuts = np.flatnonzero(np.diff(cell)) + 1
            out = []
            for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(b)], strict=True):
                for i in range(a, z, rows):
                    own = slice(i, min(i + rows, z))
                    out.append((block, int(cell[i]), far[own].min(), far[own].max(), node[own].tobytes(), copies[own].tobytes(), _packed(x[own])))
                    block += 1
            yield _batch(out, BLOCK, BLOCK_TYPES)

    return run


def _packed(x: np.ndarray) -> bytes:
    """A byte for the precision, then the vectors: as floats if none of them changes."""
    with np.errstate(over="ignore"):
        single = x.astype(np.float32)
    return b"4" + single.tobytes() if (single == x).all() else b"8" + x.tobytes()


def _unpack(nodes: pa.Scalar, copies: pa.Scalar, vectors: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, data = np.frombuffer(nodes.as_py(), np.int64), vectors.as_py()
    x = np.frombuffer(data, np.float32 if data[:1] == b"4" else np.float64, offset=1)
    return n, np.frombuffer(copies.as_py(), np.int64), x.astype(float).reshape(len(n), -1)


def _reach(x: np.ndarray, copies: np.ndarray, need: int) -> np.ndarray:
    """Per node of a block an upper bound of the distance within which it has
    ``need`` rows (itself included); infinite if the block has fewer."""
    if copies.sum() < need:
        return np.full(len(x), np.inf)
    d = apart(x, x) + rounding(x, x)
    width = min(need, len(x))
    near = np.argpartition(d, width - 1, axis=1)[:, :width]
    near = np.take_along_axis(near, np.take_along_axis(d, near, 1).argsort(1), 1)
    enough = (np.cumsum(copies[near], axis=1) >= need).argmax(1)
    return np.take_along_axis(np.take_along_axis(d, near, 1), enough[:, None], 1)[:, 0]


PAIR = "block bigint, other bigint"


def _visits(directory: tuple[np.ndarray, ...], pivots: np.ndarray, need: int):
    """For each block the blocks whose rings its nodes' bounds reach."""
    others, cells, low, high = directory

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                _, copies, x = _unpack(*(b.column(c)[i] for c in ("nodes", "copies", "vectors")))
                bound = _reach(x, copies, need)
                to_pivot = apart(x, pivots)
                slack = SLACK * (1 + to_pivot.max(initial=0)) + rounding(x, pivots)
                hit = np.zeros(len(others), bool)
                for own in range(0, len(x), 64):  # some nodes against all rings at a time
                    far, reach = to_pivot[own : own + 64][:, cells], bound[own : own + 64, None] + slack
                    hit |= ((far - reach <= high) & (far + reach >= low)).any(0)
                found = pa.array(others[hit], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([b.column("block")[i].as_py()] * len(found), pa.int64()), found], ["block", "other"])

    return run


NEAR = "node bigint, other bigint, distance double"


class Best:
    """The nearest candidates so far for the nodes of a block."""

    def __init__(self, node: np.ndarray, copies: np.ndarray, x: np.ndarray, need: int):
        self.node, self.x, self.need, self.bound = node, x, need, _reach(x, copies, need)
        self.rows, self.count, self.room = [], 0, 4 * need * len(x)

    def meet(self, other: np.ndarray, y: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Adds candidates of another block.  Gives some away if ties fill the room."""
        x, d, width = self.x, apart(self.x, y), min(self.need, len(y))
        best = np.partition(d, width - 1, axis=1)[:, width - 1]
        q, o = np.nonzero(d <= (np.minimum(self.bound, best) + 2 * rounding(x, y) + SLACK)[:, None])
        self.rows.append((q, other[o], np.sqrt(np.square(x[q] - y[o]).sum(1))))
        self.count += len(q)
        if self.count > self.room:
            self.prune()
            self.room = max(self.room, 2 * self.count)
            if self.count > 64 * self.need * len(x):
                yield from self.left()

    def prune(self) -> None:
        q, o, d = (np.concatenate(c) for c in zip(*self.rows, strict=True))
        order = np.lexsort((d, q))
        q, o, d = q[order], o[order], d[order]
        start = np.searchsorted(q, np.arange(len(self.x) + 1))
        full = np.flatnonzero(np.diff(start) >= self.need)
        self.bound[full] = np.minimum(self.bound[full], d[start[full] + self.need - 1])
        stay = d <= self.bound[q]
        self.rows, self.count = [(q[stay], o[stay], d[stay])], int(stay.sum())

    def left(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            self.prune()
            q, o, d = self.rows[0]
            yield pa.RecordBatch.from_arrays([pa.array(self.node[q]), pa.array(o), pa.array(d)], ["node", "other", "distance"])
        self.rows, self.count, self.room = [], 0, 4 * self.need * len(self.x)


def _compare(need: int):
    """The best candidates for the nodes of a tile's blocks, which come first, among
    those of the blocks that they visit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, {}
        for b in batches:
            tiles, blocks, visitors = (b.column(c).to_pylist() for c in ("tile", "block", "visitors"))
            for i, (at, block, who) in enumerate(zip(tiles, blocks, visitors, strict=True)):
                if at != tile:
                    for own in held.values():
                        yield from own.left()
                    tile, held = at, {}
                node, copies, x = _unpack(*(b.column(c)[i] for c in ("nodes", "copies", "vectors")))
                if who is None:
                    held[block] = Best(node, copies, x, need)
                for own in who or ():
                    yield from held[own].meet(node, x)
        for own in held.values():
            yield from own.left()

    return run


def nearest(points: DataFrame, k: int, key: str = "id", vec: str = "vec", block_rows: int = BLOCK_ROWS, pivots: int | None = None) -> DataFrame:
    """``(key, rank, neighbor, distance)``: the ``k`` nearest other rows of every row,
    by Euclidean distance, then key (fewer if there are fewer rows).

    Keys should be unique; rows with a null vector are left out, all vectors must
    have the same length.  Equal vectors are neighbours at distance 0.
    """
    need = k + 1
    rows = points.where(F.col(vec).isNotNull()).select(F.col(key).alias("id"), F.col(vec).cast("array<double>").alias("vec"))
    first = Window.partitionBy("vec").orderBy("id")
    some = rows.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= need)  # at most k + 1 rows of a vector
    nodes = some.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.count(F.lit(1)).alias("copies"))
    nodes = cut_lineage(nodes.withColumn("node", F.monotonically_increasing_id()))
    n = nodes.count()
    schema = rows.schema["id"].dataType.simpleString()
    if not n:
        return points.sparkSession.createDataFrame([], f"{key} {schema}, rank int, neighbor {schema}, distance double")
    many = pivots or min(MAX_PIVOTS, math.isqrt(n) + 1)
    chosen = nodes.orderBy(F.xxhash64("vec"), "node").limit(many).select("vec").collect()
    centres = np.array([r.vec for r in chosen], float)
    tasks = max(1, min(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // block_rows)))
    placed = _cells(nodes.select("node", "vec", "copies"), centres)
    blocks = cut_lineage(placed.repartitionByRange(tasks, "cell", "far").sortWithinPartitions("cell", "far").mapInArrow(_pack(block_rows), BLOCK))
    lines = blocks.select("block", "cell", "low", "high").collect()
    directory = tuple(np.array([r[c] for r in lines], t) for c, t in (("block", np.int64), ("cell", np.int64), ("low", float), ("high", float)))
    pairs = cut_lineage(blocks.mapInArrow(_visits(directory, centres, need), PAIR))
    # Consecutive blocks of consecutive cells form a tile.
    many = max(-(-len(lines) // TILE_BLOCKS), min(len(lines), TILES))
    placing = sorted((r.cell, r.low, r.block) for r in lines)
    tiles = points.sparkSession.createDataFrame([(block, i * many // len(lines)) for i, (_, _, block) in enumerate(placing)], "block bigint, tile int")
    visits = pairs.join(tiles, "block").groupBy("tile", "other").agg(F.collect_list("block").alias("visitors"))
    packed = ["nodes", "copies", "vectors"]
    theirs = visits.join(blocks.select(F.col("block").alias("other"), *packed), "other").select("tile", F.col("other").alias("block"), *packed, "visitors")
    both = blocks.join(tiles, "block").select("tile", "block", *packed, F.lit(None).cast("array<bigint>").alias("visitors")).unionByName(theirs)
    dealt = both.repartitionById(many, "tile").sortWithinPartitions("tile", F.col("visitors").isNotNull())
    near = dealt.mapInArrow(_compare(need), NEAR)
    # The rank filter is applied before the shuffle, too (window group limit).
    names = nodes.select(F.col("node").alias("other"), "ids")
    least = near.join(names.select("other", F.col("ids")[0].alias("least")), "other")
    closest = Window.partitionBy("node").orderBy("distance", "least")
    near = least.withColumn("_r", F.row_number().over(closest)).where(F.col("_r") <= need).select("node", "other", "distance")
    listed = near.join(names, "other").select("node", "distance", F.explode("ids").alias("neighbor"))
    by_id = Window.partitionBy("node").orderBy("distance", "neighbor")
    listed = listed.withColumn("_r", F.row_number().over(by_id)).where(F.col("_r") <= need)
    best = listed.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("distance", "neighbor"))).alias("best"))
    own = rows.join(nodes.select("vec", "node"), "vec").select("id", "node").join(best, "node")
    others = F.slice(F.filter("best", lambda c: c["neighbor"] != F.col("id")), 1, k)
    out = own.select("id", F.posexplode(others).alias("rank", "at"))
    return out.select(F.col("id").alias(key), (F.col("rank") + 1).alias("rank"), F.col("at.neighbor").alias("neighbor"), F.col("at.distance").alias("distance"))


def smote(
    df: DataFrame, key: str, features: str, label: str, minority: int = 1, k: int = 5, seed: int = 42, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """M7: synthetic rows ``(key, sample, neighbor, gap, features)`` of the minority
    class, as many as it lacks to all other rows.

    A synthetic row lies between a row (``key``) and one of its ``k`` nearest
    neighbours of the class: x + gap * (neighbor - x).  Every row gives the same
    number, and those with the smallest seeded hash one more until the classes
    are level; neighbour and gap come from the hash of seed, key and sample.
    None if the class has fewer than two rows or no fewer than the others.
    """
    vectors = F.col(features).cast("array<double>")
    own = cut_lineage(df.where(F.col(label) == minority).select(F.col(key).alias("id"), vectors.alias("vec")).where(F.col("vec").isNotNull()))
    size = own.count()
    lacks = df.where(~F.coalesce(F.col(label) == minority, F.lit(False))).count() - size
    if size < 2 or lacks <= 0:
        return df.sparkSession.createDataFrame([], f"{key} {own.schema['id'].dataType.simpleString()}, sample int, neighbor {own.schema['id'].dataType.simpleString()}, gap double, {features} array<double>")
    each, more = divmod(lacks, size)
    ranked = hash_ranks(own, "id", seed=seed)
    count = (F.lit(each) + (F.col("_rank") < more).cast("int")).cast("int")
    drawn = ranked.where(count > 0).select("id", "vec", F.explode(F.sequence(F.lit(1), count)).alias("sample"))
    drawn = drawn.withColumn("_h", seeded("id", F.concat(F.lit(f"{seed}:"), F.col("sample").cast("string"))))
    within = min(k, size - 1)
    pick = F.pmod(F.conv(F.substring("_h", 9, 8), 16, 10).cast("long"), F.lit(within)) + 1
    drawn = drawn.select("id", "vec", "sample", pick.cast("int").alias("rank"), fraction(F.col("_h")).alias("gap"))
    near = nearest(own, k, block_rows=block_rows).select("id", "rank", "neighbor")
    picked = drawn.join(near, ["id", "rank"]).join(own.select(F.col("id").alias("neighbor"), F.col("vec").alias("to")), "neighbor")
    between = F.zip_with("vec", "to", lambda a, b: a + F.col("gap") * (b - a))
    return picked.select(F.col("id").alias(key), "sample", "neighbor", "gap", between.alias(features))
