"""Two-pass external shuffle of records into shards.

Pass 1 scatters records uniformly over buckets by a seeded hash; pass 2 loads
one bucket at a time, Fisher-Yates shuffles it with a seeded generator and
writes it.  Buckets in order give one global order, cut into shards whose row
counts differ by one at most (law ``rows``).

Scale: a bucket holds about ``bucket_bytes``; their number follows the input.
The hash covers the id, the text and the row's place in the input, so equal
rows and hot ids scatter like all others (a retried task reads the same file
split, hence deals the same places).  Bucket sizes are counted in a pass of its
own, so texts are shuffled once and written once; pass 2 checks the counts and a
checksum of the rows.  Buckets are small, so that tasks get some each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.common import work_path, written

BUCKET_BYTES = 8 << 20
SEED = 17


def scatter(docs: DataFrame, n_buckets: int, seed: int = SEED) -> DataFrame:
    """Pass 1: doc_id, text, size, crc and the bucket of every row."""
    text = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    own = docs.select(
        F.col("doc_id").cast("bigint"),
        F.col("text").cast("string"),
        (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("place"),
    )
    hashed = own.withColumn("key", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "place"))
    return hashed.withColumn("bucket", F.pmod("key", F.lit(n_buckets)).cast("int"))


def shuffle_bucket(seed: int):
    """Pass 2, for one bucket: a seeded Fisher-Yates permutation of its rows,
    numbered on from where the bucket starts in the global order."""

    def run(key: tuple, rows: pa.Table, bucket: pa.Table) -> pa.Table:
        n, start = bucket["n"][0].as_py(), bucket["start"][0].as_py()
        if n != len(rows) or bucket["check"][0].as_py() != int(np.bitwise_xor.reduce(rows["key"].to_numpy())):
            raise RuntimeError("the input changed between the passes")
        rows = rows.sort_by([("key", "ascending"), ("place", "ascending")])
        order = list(range(n))
        rng = np.random.default_rng([seed, key[0].as_py()])
        for i, j in enumerate(rng.integers(np.arange(n), n).tolist()):
            order[i], order[j] = order[j], order[i]
        rows = rows.select(["doc_id", "text", "size", "text_crc32"]).take(pa.array(order))
        return rows.append_column("place", pa.array(np.arange(start, start + n), pa.int64()))

    return run


def shard(docs: DataFrame, path: str, n_shards: int = 16, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> DataFrame:
    """Shuffles ``docs`` and writes them to ``path`` as ``shard=N`` folders; returns
    the written table: doc_id, text, size, text_crc32, slot, shard.

    Null texts have size 1 and the checksum of no bytes.  Null and repeated ids
    are rows like others; an empty table gives empty shards; other columns
    aren't carried.
    """
    spark = docs.sparkSession
    total = docs.select(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    n_buckets = max(spark.sparkContext.defaultParallelism, math.ceil(total / bucket_bytes))
    mixed = scatter(docs, n_buckets, seed)
    sizes = written(mixed.groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor("key").alias("check")), "buckets")
    n = sizes.agg(F.sum("n")).first()[0] or 0
    # One row per bucket: where it starts in the global order.
    starts = sizes.withColumn("start", F.sum("n").over(Window.orderBy("bucket")) - F.col("n"))
    placed = (
        mixed.groupBy("bucket")
        .cogroup(starts.groupBy("bucket"))
        .applyInArrow(shuffle_bucket(seed), "doc_id bigint, text string, size bigint, text_crc32 bigint, place bigint")
    )
    # Shard s holds the places from floor(s * n / n_shards).
    out = placed.selectExpr(
        "doc_id", "text", "size", "text_crc32", "place",
        f"cast(((place + 1) * {n_shards} - 1) div {max(n, 1)} as int) as shard",
    ).selectExpr("doc_id", "text", "size", "text_crc32", f"place - shard * {n}L div {n_shards} as slot", "shard")
    out.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    return spark.read.schema("doc_id bigint, text string, size bigint, text_crc32 bigint, slot bigint, shard int").parquet(path)


def digests(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """The shards of ``docs`` as ids, sizes, checksums and places."""
    out = shard(docs, work_path(docs.sparkSession, "shards"), n_shards)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
