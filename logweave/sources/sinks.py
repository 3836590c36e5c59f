"""Writers: feature tables, filtered logs, per-split series, block sinks.

All write to a path the caller names (on a cluster: shared storage) and are
idempotent (overwrite, or dynamic partition overwrite for partitioned
outputs), so a retried job replaces rather than duplicates its output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.session import cut_lineage

# Fixed value: rows per block of the reference's block-wise insert.
BLOCK_ROWS = 10000


def write_features(df: DataFrame, path: str, fmt: str = "parquet", key: str = "FileID") -> None:
    """Feature table keyed by FileID (parquet, or CSV with header)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def write_filtered_log(df: DataFrame, path: str) -> None:
    """Headerless log rows partitioned by overlap type and day.  Rebalancing
    keeps small days in one file and splits large ones over tasks (AQE)."""
    (
        df.select("FileID", "CustomerID", "QueryTs", "ProductID", "typ", "day")
        .hint("rebalance", "typ", "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("typ", "day")
        .option("header", False)
        .csv(path)
    )


def write_split_series(df: DataFrame, path: str) -> None:
    """A10: per-second facts by split, each file sorted by FileID and time
    (instead of one CSV per key); re-writing a split replaces only it.
    Rebalancing splits a split over tasks by size (AQE)."""
    (
        df.hint("rebalance", "split")
        .sortWithinPartitions("FileID", "QueryTs")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("split")
        .parquet(path)
    )


SERIES_BUCKETS = 64


def series_bucket(key: str = "FileID", buckets: int = SERIES_BUCKETS):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_bucketed_series(df: DataFrame, path: str, buckets: int = SERIES_BUCKETS) -> None:
    """A10, repairable: per-second facts by split and a hash bucket of the file, so
    that a few files can be replaced without rewriting the dump."""
    (
        df.withColumn("bucket", series_bucket(buckets=buckets))
        .hint("rebalance", "split", "bucket")
        .sortWithinPartitions("FileID", "QueryTs")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("split", "bucket")
        .parquet(path)
    )


def repair_series(dump: str, source: DataFrame, bad: DataFrame, buckets: int = SERIES_BUCKETS) -> None:
    """A10, subset repair: the files listed in ``bad`` (column ``FileID``) are taken
    anew from ``source`` (facts with their ``split``); all others stay.

    Only the (split, bucket) folders of listed files are read and rewritten, with
    the untouched files of those folders carried over; a listed file that the
    source doesn't have leaves the dump.  ``buckets`` is that of the dump.
    """
    spark = source.sparkSession
    listed = cut_lineage(bad.select("FileID").distinct().withColumn("bucket", series_bucket(buckets=buckets)))
    touched = [r.bucket for r in listed.select("bucket").distinct().collect()]  # at most ``buckets``
    if not touched:
        return
    schema = source.select("FileID", *[c for c in source.columns if c not in ("FileID", "split", "bucket")], "split").schema
    old = spark.read.schema(schema.add("bucket", "integer")).parquet(dump).where(F.col("bucket").isin(touched))
    # Of the folders of those buckets, only those that hold a listed file or get one.
    fresh = source.join(listed, "FileID").select(*old.columns)
    hit = old.join(listed.select("FileID"), "FileID", "left_semi").select("split", "bucket").union(fresh.select("split", "bucket")).distinct()
    hit = cut_lineage(hit)  # the dump changes below
    kept = old.join(hit, ["split", "bucket"], "left_semi").join(listed.select("FileID"), "FileID", "left_anti")
    # A folder whose last file has gone keeps an empty part: dynamic overwrite needs rows.
    out = cut_lineage(kept.select(*old.columns).unionByName(fresh))
    (
        out.hint("rebalance", "split", "bucket")
        .sortWithinPartitions("FileID", "QueryTs")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("split", "bucket")
        .parquet(dump)
    )
    left = out.select("split", "bucket").distinct()
    for split, bucket in [tuple(r) for r in hit.join(left, ["split", "bucket"], "left_anti").collect()]:
        remove_folder(spark, f"{dump}/split={split}/bucket={bucket}")


def remove_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def write_co_bucketed(tables: dict[str, DataFrame], spine: str, folder: str, buckets: int = SERIES_BUCKETS, key: str = "FileID") -> None:
    """Feature tables, and the ``spine`` of all their keys, as catalog tables
    bucketed and sorted by the key, in ``folder``: they join without an exchange."""

    def write(name: str, t: DataFrame) -> None:
        t.repartition(buckets, F.col(key)).write.mode("overwrite").option("path", f"{folder}/{name}").bucketBy(buckets, key).sortBy(key).saveAsTable(name)

    for name, t in tables.items():
        write(name, t)
    # Keys are read by path: Spark 4.1.2 takes a union of bucketed tables for
    # partitioned by the key, though it puts their partitions one after another.
    keys = None
    for name, t in tables.items():
        own = t.sparkSession.read.parquet(f"{folder}/{name}").select(key)
        keys = own if keys is None else keys.union(own)
    write(spine, keys.distinct())


def write_blocks(df: DataFrame, path: str, epoch: int, block_rows: int = BLOCK_ROWS) -> None:
    """A11 (re-aimed external insert): append a micro-batch as parquet files
    of at most ``block_rows`` rows, under its own epoch partition."""
    (
        df.withColumn("epoch", F.lit(epoch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", block_rows)
        .partitionBy("epoch")
        .parquet(path)
    )


def write_sets(sets: dict[str, DataFrame], path: str) -> None:
    """Persist the long set tables (one folder per kind)."""
    for kind, t in sets.items():
        t.write.mode("overwrite").parquet(f"{path}/{kind}")


def rows_to_records(df: DataFrame) -> DataFrame:
    """One JSON record per row."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("record"))


def day_files(spark: SparkSession, path: str) -> list[str]:
    """A2: the day files under ``path`` sorted by name (a listing, no data read)."""
    return sorted(spark.read.format("binaryFile").load(path).select("path").inputFiles())
