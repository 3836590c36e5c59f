"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from logweave.session import ensure_checkpoint_dir


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: the lineage ends there, so a lost
    executor costs its own tasks and the table's columns are read one by one."""
    spark, path = df.sparkSession, work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: pa.Array | pa.ChunkedArray) -> Iterator[bytes]:
    """The UTF-8 bytes of each text; null is empty."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def strings(column: pa.Array | pa.ChunkedArray) -> Iterator[str]:
    """Each text; null is empty, bytes that aren't UTF-8 become U+FFFD."""
    for value in utf8(column):
        yield value.decode("utf-8", "replace")


def spans(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive runs of rows of at most ``limit`` bytes each, or one larger row."""
    start = total = at = 0
    for at, size in enumerate(sizes):
        if at > start and total + size > limit:
            yield start, at
            start, total = at, 0
        total += size
    if total or at >= start:
        yield start, at + 1
