"""Readers for query logs, id lists, feature tables and tabular CSVs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_DDL = "FileID string, CustomerID string, QueryTs long, ProductID string"
IDS_DDL = "FileID string, y int"

# Fixed value of the reference's clean step: one product id with a leading zero.
PRODUCT_ID_FIXES = {"055649": "55649"}


def clean_log(df: DataFrame) -> DataFrame:
    """ProductID as string and the reference's fixed value replacement.

    The reference replaces the value in every column; only the string id
    columns can hold it.
    """
    df = df.withColumn("ProductID", F.col("ProductID").cast("string"))
    cols = [c for c in ("FileID", "CustomerID", "ProductID") if c in df.columns]
    return df.replace(PRODUCT_ID_FIXES, subset=cols)


def read_query_log(spark: SparkSession, path: str, clean: bool = True, mode: str = "FAILFAST") -> DataFrame:
    """Headerless day-file CSV logs -> ``FileID, CustomerID, QueryTs, ProductID, day``.

    ``day`` is the file name without extension (``MMDD``), or the ``day=``
    folder when the files are laid out by day; the reference orders day
    files by name, so batches rank this column.  An empty file
    yields no rows (explicit schema, no inference), so no special case is
    needed for empty days.  A row that doesn't parse (a time that is no number)
    fails the job; ``mode="DROPMALFORMED"`` or ``"PERMISSIVE"`` are the other
    choices.
    """
    df = spark.read.schema(LOG_DDL).option("header", False).option("mode", mode).csv(path)
    if "day" not in df.columns:  # no day=... folders: the file name is the day
        df = df.withColumn("day", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1))
    return clean_log(df) if clean else df


def listed_days(spark: SparkSession, path: str) -> list[str]:
    """Day names of the day files under ``path`` from the file listing only
    (file name without extension, or the ``day=`` folder)."""
    import re

    days = set()
    for f in spark.read.format("binaryFile").load(path).select("path").inputFiles():
        m = re.search(r"/day=([^/]+)/", f)
        days.add(m.group(1) if m else re.sub(r"\.[^./]*$", "", f.rsplit("/", 1)[-1]))
    return sorted(days)


def read_id_list(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Headerless ``FileID, y`` list; the testing list's second column is ignored."""
    df = spark.read.schema(IDS_DDL).option("header", False).csv(path)
    if split == "test":
        df = df.withColumn("y", F.lit(None).cast("int"))
    if split:
        df = df.withColumn("split", F.lit(split))
    return df


def read_feature_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Feature table keyed by ``FileID`` (parquet by default, CSV with header)."""
    if fmt == "csv":
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return spark.read.parquet(path)


def read_tabular(
    spark: SparkSession, path: str, schema: str | None = None, split: str | None = None
) -> DataFrame:
    """Header CSV with a given DDL schema (inference only when none is given)."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema else r.option("inferSchema", True)
    df = r.csv(path)
    return df.withColumn("split", F.lit(split)) if split else df


def union_train_test(train: DataFrame, test: DataFrame) -> DataFrame:
    """Row union keeping the origin in ``split`` (test lacks the target column)."""
    return train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test")), allowMissingColumns=True
    )
