"""Stand-in inputs built from the driver's test tables.

These functions only reshape test tables into the schemas the jobs expect
(query log, id lists, tabular tables, vectors, scored rows); they do none
of the jobs' work.  Mapping rules are the ones fixed in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_seconds(ts: str) -> F.Column:
    """Whole epoch seconds of a timestamp (floor), zone independent for NTZ."""
    return F.unix_timestamp(F.col(ts)).cast("long")


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> query log: file = user, customer = props.k, product = event type."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("f"), F.col("user_id").cast("string")).alias("FileID"),
        F.concat(F.lit("c"), F.get_json_object("props", "$.k")).alias("CustomerID"),
        epoch_seconds("ts").alias("QueryTs"),
        F.col("event_type").alias("ProductID"),
    )


def log_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem JOIN orders -> query log (the scale case)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.concat(F.lit("f"), F.col("l_partkey").cast("string")).alias("FileID"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("CustomerID"),
        epoch_seconds("l_shipdate").alias("QueryTs"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("ProductID"),
    )


def ids_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train / test id list: train when user_id % 10 < 7; y = user_id % 4 == 0."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    return users.select(
        F.concat(F.lit("f"), F.col("user_id").cast("string")).alias("FileID"),
        (F.col("user_id") % 4 == 0).cast("int").alias("y"),
        F.when(F.col("user_id") % 10 < 7, "train").otherwise("test").alias("split"),
    )


def ids_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same rule on part keys for the lineitem log."""
    parts = table(spark, sf_dir, "lineitem").select("l_partkey").distinct()
    return parts.select(
        F.concat(F.lit("f"), F.col("l_partkey").cast("string")).alias("FileID"),
        (F.col("l_partkey") % 4 == 0).cast("int").alias("y"),
        F.when(F.col("l_partkey") % 10 < 7, "train").otherwise("test").alias("split"),
    )


def tabular_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part with planted NULLs (p_size when key % 7 = 0, p_brand when key % 11 = 0)."""
    p = table(spark, sf_dir, "part")
    return p.select(
        "p_partkey",
        "p_name",
        F.when(F.col("p_partkey") % 11 == 0, None).otherwise(F.col("p_brand")).alias("p_brand"),
        "p_type",
        F.when(F.col("p_partkey") % 7 == 0, None).otherwise(F.col("p_size")).alias("p_size"),
        "p_retailprice",
    )


def tabular_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer with c_acctbal NULL when key % 7 = 0; group = c_mktsegment."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        F.when(F.col("c_custkey") % 7 == 0, None).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        "c_mktsegment",
    )


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic score ``value/600`` clipped to [0,1]; label purchase."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.least(F.greatest(F.col("value") / 600.0, F.lit(0.0)), F.lit(1.0)).alias("score"),
        (F.col("event_type") == "purchase").cast("int").alias("label"),
    )


def embedding_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings with binary target ``y = label < 3``."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "embedding", "label", (F.col("label") < 3).cast("int").alias("y"))


# Fixture grade map for the ordinal-map check (p_type -> -1..3; LARGE unmapped).
PART_TYPE_GRADES = {"PROMO": 3, "STANDARD": 2, "MEDIUM": 1, "ECONOMY": 0, "SMALL": -1}


def lineitem_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar fields of the lineitem log (ship dates are whole days)."""
    from logweave.functions.calendar import hour_of, weekday_of

    log = log_lineitem(spark, sf_dir)
    return log.select("FileID", "QueryTs", hour_of("QueryTs").alias("hour"), weekday_of("QueryTs").alias("weekday"))
