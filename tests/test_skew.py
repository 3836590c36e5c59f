"""A file holding a third of all rows: results stay exact and no plan step
moves whole data into a single partition."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from logweave.functions.stats import F12
from logweave.operators.intervals import interval_features, interval_name


@pytest.fixture(scope="module")
def skewed(spark):
    from logweave.sources.fixtures import log_events

    log = log_events(spark, "/root/testdata/sf0.01")
    hot = F.when(F.abs(F.hash("QueryTs")) % 3 == 0, F.lit("fhot")).otherwise(F.col("FileID"))
    return log.withColumn("FileID", hot).cache()


def test_hot_file_interval_features_exact(spark, skewed):
    got = {r.FileID: r for r in interval_features(skewed, chunk_seconds=600).collect()}
    pdf = skewed.select("FileID", "QueryTs").toPandas().sort_values("QueryTs", kind="stable")
    pdf["d"] = pdf.groupby("FileID")["QueryTs"].diff()
    hot = pdf[pdf.FileID == "fhot"]["d"].dropna().astype(float)
    assert len(hot) > len(pdf) / 4
    r = got["fhot"]
    mu = hot.mean()
    assert r[interval_name("count", "")] == len(hot)
    assert r[interval_name("mean", "")] == pytest.approx(mu)
    assert r[interval_name("std", "")] == pytest.approx(hot.std())
    assert r[interval_name("mad", "")] == pytest.approx((hot - mu).abs().mean())
    assert r[interval_name("skew", "")] == pytest.approx(hot.skew())
    assert r[interval_name("median", "")] == pytest.approx(hot.median())
    assert r[interval_name("percentile_75", "")] == pytest.approx(np.percentile(hot, 75))
    assert r[interval_name("nunique", "")] == hot.nunique()


def test_no_single_partition_exchange_over_rows(spark, skewed):
    df = interval_features(skewed)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert set(F12) and len(df.columns) == 1 + len(F12)


def test_writers_split_a_hot_partition(spark, tmp_path):
    from logweave.sources import sinks as SK

    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        rows = spark.range(200_000).repartition(8).selectExpr(
            "concat('f', id % 1000) as FileID", "id as QueryTs", "'c' || id as CustomerID", "'p' as ProductID",
            "if(id % 100 = 0, 'test', 'train') as split", "'tight' as typ", "0L as day",
        )
        SK.write_split_series(rows, str(tmp_path / "s"))
        SK.write_filtered_log(rows, str(tmp_path / "l"))
        assert len(list((tmp_path / "s" / "split=train").glob("part-*"))) > 4
        assert len(list((tmp_path / "l" / "typ=tight" / "day=0").glob("part-*"))) > 4
        assert spark.read.parquet(str(tmp_path / "s")).count() == 200_000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
