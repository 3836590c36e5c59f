import os

from pyspark.sql import functions as F


def test_etl_end_to_end(spark, tmp_path):
    from logweave.plans import etl
    from logweave.sources.fixtures import ids_events, log_events
    from logweave.streaming.incremental import stage_day_files

    d = "/root/testdata/sf0.001"
    log_dir = stage_day_files(log_events(spark, d), str(tmp_path / "log"))
    ids = ids_events(spark, d)
    for split in ("train", "test"):
        ids.where(F.col("split") == split).select("FileID", "y").coalesce(1).write.csv(str(tmp_path / split))
    out = str(tmp_path / "out")
    path = etl.run(spark, log_dir, str(tmp_path / "train"), str(tmp_path / "test"), out)
    table = spark.read.parquet(path)
    assert table.count() == ids.count()
    assert "QueryTsIntervalMean" in table.columns and "FileIDCountDaily_sum" in table.columns
    assert not [c for c in table.columns if "percentage" in c]
    assert {"split=test", "split=train"} <= set(os.listdir(os.path.join(out, "series")))
