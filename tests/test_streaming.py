import pytest
from pyspark.sql import functions as F

from logweave.operators.intervals import open_intervals
from logweave.streaming import incremental as I


@pytest.fixture(scope="module")
def log(spark):
    rows = []
    for day in range(4):
        for k in range(12):
            f = f"f{k % 3}"
            rows.append((f, f"c{k % 5}", day * 86400 + 1000 * k + (k % 2) * 7, f"p{k % 2}"))
    rows.append(("f9", "c1", 2 * 86400 + 5, "p1"))  # file with one event only
    return spark.createDataFrame(rows, "FileID string, CustomerID string, QueryTs long, ProductID string")


def intervals_of(steps):
    out = []
    for r in steps.collect():
        out += [(r.FileID, 0)] * (r.n - 1) + ([(r.FileID, r.QueryTsInterval)] if r.QueryTsInterval is not None else [])
    return out


def test_stream_intervals_of_a_day_in_several_files(spark):
    rows = [("a", "c", t, "p") for t in range(0, 1000, 100)]
    log = spark.createDataFrame(rows, "FileID string, CustomerID string, QueryTs long, ProductID string")
    base = I.scratch(spark, "t-late")
    for part in (range(500, 1000, 100), range(0, 500, 100)):  # the later half comes first
        log.where(F.col("QueryTs").isin(list(part))).coalesce(1).write.mode("append").csv(f"{base}/in/day=0")
    I.stream_intervals(I.read_log_stream(spark, f"{base}/in"), f"{base}/out", f"{base}/ckpt")
    assert sorted(intervals_of(I.read_intervals(spark, f"{base}/out"))) == [("a", 100)] * 9


def test_stream_tumbling_has_every_window(spark, log):
    out = I.stream_into(spark, "t-tumbling", log, lambda s, o, c: I.stream_tumbling(s, 3, o, c))
    got = {(r.window_start, r.FileID): r.n for r in I.read_tumbling(spark, out).collect()}
    assert sum(got.values()) == log.count() and {w for w, _ in got} == {0, 3 * 86400}


def test_stream_intervals_equal_batch(spark, log):
    out = I.stream_into(spark, "t-iv", log, I.stream_intervals)
    got = sorted(intervals_of(I.read_intervals(spark, out)))
    exp = sorted(tuple(r) for r in open_intervals(log).select("FileID", "QueryTsInterval").collect())
    assert got == exp


def test_stream_corpus_and_sets_equal_batch(spark, log):
    out = I.stream_into(spark, "t-corpus", log, lambda s, o, c: I.stream_corpus(s, "ProductID", o, c), files_per_trigger=2)
    from logweave.operators.tfidf import corpus

    got = sorted(tuple(r) for r in I.read_corpus(spark, out).collect())
    exp = sorted(tuple(r) for r in corpus(log, "ProductID").select("doc", "token", "tf").collect())
    assert got == exp
    out2 = I.stream_into(spark, "t-set", log, lambda s, o, c: I.stream_distinct(s, ["ProductID", "CustomerID"], o, c))
    got2 = sorted(tuple(r) for r in spark.read.parquet(out2).collect())
    exp2 = sorted(tuple(r) for r in log.select("ProductID", "CustomerID").distinct().collect())
    assert got2 == exp2


def test_stream_daily_facts_idempotent_layout(spark, log):
    out = I.stream_into(spark, "t-daily", log, I.stream_daily_facts)
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("day", "FileID", "FileIDCountDaily").collect())
    exp = sorted(
        tuple(r)
        for r in log.groupBy(F.floor(F.col("QueryTs") / 86400).alias("day"), "FileID").count().collect()
    )
    assert got == exp


def test_block_sink_caps_rows_per_file(spark, log):
    from logweave.operators.tensors import per_second_counts
    from logweave.sources.sinks import write_blocks

    path = I.scratch(spark, "t-blocks")
    big = per_second_counts(log).withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(399))))
    write_blocks(big.repartition(1), path, epoch=0, block_rows=1000)
    per_file = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert sum(per_file) == big.count() and max(per_file) <= 1000 and len(per_file) > 1
