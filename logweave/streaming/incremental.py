"""Structured Streaming twins of the incremental (day-file) paths.

Day files arrive in a folder; ``readStream`` takes ``files_per_trigger``
files per micro-batch (the reference's n-file batches).  Every sink here
is a parquet table in a shared folder (never the driver), and each path is
built so that its final table equals the one-pass batch result:

* I2 facts per (day, FileID) appended per micro-batch (``foreachBatch``,
  idempotent: each epoch overwrites only its own partition);
* I3 intervals from additive (FileID, second, count) facts, equal to a
  one-pass ``lag`` whatever the order in which files arrive (``stateful``
  has the twin with carried state, which never reads history);
* I4 growing distinct sets via streaming ``dropDuplicates`` (``stateful``: with
  bounded state);
* I5 growing corpus as additive ``(doc, token, tf)`` facts;
* I1 tumbling-window counts as additive facts (no late row is lost);
* I6 hopping windows as additive facts per step, late rows counted;
* I7 score histogram facts for a binned AUC.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.operators.batches import SECONDS_PER_DAY
from logweave.operators.tfidf import tokens_of
from logweave.session import ensure_checkpoint_dir
from logweave.sources.log import LOG_DDL, clean_log


def scratch(spark: SparkSession, name: str) -> str:
    """Fresh folder under the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "logweave-stream", f"{name}-{uuid.uuid4().hex[:8]}")


def stage_day_files(log: DataFrame, path: str, ts: str = "QueryTs") -> str:
    """Write a log as headerless CSV day files ``day=<d>/part-*.csv`` (a large day as
    several files), their modification times in the order of days.

    The file source takes files by modification time.  The log is dealt by day
    in one pass first; the days' files are then written by one job, which moves no
    rows, and get times a second apart per day.  A store that doesn't set times
    has the days written one after another (a loop over the distinct days, bounded
    by the calendar).  Used to feed streams from the test tables; in
    production day files arrive in order by themselves.
    """
    spark, dealt = log.sparkSession, path.rstrip("/") + "-by-day"
    dated = log.withColumn("day", F.floor(F.col(ts) / SECONDS_PER_DAY).cast("long")).where("day is not null")
    dated.hint("rebalance", "day").write.partitionBy("day").parquet(dealt)
    own = spark.read.schema(dated.schema).parquet(dealt)
    own.write.mode("overwrite").option("header", False).partitionBy("day").csv(path)
    days = listed_by_day(spark, path)
    if not timed_by_day(spark, days):
        for d, _ in days:
            one = spark.read.schema(log.schema).parquet(os.path.join(dealt, f"day={d}"))
            one.write.mode("overwrite").option("header", False).csv(os.path.join(path, f"day={d}"))
    return path


def listed_by_day(spark: SparkSession, path: str) -> list[tuple[int, list[str]]]:
    """Days of the folders ``day=<d>`` below ``path`` in order, with their files."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [s.getPath() for s in fs.listStatus(where) if s.getPath().getName().startswith("day=")]
    return sorted((int(f.getName()[4:]), [s.getPath().toString() for s in fs.listStatus(f)]) for f in folders)


def timed_by_day(spark: SparkSession, days: list[tuple[int, list[str]]]) -> bool:
    """Sets the files' modification times a second apart per day, the last now; whether
    their store did so."""
    last = int(time.time()) * 1000
    for k, (_, files) in enumerate(days):
        at = last - (len(days) - 1 - k) * 1000
        for name in files:
            file = spark._jvm.org.apache.hadoop.fs.Path(name)
            fs = file.getFileSystem(spark._jsc.hadoopConfiguration())
            fs.setTimes(file, at, -1)
            if fs.getFileStatus(file).getModificationTime() != at:
                return False
    return True


def read_day_stream(spark: SparkSession, path: str, ddl: str, files_per_trigger: int = 1) -> DataFrame:
    """Streaming read of headerless CSV day files (``day`` from the folder)."""
    return (
        spark.readStream.schema(ddl + ", day long")
        .option("header", False)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("basePath", path)
        .csv(path)
    )


def read_log_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Streaming query log over day files."""
    return clean_log(read_day_stream(spark, path, LOG_DDL, files_per_trigger))


def run(writer, checkpoint: str) -> None:
    """Process everything available, then stop (``availableNow``)."""
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
PARTITIONS = "spark.sql.shuffle.partitions"


def state_partitions(spark: SparkSession) -> int:
    """Partitions of a stream's state: one wave of tasks.  Every micro-batch opens and
    commits the store of each partition, also of those it has no rows for; a store
    keeps its rows on disk.  ``spark.logweave.state.partitions`` gives another number,
    for a checkpoint that begins on fewer cores than it will have."""
    own = spark.conf.get("spark.logweave.state.partitions", None)
    return int(own) if own else max(1, min(int(spark.conf.get(PARTITIONS)), spark.sparkContext.defaultParallelism))


def with_rocksdb(spark: SparkSession, start: Callable[[], None]) -> None:
    """Runs a stream with the RocksDB store in ``state_partitions`` (a checkpoint keeps
    the number it began with); the session's settings come back."""
    own = {PROVIDER: ROCKSDB, PARTITIONS: str(state_partitions(spark))}
    before = {name: spark.conf.get(name, None) for name in own}
    try:
        for name, value in own.items():
            spark.conf.set(name, value)
        start()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def write_epoch(facts: DataFrame, out: str, epoch: int) -> None:
    """Facts of one micro-batch under ``epoch=<id>``: a replayed epoch replaces its
    own output instead of duplicating it (dynamic partition overwrite)."""
    (
        facts.withColumn("epoch", F.lit(epoch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("epoch")
        .parquet(out)
    )


# ----------------------------------------------------------------------- I2
def stream_daily_facts(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Rows per (day, FileID), appended per micro-batch.

    Each epoch writes ``epoch=<id>`` with dynamic partition overwrite, so a
    replayed epoch replaces its own output instead of duplicating it.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        facts = batch.groupBy("day", "FileID").agg(F.count(F.lit(1)).alias("FileIDCountDaily"))
        write_epoch(facts, out, epoch)

    run(stream.writeStream.foreachBatch(write), checkpoint)


# ----------------------------------------------------------------------- I3
def stream_intervals(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Events per (FileID, second), appended per micro-batch.

    Intervals need neighbours in time, and a day may come in several files, late
    or out of order; so the stream stores additive counts (idempotent per
    epoch) and :func:`read_intervals` takes the differences of the merged
    seconds.  Nothing is carried between epochs.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        facts = batch.select("FileID", "QueryTs").dropna().groupBy("FileID", "QueryTs").agg(F.count(F.lit(1)).alias("n"))
        write_epoch(facts, out, epoch)

    run(stream.writeStream.foreachBatch(write), checkpoint)


def read_intervals(spark: SparkSession, out: str) -> DataFrame:
    """``(FileID, QueryTs, n, QueryTsInterval)``: merged seconds with their events
    and the seconds since the file's previous one (NULL at the first)."""
    from logweave.operators.intervals import step_intervals

    counts = spark.read.parquet(out).groupBy("FileID", "QueryTs").agg(F.sum("n").alias("n"))
    return step_intervals(counts, ["FileID"], "QueryTsInterval")


# ----------------------------------------------------------------------- I4
def stream_distinct(stream: DataFrame, cols: list[str], out: str, checkpoint: str) -> None:
    """Growing distinct set: the state store remembers members seen (RocksDB: a
    micro-batch writes its own members, not a copy of all)."""
    d = stream.select(*cols).dropDuplicates(cols)
    with_rocksdb(stream.sparkSession, lambda: run(d.writeStream.format("parquet").option("path", out).outputMode("append"), checkpoint))


# ----------------------------------------------------------------------- I5
def stream_corpus(stream: DataFrame, field: str, out: str, checkpoint: str) -> None:
    """Additive corpus facts ``(doc, token, tf)`` per micro-batch; the corpus
    at any time is their sum (see :func:`read_corpus`)."""

    def write(batch: DataFrame, epoch: int) -> None:
        tf = (
            batch.where(F.col(field).isNotNull())
            .select(F.col(field).cast("string").alias("doc"), tokens_of("FileID").alias("token"))
            .groupBy("doc", "token")
            .agg(F.count(F.lit(1)).alias("tf"))
        )
        write_epoch(tf, out, epoch)

    run(stream.writeStream.foreachBatch(write), checkpoint)


def read_corpus(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).groupBy("doc", "token").agg(F.sum("tf").alias("tf"))


# ----------------------------------------------------------------------- I1
def stream_tumbling(stream: DataFrame, days: int, out: str, checkpoint: str) -> None:
    """Events per FileID in n-day tumbling windows (event time), as additive
    facts per micro-batch; :func:`read_tumbling` sums them.  All windows are
    there, the last and late rows included."""
    width = days * SECONDS_PER_DAY

    def write(batch: DataFrame, epoch: int) -> None:
        start = (F.floor(F.col("QueryTs") / width) * width).cast("long")
        facts = batch.groupBy(start.alias("window_start"), "FileID").agg(F.count(F.lit(1)).alias("n"))
        write_epoch(facts, out, epoch)

    run(stream.writeStream.foreachBatch(write), checkpoint)


def read_tumbling(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).groupBy("window_start", "FileID").agg(F.sum("n").alias("n"))


# ----------------------------------------------------------------------- I6
def stream_hopping(stream: DataFrame, width: int, step: int, out: str, checkpoint: str, lateness: int = 0) -> None:
    """Events per FileID in windows of ``width`` seconds every ``step`` (a divisor),
    as additive facts per step; :func:`read_hopping` composes the windows.

    No row is dropped.  ``late`` counts those that came more than ``lateness``
    seconds behind the newest event of earlier micro-batches: the windows
    they changed may have been read before."""
    if width % step:
        raise ValueError("the step must divide the width")

    def write(batch: DataFrame, epoch: int) -> None:
        newest = None
        if epoch:
            newest = batch.sparkSession.read.schema(HOPPING_DDL).parquet(out).where(F.col("epoch") < epoch).agg(F.max("last")).first()[0]
        late = F.lit(0) if newest is None else (F.col("QueryTs") < newest - lateness).cast("int")
        start = (F.floor(F.col("QueryTs") / step) * step).cast("long")
        facts = batch.where(F.col("QueryTs").isNotNull()).groupBy("FileID", start.alias("pane"))
        facts = facts.agg(F.count(F.lit(1)).alias("n"), F.max("QueryTs").alias("last"), F.sum(late).cast("long").alias("late"))
        write_epoch(facts, out, epoch)

    run(stream.writeStream.foreachBatch(write), checkpoint)


HOPPING_DDL = "FileID string, pane long, n long, last long, late long, epoch int"


def read_hopping(spark: SparkSession, out: str, width: int, step: int) -> DataFrame:
    """``(window_start, FileID, n, late)`` of all windows with an event.  A pane adds
    to ``width / step`` windows; it is summed before it fans out."""
    panes = spark.read.schema(HOPPING_DDL).parquet(out).groupBy("FileID", "pane").agg(F.sum("n").alias("n"), F.sum("late").alias("late"))
    starts = F.sequence(F.col("pane") - F.lit(width - step), F.col("pane"), F.lit(step).cast("long"))
    windows = panes.select("FileID", "n", "late", F.explode(starts).alias("window_start"))
    return windows.groupBy("window_start", "FileID").agg(F.sum("n").alias("n"), F.sum("late").alias("late"))


# ----------------------------------------------------------------------- I7
def stream_histogram(stream: DataFrame, out: str, checkpoint: str, bins: int = 200) -> None:
    """Per micro-batch score histogram facts ``(bin, pos, neg)``."""

    def write(batch: DataFrame, epoch: int) -> None:
        b = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
        h = batch.groupBy(b.alias("bin")).agg(
            F.sum(F.col("label").cast("long")).alias("pos"), F.sum((1 - F.col("label")).cast("long")).alias("neg")
        )
        write_epoch(h, out, epoch)

    run(stream.writeStream.foreachBatch(write), checkpoint)


def stream_into(
    spark: SparkSession,
    name: str,
    log: DataFrame,
    sink: Callable[[DataFrame, str, str], None],
    files_per_trigger: int = 1,
) -> str:
    """Stage ``log`` as day files, stream them through ``sink``; return the
    sink folder."""
    base = scratch(spark, name)
    src = stage_day_files(log, os.path.join(base, "in"))
    out = os.path.join(base, "out")
    sink(read_log_stream(spark, src, files_per_trigger), out, os.path.join(base, "ckpt"))
    return out
