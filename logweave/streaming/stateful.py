"""Streams that carry state from one micro-batch to the next.

* I3 the last seconds of every file (``transformWithStateInPandas``): intervals
  are complete as soon as an event has come, and no history is read again;
* I4 members seen lately (``dropDuplicatesWithinWatermark``) before one merge per
  run into the member table: the state doesn't grow with the set.

Both keep their state in RocksDB, whose files live in the stream's checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from logweave.operators.batches import SECONDS_PER_DAY
from logweave.streaming.incremental import run, with_rocksdb, write_epoch

# ----------------------------------------------------------------------- I3
def changes_of_files(known: tuple, trimmed: np.ndarray, events: tuple, keep: int) -> tuple[tuple, np.ndarray, tuple, np.ndarray]:
    """What new events change in the intervals of some files, numbered from 0.

    ``known`` are their seconds so far as (file, second), sorted and distinct; only
    the latest where ``trimmed``.  ``events`` are the new ones as (file, second, count).
    Returns the counts to add as (file, interval, count): an event between two known
    seconds takes their interval back and adds two; events too late to be placed, per
    file; and the new state: the seconds of the last ``keep`` and the one before."""
    files = len(trimmed)
    kf, ks = known
    ef, es, ec = events
    first = np.full(files, np.iinfo(np.int64).min)
    starts = np.flatnonzero(np.diff(kf, prepend=-1))
    first[kf[starts]] = np.where(trimmed[kf[starts]], ks[starts], first[kf[starts]])
    late = es < first[ef]
    too_late = np.bincount(ef[late], ec[late], files).astype(np.int64)
    ef, es, ec = ef[~late], es[~late], ec[~late]
    mf, ms = np.concatenate([kf, ef]), np.concatenate([ks, es])
    order = np.lexsort((ms, mf))
    mf, ms = mf[order], ms[order]
    new = np.ones(len(mf), bool)
    new[1:] = (mf[1:] != mf[:-1]) | (ms[1:] != ms[:-1])
    mf, ms = mf[new], ms[new]
    fresh = np.bincount(mf, minlength=files) - np.bincount(kf, minlength=files)
    repeats = np.bincount(ef, ec, files).astype(np.int64) - fresh  # events in a second that has one already
    parts = [(np.arange(files), np.zeros(files, np.int64), repeats)]
    for sign, f, at in ((1, mf, ms), (-1, kf, ks)):
        same = f[1:] == f[:-1]
        parts.append((f[1:][same], np.diff(at)[same], np.full(same.sum(), sign)))
    f, v, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((v, f))
    f, v, n = f[order], v[order], n[order]
    at = np.flatnonzero((np.diff(f, prepend=-1) != 0) | (np.diff(v, prepend=-1) != 0))
    f, v, n = f[at], v[at], np.add.reduceat(n, at) if len(at) else n
    last = np.zeros(files, np.int64)
    last[mf] = ms  # of equal files the last one counts: the greatest second
    stays = ms >= last[mf] - keep
    stays[:-1] |= stays[1:] & (mf[1:] == mf[:-1])
    cut = np.bincount(mf[~stays], minlength=files) > 0
    return (f[n != 0], v[n != 0], n[n != 0]), too_late, (mf[stays], ms[stays]), trimmed | cut


def interval_changes(known: np.ndarray, trimmed: bool, seconds: np.ndarray, counts: np.ndarray, keep: int) -> tuple[dict[int, int], int, np.ndarray, bool]:
    """``changes_of_files`` for one file: the counts to add per interval, events too
    late to be placed, the seconds that stay and whether some were cut."""
    zeros = lambda x: np.zeros(len(x), np.int64)
    (_, v, n), late, (_, left), cut = changes_of_files((zeros(known), known), np.array([trimmed]), (zeros(seconds), seconds, counts), keep)
    return dict(zip(v.tolist(), n.tolist(), strict=True)), int(late[0]), left, bool(cut[0])


#: Files are dealt into so many groups by their hash: a micro-batch calls Python once per
#: group, not per file, and a group's files are worked on together.
FILE_GROUPS = 64
STATE = pa.schema([("FileID", pa.string()), ("trimmed", pa.bool_()), ("seconds", pa.list_(pa.int64()))])


class IntervalState(StatefulProcessor):
    """Carries the latest seconds of a group of files; gives changes of their interval
    counts."""

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("seconds", "files binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new = pd.concat(list(rows)).groupby(["FileID", "QueryTs"], as_index=False)["n"].sum()
        code, names = pd.factorize(new["FileID"])
        before = pa.ipc.open_stream(bytes(self.state.get()[0])).read_all() if self.state.exists() else STATE.empty_table()
        before = before.combine_chunks()
        # Files with new events take part, the others' state stays as it is.
        place = pd.Index(names).get_indexer(before["FileID"].to_pylist())
        hit = place >= 0
        own, place = before.filter(pa.array(hit)), place[hit]
        trimmed = np.zeros(len(names), bool)
        trimmed[place] = own["trimmed"].to_numpy()
        lists = own["seconds"].combine_chunks()
        file, second = np.repeat(place, lists.value_lengths().to_numpy(zero_copy_only=False)), lists.flatten().to_numpy()
        order = np.argsort(file, kind="stable")
        events = (code, new["QueryTs"].to_numpy(np.int64), new["n"].to_numpy(np.int64))
        (f, v, n), late, (file, second), trimmed = changes_of_files((file[order], second[order]), trimmed, events, self.keep)
        ends = np.searchsorted(file, np.arange(len(names) + 1)).astype(np.int32)
        after = pa.table([pa.array(names, pa.string()), pa.array(trimmed), pa.ListArray.from_arrays(pa.array(ends), pa.array(second))], schema=STATE)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, STATE) as out:
            out.write_table(pa.concat_tables([before.filter(pa.array(~hit)), after]))
        self.state.update((sink.getvalue().to_pybytes(),))
        behind = np.flatnonzero(late)
        facts = {"FileID": np.concatenate([names[f], names[behind]]), "QueryTsInterval": pd.array([*v.tolist(), *[None] * len(behind)], "Int64")}
        yield pd.DataFrame(facts | {"n": np.concatenate([n, 0 * behind]), "late": np.concatenate([0 * n, late[behind]])})

    def close(self) -> None:
        pass


CHANGES = "FileID string, QueryTsInterval bigint, n bigint, late bigint"


def seconds_of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A combiner before the shuffle: events per file and second of each batch, so
    that a hot file sends at most its distinct seconds."""
    for b in batches:
        b = b.dropna()
        yield b.groupby(["FileID", "QueryTs"], as_index=False).size().rename(columns={"size": "n"}).astype({"QueryTs": "int64", "n": "int64"})


def carried_intervals(stream: DataFrame, out: str, checkpoint: str, keep: int = 2 * SECONDS_PER_DAY) -> None:
    """Interval counts per file, as additive changes per micro-batch.

    State per file: its distinct seconds of the last ``keep`` seconds before its
    newest event, and the one before those.  Files may come in several parts and
    out of order within ``keep``: the sum of changes is that of a one-pass
    ``lag``.  Events further behind can't be placed; they are counted as ``late``
    (``stream_intervals`` keeps all history and places them)."""

    def start() -> None:
        facts = stream.select("FileID", "QueryTs").mapInPandas(seconds_of_batches, "FileID string, QueryTs bigint, n bigint")
        group = F.pmod(F.xxhash64("FileID"), F.lit(FILE_GROUPS)).cast("int")
        changes = facts.withColumn("group", group).groupBy("group").transformWithStateInPandas(
            statefulProcessor=IntervalState(keep), outputStructType=CHANGES, outputMode="Append", timeMode="None"
        )

        def write(batch: DataFrame, epoch: int) -> None:
            write_epoch(batch.groupBy("FileID", "QueryTsInterval").agg(F.sum("n").alias("n"), F.sum("late").alias("late")), out, epoch)

        run(changes.writeStream.foreachBatch(write).outputMode("append"), checkpoint)

    with_rocksdb(stream.sparkSession, start)


def read_carried(spark: SparkSession, out: str) -> DataFrame:
    """``(FileID, QueryTsInterval, n)``: how often each interval occurs now."""
    facts = spark.read.parquet(out).where(F.col("QueryTsInterval").isNotNull())
    return facts.groupBy("FileID", "QueryTsInterval").agg(F.sum("n").alias("n")).where(F.col("n") != 0)


def late_events(spark: SparkSession, out: str) -> DataFrame:
    """``(FileID, late)``: events that came too late to be placed."""
    return spark.read.parquet(out).groupBy("FileID").agg(F.sum("late").alias("late")).where(F.col("late") > 0)


# ----------------------------------------------------------------------- I4
def stream_members(stream: DataFrame, cols: list[str], out: str, checkpoint: str, arrived: str = "arrived", horizon: str = "2 days") -> list[int]:
    """Growing distinct set with bounded state.

    ``arrived`` says when a row's file came (its modification time), so no row is
    late.  The store remembers members of the last ``horizon`` only and drops
    their repeats; the rest is kept per epoch under the checkpoint.  Once all that is
    available has come, the members the table doesn't have are added to it, under the
    run's last epoch: the table is read once per run, not per micro-batch (a replayed
    epoch, or a run that stopped before its merge, replaces its own).
    Returns the rows in the store after each micro-batch."""
    spark, sizes, recent = stream.sparkSession, [], f"{checkpoint}-recent"
    ddl = ", ".join(f"`{c}` {stream.schema[c].dataType.simpleString()}" for c in cols) + ", epoch int"

    def write(batch: DataFrame, epoch: int) -> None:
        write_epoch(batch.select(*cols).distinct(), recent, epoch)

    def merge() -> None:
        def table(path: str) -> DataFrame:
            return spark.read.schema(ddl).parquet(path) if has_files(spark, path) else spark.createDataFrame([], ddl)

        first = table(out).agg(F.max("epoch")).first()[0]
        since = table(recent).where(F.col("epoch") > (-1 if first is None else first))
        last = since.agg(F.max("epoch")).first()[0]
        if last is None:
            return
        known = table(out).select(*cols, F.lit(0).alias("_new")).unionByName(since.select(*cols, F.lit(1).alias("_new")))
        own = known.groupBy(*cols).agg(F.min("_new").alias("_new")).where("_new = 1").select(*cols)
        write_epoch(own, out, last)

    def start() -> None:
        fresh = stream.select(*cols, arrived).withWatermark(arrived, horizon).dropDuplicatesWithinWatermark(cols)
        writer = fresh.writeStream.foreachBatch(write).outputMode("append")
        q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
        if q.exception():
            raise q.exception()
        sizes.extend(p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators)

    with_rocksdb(spark, start)
    merge()
    return sizes


def has_files(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def with_arrival(stream: DataFrame, name: str = "arrived") -> DataFrame:
    """Adds the modification time of each row's file (a file source's stream)."""
    return stream.withColumn(name, F.col("_metadata.file_modification_time"))
