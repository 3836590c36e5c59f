"""Streams with carried and bounded state against one-pass answers."""

import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logweave.operators.intervals import open_intervals
from logweave.sources.log import LOG_DDL
from logweave.streaming import incremental as I
from logweave.streaming import stateful as ST

DAY = 86400


def lag_counts(events):
    at = sorted(events)
    return Counter(b - a for a, b in zip(at, at[1:]))


@pytest.mark.parametrize("seed", range(5))
def test_interval_changes_equal_lag(seed):
    rng = random.Random(seed)
    events = [rng.randrange(500) for _ in range(200)]
    known, trimmed, total, late = np.empty(0, np.int64), False, Counter(), 0
    for at in range(0, 200, 20):  # any order: nothing is trimmed within keep
        part = Counter(events[at : at + 20])
        seconds = np.array(sorted(part), np.int64)
        change, lost, known, trimmed = ST.interval_changes(known, trimmed, seconds, np.array([part[s] for s in seconds.tolist()]), 1000)
        for k, n in change.items():
            total[k] += n
        late += lost
    assert {k: n for k, n in total.items() if n} == dict(lag_counts(events)) and late == 0


def test_interval_changes_forget_what_is_old():
    rng = random.Random(9)
    events = sorted(rng.randrange(100_000) for _ in range(3000))
    known, trimmed, total = np.empty(0, np.int64), False, Counter()
    for at in range(0, 3000, 100):
        part = events[at : at + 100]
        rng.shuffle(part)
        for some in (part[:50], part[50:]):
            count = Counter(some)
            seconds = np.array(sorted(count), np.int64)
            change, lost, known, trimmed = ST.interval_changes(known, trimmed, seconds, np.array([count[s] for s in seconds.tolist()]), 8000)
            total.update(change)
            assert lost == 0 and len(known) < 400  # of 3000
    assert {k: n for k, n in total.items() if n} == dict(lag_counts(events))
    change, lost, after, _ = ST.interval_changes(known, trimmed, np.array([5]), np.array([7]), 8000)
    assert change == {} and lost == 7 and after.tolist() == known.tolist()


def test_files_of_a_group_are_worked_on_together():
    rng = random.Random(5)
    events = [(rng.randrange(6), rng.randrange(4000)) for _ in range(900)]
    events.sort(key=lambda e: e[1] // 400)
    known, trimmed, total = (np.empty(0, np.int64), np.empty(0, np.int64)), np.zeros(6, bool), Counter()
    single = [(np.empty(0, np.int64), False) for _ in range(6)]
    for at in range(0, 900, 60):
        part = Counter(events[at : at + 60] + [(2, 1)] * (at == 840))
        f, s, c = (np.array(x, np.int64) for x in zip(*[(*k, n) for k, n in sorted(part.items())]))
        (cf, cv, cn), late, known, trimmed = ST.changes_of_files(known, trimmed, (f, s, c), 900)
        got = {(a, b): n for a, b, n in zip(cf.tolist(), cv.tolist(), cn.tolist())}
        want = {}
        for i in range(6):
            own = f == i
            change, lost, *single[i] = ST.interval_changes(*single[i], s[own], c[own], 900)
            want |= {(i, v): n for v, n in change.items()}
            assert lost == late[i] and single[i][0].tolist() == known[1][known[0] == i].tolist() and single[i][1] == trimmed[i]
        assert got == want
        total.update(got)
    want = Counter((i, v) for i in range(6) for v, n in lag_counts([t for k, t in events if k == i]).items() for _ in range(n))
    assert trimmed.all() and {k: n for k, n in total.items() if n} == dict(want)


def write_part(spark, rows, folder, day, mtime):
    spark.createDataFrame(rows, LOG_DDL).coalesce(1).write.csv(f"{folder}/part{mtime}")
    os.makedirs(f"{folder}/in/day={day}", exist_ok=True)
    for name in os.listdir(f"{folder}/part{mtime}"):
        if name.endswith(".csv"):
            to = f"{folder}/in/day={day}/{mtime}-{name}"
            os.link(f"{folder}/part{mtime}/{name}", to)
            os.utime(to, (mtime, mtime))


def test_carried_intervals_with_split_days_and_late_files(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"f{rng.randrange(4)}", "c", day * DAY + rng.randrange(200) * 400, "p") for day in range(6) for _ in range(40)]
    rows += [("hot", "c", day * DAY + rng.randrange(50), "p") for day in range(6) for _ in range(100)] + [("once", "c", 7, "p")]
    parts = {}
    for r in rows:
        day = r[2] // DAY
        parts.setdefault((day, rng.randrange(2)), []).append(r)
    order = sorted(parts)
    order[2], order[4] = order[4], order[2]  # a part of day 1 comes after one of day 2
    base = str(tmp_path)
    for k, part in enumerate(order):
        write_part(spark, parts[part], base, part[0], 1_700_000_000 + k * 100)
    ST.carried_intervals(I.read_log_stream(spark, f"{base}/in"), f"{base}/out", f"{base}/ckpt")
    got = {(r.FileID, r.QueryTsInterval): r.n for r in ST.read_carried(spark, f"{base}/out").collect()}
    log = spark.createDataFrame(rows, LOG_DDL)
    want = Counter((r.FileID, r.QueryTsInterval) for r in open_intervals(log).collect())
    assert got == dict(want) and ST.late_events(spark, f"{base}/out").collect() == []
    epochs = spark.read.parquet(f"{base}/out").groupBy("epoch").agg(F.sum(F.abs("n")).alias("n")).collect()
    assert len(epochs) == len(order) and max(r.n for r in epochs) < len(rows) / 2  # each batch writes its own changes only
    write_part(spark, [("hot", "c", 3, "p")] * 2, base, 0, 1_800_000_000)  # days too late
    ST.carried_intervals(I.read_log_stream(spark, f"{base}/in"), f"{base}/out", f"{base}/ckpt")
    assert [tuple(r) for r in ST.late_events(spark, f"{base}/out").collect()] == [("hot", 2)]
    again = {(r.FileID, r.QueryTsInterval): r.n for r in ST.read_carried(spark, f"{base}/out").collect()}
    assert again == got


def test_member_state_stays_flat(spark, tmp_path):
    base = str(tmp_path)
    rows = lambda day: [(f"f{i}", f"c{(day * 5 + i) % 200}", day * DAY, "p") for i in range(12)] + [(None, None, day * DAY, "p")]
    for day in range(30):
        write_part(spark, rows(day), base, day, 1_700_000_000 + day * DAY)
    stream = ST.with_arrival(I.read_day_stream(spark, f"{base}/in", LOG_DDL))
    sizes = ST.stream_members(stream, ["CustomerID", "ProductID"], f"{base}/out", f"{base}/ckpt")
    assert len(sizes) >= 30 and max(sizes[10:]) <= max(sizes[:10]) + 12 < 80  # of 151 members
    got = spark.read.parquet(f"{base}/out").select("CustomerID", "ProductID").collect()
    want = {(r[1], r[3]) for day in range(30) for r in rows(day)}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_hopping_windows_count_late_rows(spark, tmp_path):
    base = str(tmp_path)
    write_part(spark, [("a", "c", t, "p") for t in (0, 90, 150)], base, 0, 1_700_000_000)
    write_part(spark, [("a", "c", t, "p") for t in (20, 155, 290)], base, 1, 1_700_000_100)
    I.stream_hopping(I.read_log_stream(spark, f"{base}/in"), 100, 50, f"{base}/out", f"{base}/ckpt", lateness=60)
    got = {r.window_start: (r.n, r.late) for r in I.read_hopping(spark, f"{base}/out", 100, 50).collect()}
    events = [0, 90, 150, 20, 155, 290]
    assert got == {
        s: (sum(s <= t < s + 100 for t in events), int(s <= 20 < s + 100)) for s in range(-50, 300, 50) if any(s <= t < s + 100 for t in events)
    }
    with pytest.raises(ValueError):
        I.stream_hopping(I.read_log_stream(spark, f"{base}/in"), 100, 30, f"{base}/out", f"{base}/ckpt")


def test_members_are_merged_once_per_run(spark, tmp_path):
    base = str(tmp_path)
    run = lambda: ST.stream_members(ST.with_arrival(I.read_day_stream(spark, f"{base}/in", LOG_DDL)), ["CustomerID", "ProductID"], f"{base}/out", f"{base}/ckpt")
    for day in range(3):
        write_part(spark, [("f", f"c{day + i}", 0, "p") for i in range(2)] + [("f", None, 0, None)], base, day, 1_700_000_000 + day * DAY)
    run()
    table = lambda: Counter((r.CustomerID, r.ProductID, r.epoch) for r in spark.read.parquet(f"{base}/out").collect())
    first = table()
    assert {(c, p) for c, p, _ in first} == {*((f"c{i}", "p") for i in range(4)), (None, None)} and len(first) == 5
    assert len({e for *_, e in first}) == 1  # the table is not read again for every micro-batch
    write_part(spark, [("f", "c0", 0, "p"), ("f", None, 0, None), ("f", "new", 0, "p")], base, 9, 1_800_000_000)  # forgotten by the store
    run()
    added = table() - first
    assert table() == first + added and [(c, p) for c, p, _ in added] == [("new", "p")]


def test_distinct_set_keeps_its_state_in_rocksdb(spark, tmp_path):
    base = str(tmp_path)
    for day in range(2):
        write_part(spark, [("f", f"c{day + i}", 0, "p") for i in range(2)], base, day, 1_700_000_000 + day * DAY)
    before = spark.conf.get(I.PROVIDER, None)
    I.stream_distinct(I.read_log_stream(spark, f"{base}/in"), ["CustomerID"], f"{base}/out", f"{base}/ckpt")
    assert sorted(r.CustomerID for r in spark.read.parquet(f"{base}/out").collect()) == ["c0", "c1", "c2"]
    names = [name for _, _, files in os.walk(f"{base}/ckpt/state") for name in files]
    assert any(n.endswith(".zip") for n in names) and not any(n.endswith(".delta") for n in names)
    assert spark.conf.get(I.PROVIDER, None) == before


def test_days_are_dealt_in_one_pass(spark, tmp_path):
    rows = [("f", "c", t, "p") for t in (0, 5, DAY + 1, -1)] + [("f", "c", None, "p")]
    log = spark.createDataFrame(rows, LOG_DDL)
    path = I.stage_day_files(log, f"{tmp_path}/in")
    day = lambda d: sorted(r.QueryTs for r in spark.read.schema(LOG_DDL).csv(f"{path}/day={d}").collect())
    assert [day(d) for d in (-1, 0, 1)] == [[-1], [0, 5], [DAY + 1]]
    assert sorted(n for n in os.listdir(f"{path}-by-day") if n.startswith("day=")) == ["day=-1", "day=0", "day=1"]
    times = [max(os.stat(f"{path}/day={d}/{n}").st_mtime_ns for n in os.listdir(f"{path}/day={d}") if n.endswith(".csv")) for d in (-1, 0, 1)]
    assert times == sorted(times)


def test_days_are_written_by_one_job(spark, tmp_path):
    rows = [("f", None, day * DAY + k, "p,\"q") for day in (-2, 0, 1, 3, 10) for k in range(3)]
    log, seen = spark.createDataFrame(rows, LOG_DDL), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("staging", "staging")
    try:
        path = I.stage_day_files(log, f"{tmp_path}/in")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(seen.getJobIdsForGroup("staging")) < 5  # not one per day
    days = I.listed_by_day(spark, path)
    assert [d for d, _ in days] == [-2, 0, 1, 3, 10]
    times = [{os.stat(f.removeprefix("file:")).st_mtime for f in files} for _, files in days]
    assert all(len(t) == 1 for t in times) and [max(t) for t in times] == sorted({max(t) for t in times})
    assert sorted(spark.read.schema(LOG_DDL).csv(path).select("FileID", "CustomerID", "QueryTs", "ProductID").collect()) == sorted(rows)


def test_days_come_in_order_from_a_store_without_times(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "timed_by_day", lambda *_: False)
    log = spark.createDataFrame([("f", "c", d * DAY, "p") for d in (2, 0, -1, 10)], LOG_DDL)
    days = I.listed_by_day(spark, I.stage_day_files(log, f"{tmp_path}/in"))
    times = [os.stat(f.removeprefix("file:")).st_mtime_ns for _, files in days for f in files if f.endswith(".csv")]
    assert len(times) == 4 and times == sorted(times)


@pytest.mark.parametrize("kind", ["distinct", "members", "carried"])
def test_state_takes_one_wave_of_tasks(spark, tmp_path, kind):
    base = str(tmp_path)
    for day in range(2):
        write_part(spark, [("f", f"c{day + i}", day * DAY + i, "p") for i in range(2)], base, day, 1_700_000_000 + day * DAY)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        stream = I.read_log_stream(spark, f"{base}/in")
        if kind == "distinct":
            I.stream_distinct(stream, ["CustomerID"], f"{base}/out", f"{base}/ckpt")
        elif kind == "members":
            ST.stream_members(ST.with_arrival(I.read_day_stream(spark, f"{base}/in", LOG_DDL)), ["CustomerID"], f"{base}/out", f"{base}/ckpt")
        else:
            ST.carried_intervals(stream, f"{base}/out", f"{base}/ckpt")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "23"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    stores = [n for n in os.listdir(f"{base}/ckpt/state/0") if n.isdigit()]
    assert len(stores) == spark.sparkContext.defaultParallelism < 23


def test_state_partitions_can_be_set(spark):
    spark.conf.set("spark.logweave.state.partitions", "9")
    try:
        assert I.state_partitions(spark) == 9
    finally:
        spark.conf.unset("spark.logweave.state.partitions")
    assert I.state_partitions(spark) <= spark.sparkContext.defaultParallelism
