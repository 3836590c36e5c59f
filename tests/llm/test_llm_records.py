"""WARC archives and shards."""

import base64
import gzip
import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logweave.llm import shard, warc
from logweave.llm.common import work_path

PAGES = "page_id bigint, url string, html string, sha string"


def pages(spark):
    rows = [(5, "http://a/ü \r\n", "<p>é</p>", "x"), (2, None, "<p>é</p>", None), (9, "u", None, ""), (7, "u", "", ""), (1, "u", "\r\n\r\nWARC/1.1\r\n", "")]
    rows += [(None, "n", "<p>é</p>", ""), (None, "n", "only", ""), (2, "u", "<p>é</p>", ""), (30, "u", "y" * 3_000_000, "")]
    rows += [(100 + i, "u", "hot", "") for i in range(200)]
    return rows, spark.createDataFrame(rows, PAGES).repartition(5)


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows, least):
    first = {}
    for i, _, html, _ in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = Counter()
    for i, _, html, _ in rows:
        text = html or ""
        own = first.get(text)
        refers = own if len(text.encode()) >= least and own is not None and own != i else None
        out[(i, len(text.encode()), sha(text), "response" if refers is None else "revisit", refers)] += 1
    return out


@pytest.mark.parametrize("least", [0, 4])
def test_round_trip(spark, least):
    rows, df = pages(spark)
    got = Counter(tuple(r) for r in warc.round_trip(df, least).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())
    assert got == expected(rows, least)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_normaliser_rewrites_members(spark):
    _, df = pages(spark)
    folder = work_path(spark, "t")
    archives = warc.write_archives(warc.mark_revisits(df), f"{folder}/mono", archive_bytes=2000)
    assert archives.count() > 1
    for r in archives.collect():
        files, at = warc.opened(r.archive)
        raw = files.open_input_stream(at, compression=None).read()
        inflate = zlib.decompressobj(31)
        inflate.decompress(raw)
        assert inflate.eof and not inflate.unused_data  # one member: the whole file
    index = warc.normalise(archives, f"{folder}/members").collect()
    for archive in {r.archive for r in index}:  # the sidecar says the same
        files, at = warc.opened(archive.removesuffix(".warc.gz") + ".idx")
        with files.open_input_stream(at) as f:
            lines = [line.split("\t") for line in f.read().decode().splitlines()]
        own = [["" if v is None else str(v) for v in r[1:]] for r in sorted((r for r in index if r.archive == archive), key=lambda r: r.record)]
        assert lines == own
    assert len(index) == df.count()
    for r in index[:20]:
        files, at = warc.opened(r.archive)
        f = files.open_input_file(at)
        f.seek(r.offset)
        assert gzip.decompress(f.read(r.length)).startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode())
    ends = {}
    for r in sorted(index, key=lambda r: (r.archive, r.record)):
        assert r.offset == ends.get(r.archive, 0)
        ends[r.archive] = r.offset + r.length


def test_streamed_records(tmp_path):
    record = warc.record(1, "u", b"x" * 5000, "S", None)
    many = tmp_path / "many.gz"
    many.write_bytes(gzip.compress(record * 3) + gzip.compress(record))
    assert [p for _, p in warc.stream_records(str(many), window=7)] == [b"x" * 5000] * 4
    cut = tmp_path / "cut.gz"
    cut.write_bytes(gzip.compress(record)[:-20])
    with pytest.raises(ValueError):
        list(warc.stream_records(str(cut)))
    empty = tmp_path / "empty.gz"
    empty.write_bytes(gzip.compress(b""))
    assert list(warc.stream_records(str(empty))) == []


def test_shards(spark):
    rows = [(i % 50, f"text {i}", "b") for i in range(1000)] + [(7, "hot", "b")] * 500 + [(None, None, None), (1, "", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, bucket string").repartition(3).cache()
    out = shard.shard(df, work_path(spark, "s"), 16, bucket_bytes=2000).collect()
    assert Counter((r.doc_id, r.text) for r in out) == Counter((i, t) for i, t, _ in rows)
    n = Counter(r.shard for r in out)
    assert len(n) == 16 and max(n.values()) - min(n.values()) <= 1
    for k in n:
        assert sorted(r.slot for r in out if r.shard == k) == list(range(n[k]))
    assert all(r["size"] == len((r.text or "").encode()) + 1 and r.text_crc32 == zlib.crc32((r.text or "").encode()) for r in out)
    hot = Counter(r.shard for r in out if r.text == "hot")
    assert len(hot) == 16 and max(hot.values()) < 70  # repeated rows scatter too
    again = shard.shard(df, work_path(spark, "s"), 16, bucket_bytes=2000).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    other = shard.shard(df, work_path(spark, "s"), 16, bucket_bytes=2000, seed=3).collect()
    assert sorted(map(str, other)) != sorted(map(str, out))
    assert shard.digests(df.limit(0)).count() == 0
    few = shard.digests(df.limit(3)).collect()
    assert len(few) == 3 and all(r.law == "rows" and r.slot == 0 for r in few)


def test_bucket_is_memory_sized(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("x" * 99).alias("text"))
    sizes = shard.scatter(df, 30).groupBy("bucket").count().collect()
    assert len(sizes) == 30 and max(r["count"] for r in sizes) < 160
