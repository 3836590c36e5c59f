"""WARC: monolithic gzip archives, and their normaliser.

``write_archives`` stores records as whole-file gzip streams (one member per
archive, as some crawlers leave them; no record can be read without inflating
all before it).  ``normalise`` inflates each such stream once, rewrites every
record as a gzip member of its own and writes a sidecar index (record, offset,
length, page, type) beside each archive, and all of them as one table.  ``read_records`` then reads any record by seeking.

Scale: tasks stream.  A writer task holds one Arrow batch of pages, the
normaliser one inflated window and one record, a reader one record.  Archives
end at ``archive_bytes``, so many tasks share the normalisation of a hot
source.  A task writes under a name of its own attempt and renames at the end,
so a repeated or speculative task leaves whole files only.  Equal payloads are
found by digest with map-side combined minima; payloads are shuffled once, to
meet the digests that occur twice or more.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import utf8, work_path, written

ARCHIVE_BYTES = 64 << 20
LEVEL = 6
ID = "urn:page:{}:{}"
DATE = "2000-01-01T00:00:00Z"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a shared folder (file:, hdfs:, s3: ...)."""
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def base32(hexadecimal):
    """Bare base32 of a SHA-1 in hex, with SQL functions: five bits a letter."""
    bits = F.concat(*[F.lpad(F.conv(F.substring(hexadecimal, k, 10), 16, 2), 40, "0") for k in (1, 11, 21, 31)])
    letter = lambda k: F.substring(
        F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), F.conv(F.substring(bits, 5 * k + 1, 5), 2, 10).cast("int") + 1, F.lit(1)
    )
    return F.concat(*[letter(k) for k in range(32)])


def mark_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html with payload_digest and refers_to: of equal payloads of
    ``least_bytes`` or more, the page with the smallest id is the response and
    other pages refer to it (repeated rows of that id are responses, too);
    smaller payloads are all responses.  A null id counts as larger than all
    others.
    """
    raw = F.coalesce(F.col("html").cast("string"), F.lit(""))
    own = pages.select(
        F.col("page_id").cast("bigint"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        raw.alias("html"),
        F.sha1(F.encode(raw, "UTF-8")).alias("sha"),
    )
    ranked = own.select("sha", "page_id", (F.octet_length("html") >= least_bytes).alias("big"))
    first = (
        ranked.where("big")
        .groupBy("sha")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    # Only digests seen twice are joined, and AQE splits one that is hot.
    joined = own.join(first, "sha", "left")
    return joined.select(
        "page_id",
        "url",
        "html",
        base32(F.col("sha")).alias("payload_digest"),
        F.when(F.col("page_id") != F.col("first_id"), F.col("first_id"))
        .when(F.col("page_id").isNull(), F.col("first_id"))
        .alias("refers_to"),
    )


def record(page_id: int | None, url: str, payload: bytes, sha1: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit carries no payload."""
    name = "" if page_id is None else page_id
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<{ID.format(name, uuid.uuid5(uuid.NAMESPACE_URL, f'{name} {url} {sha1}'))}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": quote(url, safe=":/?#[]@!$&'()*+,;=%~"),
        "WARC-Payload-Digest": f"sha1:{sha1}",
        "X-Page-ID": str(name),
    }
    if refers_to is not None:
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields["X-Refers-To-Page"] = str(refers_to)
        payload = b""
    fields["Content-Type"] = "text/html"
    fields["Content-Length"] = str(len(payload))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return head.encode() + payload + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    pairs = (line.partition(":") for line in lines[1:] if line)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


class Archive:
    """A file below ``folder`` that appears under its name once it is whole."""

    def __init__(self, folder: str, name: str):
        self.uri = f"{folder}/{name}"
        self.fs, self.path = opened(self.uri)
        self.part = f"{self.path}.{uuid.uuid4().hex}"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out, self.size = self.fs.open_output_stream(self.part), 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.part, self.path)


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes ``mark_revisits`` rows as monolithic archives; returns archive, records.

    Names are unique to the task's attempt and only those of successful
    attempts are returned, so leftovers of a failed one are never read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        done: list[tuple[str, int]] = []
        records = 0

        def end() -> None:
            archive.write(gzip.flush())
            archive.close()
            done.append((archive.uri, records))

        for b in batches:
            ids, urls, shas, refers = (b.column(k).to_pylist() for k in (0, 1, 3, 4))
            for page, url, payload, sha1, refer in zip(ids, urls, utf8(b.column(2)), shas, refers, strict=True):
                if archive is None:
                    archive, records = Archive(folder, f"mono-{uuid.uuid4().hex}.warc.gz"), 0
                    gzip = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                archive.write(gzip.compress(record(page, url, payload, sha1, refer)))
                records += 1
                if archive.size >= archive_bytes:
                    end()
                    archive = None
        if archive is not None:
            end()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["archive", "records"]
        )

    return written(pages.mapInArrow(run, "archive string, records bigint"), "archives")


def stream_records(path: str, window: int = 1 << 20) -> Iterator[tuple[bytes, bytes]]:
    """Head and payload of each record, from one pass over a gzip file with any
    number of members.  Holds one window and one record."""
    files, at = opened(path)
    buffer = bytearray()

    def pieces() -> Iterator[bytes]:
        inflate = zlib.decompressobj(31)
        with files.open_input_stream(at, compression=None) as f:
            while raw := f.read(window):
                while raw:
                    if inflate.eof:
                        inflate = zlib.decompressobj(31)
                    yield inflate.decompress(raw, window)
                    raw = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
        while not inflate.eof and (rest := inflate.decompress(inflate.unconsumed_tail, window)):
            yield rest
        if not inflate.eof:
            raise ValueError(f"{path} ends inside a gzip member")

    source = pieces()

    def until(n: int) -> bool:
        while len(buffer) < n:
            piece = next(source, None)
            if piece is None:
                return False
            buffer.extend(piece)
        return True

    while True:
        seen = 0
        while (cut := buffer.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(buffer)
            if not until(seen + 1):
                if buffer.strip():
                    raise ValueError(f"{path} ends inside a record's head")
                return
        head = bytes(buffer[:cut])
        length = int(parse_head(head)["content-length"])
        if not until(cut + 4 + length + 4):
            raise ValueError(f"{path} ends inside a record")
        yield head, bytes(buffer[cut + 4 : cut + 4 + length])
        del buffer[: cut + 4 + length + 4]


INDEX = "archive string, record bigint, offset bigint, length bigint, page_id bigint, record_type string"


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrites each archive with a gzip member per record, with its sidecar index
    (``.idx``: a line of tab-separated record, offset, length, page, type for
    each) beside it; returns the indexes of all archives as one table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for source in b.column(0).to_pylist():
                name = f"{source.rpartition('/')[2].removesuffix('.warc.gz')}-{uuid.uuid4().hex}"
                target = Archive(folder, f"{name}.warc.gz")
                rows: list[tuple] = []
                for n, (head, payload) in enumerate(stream_records(source)):
                    gzip = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    start, fields = target.size, parse_head(head)
                    target.write(gzip.compress(head + b"\r\n\r\n" + payload + b"\r\n\r\n") + gzip.flush())
                    page = fields.get("x-page-id", "")
                    rows.append((target.uri, n, start, target.size - start, int(page) if page else None, fields["warc-type"]))
                target.close()
                sidecar = Archive(folder, f"{name}.idx")
                sidecar.write("".join("\t".join("" if v is None else str(v) for v in r[1:]) + "\n" for r in rows).encode())
                sidecar.close()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.string() if k in (0, 5) else pa.int64()) for k, c in enumerate(zip(*rows, strict=True))]
                    if rows
                    else [pa.array([], pa.string() if k in (0, 5) else pa.int64()) for k in range(6)],
                    [f.split()[0] for f in INDEX.split(", ")],
                )

    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(archives.select("archive").repartition(tasks).mapInArrow(run, INDEX), "index")


READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_records(index: DataFrame) -> DataFrame:
    """Each record by its offset: its id, type, and the payload's size and digest
    (computed from the bytes read; a revisit's digest is the one it names)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = handle = None
        for b in batches:
            rows = []
            for archive, offset, length in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                if archive != name:
                    files, at = opened(archive)
                    name, handle = archive, files.open_input_file(at)
                handle.seek(offset)
                whole = zlib.decompress(handle.read(length), 31)
                head, _, rest = whole.partition(b"\r\n\r\n")
                fields = parse_head(head)
                payload = rest[: int(fields["content-length"])]
                named = fields["warc-payload-digest"].removeprefix("sha1:")
                kind, page = fields["warc-type"], fields.get("x-page-id", "")
                if kind == "response" and digest(payload) != named:
                    raise ValueError(f"payload of record {fields['warc-record-id']} is damaged")
                refer = fields.get("x-refers-to-page")
                rows.append((int(page) if page else None, len(payload), named, kind, None if refer is None else int(refer)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string() if k in (2, 3) else pa.int64()) for k, c in enumerate(columns)],
                [f.split()[0] for f in READ.split(", ")],
            )

    return index.select("archive", "offset", "length").mapInArrow(run, READ)


def resolve(records: DataFrame) -> DataFrame:
    """Gives revisits the size of the payload that they refer to."""
    full = (
        records.where("record_type = 'response'")
        .groupBy("payload_digest")
        .agg(F.max("payload_bytes").alias("full_bytes"))
    )
    revisits = records.where("record_type = 'revisit'").join(full, "payload_digest", "left")
    return records.where("record_type = 'response'").unionByName(
        revisits.select("page_id", F.col("full_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    )


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Archives of ``pages``, normalised and read back: a row per page.

    Null html is an empty payload, a null url an empty one; a null page_id gets
    a record without id; an empty table gives no rows.
    """
    folder = work_path(pages.sparkSession, "warc")
    archives = write_archives(mark_revisits(pages, least_bytes), f"{folder}/mono")
    return resolve(written(read_records(normalise(archives, f"{folder}/members")), "records"))
