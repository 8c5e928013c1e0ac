"""WARC archives in seekable Zstandard bundles, written and read by Spark tasks.

A bundle is a row of independent Zstandard frames, each with a group of records, and ends with a skippable frame that
holds the seek table (compressed and plain size of each frame). The index maps a record id to its bundle, frame and
offset in the frame, so that one record costs one small read and one frame's decompression.
"""

from __future__ import annotations

import hashlib
import struct

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, table

# Magic numbers of the seekable format, and the least payload that may be revisited.
SKIPPABLE, FOOTER = 0x184D2A5E, 0x8F92EAB1
REVISIT_BYTES = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 1 << 28

INDEX = "page_id long, bundle string, frame int, offset int, length int"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store of a URI or plain path and the path in it."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def record(page_id, url, payload: bytes, kind: str, refers_to, digest: str, size: int) -> bytes:
    """One WARC/1.1 record; a revisit has no payload but says its digest and length."""
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {size}"]
    if url is not None:
        head.insert(2, "WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
        block = b"HTTP/1.1 200 OK\r\n\r\n"
    else:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + payload
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _page(value: str) -> int | None:
    number = value.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def parse(frame: bytes, at: int) -> tuple[dict, int]:
    """The record at an offset of a plain frame, and where the next begins. Digests of responses are checked."""
    end = frame.index(b"\r\n\r\n", at)
    fields = dict(line.split(": ", 1) for line in frame[at:end].decode().split("\r\n")[1:])
    start, size = end + 4, int(fields["Content-Length"])
    block = frame[start : start + size]
    payload = block[block.index(b"\r\n\r\n") + 4 :]
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"digest of {fields['WARC-Record-ID']} differs")
    row = {
        "page_id": _page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_digest": digest, "record_type": kind,
        "payload_bytes": len(payload) if kind == "response" else int(fields["WARC-Payload-Length"]),
        "refers_to": _page(fields["WARC-Refers-To"]) if kind == "revisit" else None, "payload": payload if kind == "response" else None,
    }
    return row, start + size + 4


class BundleWriter:
    """Append records to a bundle; no more than one frame is held in memory."""

    def __init__(self, uri: str, level: int = 3, frame_bytes: int = FRAME_BYTES):
        self.uri, self.frame_bytes = uri, frame_bytes
        store, path = filesystem(uri)
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = store.open_output_stream(path, compression=None)
        self.packer = zstandard.ZstdCompressor(level=level)
        self.sizes: list[tuple[int, int]] = []
        self.parts: list[bytes] = []
        self.plain = self.total = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """(frame, offset in it) of the record."""
        if self.parts and self.plain + len(data) > self.frame_bytes:
            self.flush()
        where = len(self.sizes), self.plain
        self.parts.append(data)
        self.plain += len(data)
        self.total += len(data)
        return where

    def flush(self) -> None:
        if self.parts:
            packed = self.packer.compress(b"".join(self.parts))
            self.out.write(packed)
            self.sizes.append((len(packed), self.plain))
            self.parts, self.plain = [], 0

    def close(self) -> None:
        self.flush()
        entries = b"".join(struct.pack("<II", *s) for s in self.sizes)
        tail = entries + struct.pack("<IBI", len(self.sizes), 0, FOOTER)
        self.out.write(struct.pack("<II", SKIPPABLE, len(tail)) + tail)
        self.out.close()


class BundleReader:
    """Frames of a bundle by number, found through its seek table."""

    def __init__(self, uri: str):
        store, path = filesystem(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        count, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != FOOTER:
            raise ValueError(f"{uri} has no seek table")
        table_ = self.file.read_at(8 * count, size - 9 - 8 * count)
        self.frames, at = [], 0
        for packed, plain in struct.iter_unpack("<II", table_):
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, k: int) -> bytes:
        at, packed, plain = self.frames[k]
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, at), max_output_size=max(plain, 1))

    def record(self, frame: int, offset: int) -> dict:
        return parse(self.frame(frame), offset)[0]


#: Repeated digests that are broadcast at most.
REPEATED = 100_000


def revisits(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """page_id, url, digest, payload and refers_to of each page.

    Digests that repeat among payloads of at least REVISIT_BYTES are counted with partial sums, so a frequent one is no
    burden. Up to REPEATED of them are broadcast and no html is moved. More are joined with thin rows of ids and digests
    (by digest, which adaptive execution splits where one is frequent), and the html of pages that are large enough to be
    revisits is shuffled by page.
    """
    html = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", F.sha1(html).alias("digest"), html.alias("payload"))
    large = F.octet_length("payload") >= REVISIT_BYTES
    thin = rows.where(large).select("page_id", "digest")
    shared = scratch.write(thin.groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").select("digest", "last"), "repeated")
    again = F.when(large & (F.col("page_id") != F.col("last")), F.col("last")).alias("refers_to")
    if shared.limit(REPEATED + 1).count() <= REPEATED:
        return rows.join(F.broadcast(shared), "digest", "left").select("page_id", "url", "digest", "payload", again)
    link = scratch.write(thin.join(shared, "digest").where("page_id <> last").select("page_id", "digest", F.col("last").alias("refers_to")).distinct(), "revisits")
    moved = rows.where(large).join(link, ["page_id", "digest"], "left").select("page_id", "url", "digest", "payload", "refers_to")
    return rows.where(~large).withColumn("refers_to", F.lit(None).cast("long")).select(moved.columns).union(moved)


def write_warc(pages: DataFrame, folder: str, scratch: Scratch, partitions: int | None = None, level: int = 3) -> DataFrame:
    """Write a record per page under ``folder`` (any store that pyarrow reaches) and return the index.

    A null html is an empty payload; a null url is left out; a null page_id keeps an empty id and is a response; pages that repeat an id
    are all written. Files are named by task attempt and only those of the attempt that succeeded are in the index.
    """
    rows = revisits(pages, scratch).drop("digest")
    rows = rows.repartition(partitions, "page_id") if partitions else rows

    def work(batches):
        task = TaskContext.get()
        bundle, n = None, 0
        try:
            for batch in batches:
                ids = batch.column("page_id").to_pylist()
                where = []
                for page_id, url, payload, refers in zip(ids, batch.column("url").to_pylist(), batch.column("payload"), batch.column("refers_to").to_pylist()):
                    data = payload.as_buffer().to_pybytes()
                    kind = "response" if refers is None else "revisit"
                    if bundle is None or bundle.total >= BUNDLE_BYTES:
                        if bundle:
                            bundle.close()
                        bundle, n = BundleWriter(f"{folder}/{task.partitionId():06d}-{task.taskAttemptId()}-{n:03d}.warc.zst", level), n + 1
                    entry = record(page_id, url, data, kind, refers, hashlib.sha1(data).hexdigest(), len(data))
                    where.append((bundle.uri, *bundle.add(entry), len(entry)))
                cols = list(zip(*where)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(cols[0], pa.string()), *(pa.array(c, pa.int32()) for c in cols[1:])], names=["page_id", "bundle", "frame", "offset", "length"])
        finally:
            if bundle:
                bundle.close()

    return scratch.write(rows.mapInArrow(work, INDEX), "index")


def read_warc(index: DataFrame, payload: bool = True) -> DataFrame:
    """All records of the bundles that an index names: each bundle is one row of work, each frame one batch."""
    schema = RECORD if payload else RECORD.rpartition(",")[0]
    names = [c.split()[0] for c in schema.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [types[c.split()[1]] for c in schema.split(", ")]

    def work(batches):
        for batch in batches:
            for uri in batch.column("bundle").to_pylist():
                reader = BundleReader(uri)
                for k in range(len(reader.frames)):
                    frame, at, rows = reader.frame(k), 0, []
                    while at < len(frame):
                        row, at = parse(frame, at)
                        rows.append(row)
                    yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, fields)], names=names)

    return index.select("bundle").distinct().mapInArrow(work, schema)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    """Write all ``pages`` to bundles in the shared folder and read them back."""
    scratch = Scratch(spark, "warc")
    index = write_warc(table(spark, sf_dir, "pages").select("page_id", "url", "html"), f"{scratch.root}/bundles", scratch)
    return read_warc(index, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
FROM m
"""
