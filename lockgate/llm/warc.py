"""WARC archives in seekable Zstandard bundles.

Each task writes bundles of WARC/1.1 records. The records of a bundle are grouped into independent Zstandard frames of about
``FRAME`` bytes, and a seek table in a skippable frame closes the bundle, so a reader finds any frame from the end
of the file and decompresses it alone. The index maps each record to its bundle, frame, and offset and length inside the
decompressed frame. Bundles are written under names of their own; only those that the stored index names
count, so files of tasks that were lost or ran twice are never read.

Records with equal payloads (by SHA-1) of at least ``least`` bytes: the one with the largest page_id is a response and the
others revisit it. Rows that repeat that page_id are responses too. Null payloads are empty. A null page_id loses against
any other; where a group has no id at all, all are responses. Null urls give records without a target. An empty table
gives no bundles and no rows. Ids are written into record ids as text, and other columns are not read.
"""

from __future__ import annotations

import base64
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lockgate.llm import common
from lockgate.sources import scratch

FRAME = 1 << 20
BUNDLE = 1 << 28
READ_BYTES = 16 << 20  # of records that one task reads
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the seekable format: magic number of the skippable frame, of the seek table's footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
INDEX = "page_id string, bundle string, frame int, place long, length long"
READ = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _urn(page_id: str) -> str:
    return f"<urn:page:{quote(page_id, safe='')}>"


def _id(urn: str) -> str | None:
    name = unquote(urn.removeprefix("<urn:page:").removesuffix(">"))
    return name or None


def record(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record: a response, or a revisit of the response of ``refers_to``, whose block ends after the HTTP header."""
    block = HTTP if refers_to is not None else HTTP + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
        f"WARC-Record-ID: {_urn(page_id or '')}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {''.join(c if c > ' ' and c != chr(127) else quote(c) for c in url)}")
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: {_urn(refers_to)}")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one whole record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    length = int(headers["Content-Length"])
    if not version.startswith("WARC/1.") or rest[length:] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    return headers, rest[:length]


class Bundle:
    """Writes frames to a file and closes it with the seek table."""

    def __init__(self, folder: str):
        import zstandard

        self.compressor = zstandard.ZstdCompressor(level=3)
        system, place = _file_system(folder)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.file = system.open_output_stream(f"{place}/{self.name}", compression=None)
        self.frames: list[tuple[int, int]] = []
        self.buffer, self.size, self.held = [], 0, 0

    def add(self, data: bytes) -> tuple[int, int]:
        """The frame and the place in the frame that the record gets."""
        place = (len(self.frames), self.size)
        self.buffer.append(data)
        self.size += len(data)
        self.held += len(data)
        if self.size >= FRAME:
            self.flush()
        return place

    def flush(self) -> None:
        if self.buffer:
            packed = self.compressor.compress(b"".join(self.buffer))
            self.file.write(packed)
            self.frames.append((len(packed), self.size))
            self.buffer, self.size = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.file.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.file.close()


class Reader:
    """Reads single frames of a bundle by its seek table."""

    def __init__(self, folder: str, name: str):
        import zstandard

        self.decompressor = zstandard.ZstdDecompressor()
        system, place = _file_system(folder)
        self.file = system.open_input_file(f"{place}/{name}")
        size = self.file.size()
        count, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        table = self.file.read_at(8 * count, size - 9 - 8 * count)
        self.starts, self.sizes, at = [], [], 0
        for k in range(count):
            packed, plain = struct.unpack_from("<II", table, 8 * k)
            self.starts.append((at, packed))
            self.sizes.append(plain)
            at += packed

    def frame(self, k: int) -> bytes:
        at, size = self.starts[k]
        return self.decompressor.decompress(self.file.read_at(size, at), max_output_size=self.sizes[k])


def _file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _make_folder(folder: str) -> None:
    system, place = _file_system(folder)
    system.create_dir(place, recursive=True)


def plan(pages: DataFrame, least: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, html and refers_to. Only digests and ids are grouped, with partial sums; the group's row comes back by a join."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html"))
    shared = rows.filter(F.octet_length("html") >= least).groupBy("digest").agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).filter("n > 1").drop("n")
    rows = rows.join(shared, "digest", "left")
    refers = F.when(F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept")), F.col("kept"))
    return rows.select(F.col("page_id").cast("string").alias("page_id"), "url", "html", refers.cast("string").alias("refers_to"))


def write(pages: DataFrame, folder: str, least: int = 0, **columns: str) -> DataFrame:
    """Writes one record for each row of ``pages`` into bundles in ``folder`` and returns the stored index."""
    _make_folder(folder)

    def step(rows: common.Batches) -> common.Batches:
        import hashlib

        bundle = None
        try:
            for batch in rows:
                found = []
                for r in batch.to_pylist():
                    bundle = bundle or Bundle(folder)
                    digest = base64.b32encode(hashlib.sha1(r["html"]).digest()).decode()
                    data = record(r["page_id"], r["url"], r["html"], digest, r["refers_to"])
                    found.append((r["page_id"], bundle.name, *bundle.add(data), len(data)))
                    if bundle.held >= BUNDLE:
                        bundle.close()
                        bundle = None
                if found:
                    kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], ["page_id", "bundle", "frame", "place", "length"])
        finally:
            if bundle is not None:
                bundle.close()

    return common.stored(plan(pages, least, **columns).mapInArrow(step, INDEX), "index")


def read(spark_index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that the index names, read from the bundles frame by frame. Digests of stored payloads are checked."""

    def step(rows: common.Batches) -> common.Batches:
        import hashlib

        reader, name, frame, data = None, None, None, b""
        for batch in rows:
            found = []
            for r in batch.to_pylist():
                if r["bundle"] != name:
                    reader, name, frame = Reader(folder, r["bundle"]), r["bundle"], None
                if r["frame"] != frame:
                    data, frame = reader.frame(r["frame"]), r["frame"]
                headers, block = parse(data[r["place"] : r["place"] + r["length"]])
                digest, size = headers["WARC-Payload-Digest"].removeprefix("sha1:"), int(headers["X-Payload-Length"])
                payload = block.partition(b"\r\n\r\n")[2] if headers["WARC-Type"] == "response" else None
                if payload is not None and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                    raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
                refers = headers.get("WARC-Refers-To")
                found.append(
                    (_id(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), size, digest, headers["WARC-Type"], refers and _id(refers), payload if with_payload else None)
                )
            if found:
                kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], [f.split()[0] for f in READ.split(", ")])

    # A frame is read by one task, and in order; frames of one bundle may go to many tasks. The index says little of the
    # bytes behind it, so the number of tasks comes from the lengths of the records.
    held = spark_index.agg(F.sum("length")).first()[0] or 0
    rows = spark_index.repartition(1 + held // READ_BYTES, "bundle", "frame").sortWithinPartitions("bundle", "frame", "place")
    return rows.mapInArrow(step, READ)


def lookup(spark_index: DataFrame, folder: str, page_ids: DataFrame) -> DataFrame:
    """Records of the given page_ids (page_id) alone; only their frames are decompressed."""
    wanted = page_ids.select(F.col("page_id").cast("string").alias("wanted")).distinct()
    return read(spark_index.join(wanted, F.col("page_id") == F.col("wanted"), "left_semi"), folder)


def archive(pages: DataFrame, least: int = 0) -> DataFrame:
    """Writes and reads back ``pages``; page_id, payload_bytes, payload_digest, record_type and refers_to for each row."""
    folder = scratch.new_folder(pages.sparkSession, "warc")
    kind = pages.schema["page_id"].dataType
    found = read(write(pages, folder, least), folder, with_payload=False)
    return found.select(F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind))


#: The same rows in DuckDB.
ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
s AS (SELECT page_id, octet_length(body) AS n, sha1(body) AS hex FROM p),
k AS (SELECT hex, max(page_id) AS kept FROM s GROUP BY hex)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) AS BIGINT), 1) FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = kept OR kept IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM s JOIN k USING (hex)
"""
