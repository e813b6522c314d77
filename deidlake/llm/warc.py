"""WARC archives as seekable Zstandard bundles.

A bundle holds records in independent Zstandard frames of about
``FRAME_BYTES``, and ends with a seek table in a skippable frame (the layout
of Zstandard's seekable format: for each frame its compressed and its
decompressed size, then the number of frames, a descriptor and a magic
number).  ``index`` maps each record's identifier to bundle, frame, and offset
and length inside the decompressed frame, so one record is read by
decompressing one frame.

Bundles are the rows of a Parquet table (name, data): any store that Spark
reaches will do.  Payloads that occur more than once are written once, as the
response with the largest page id; the others become revisit records.  What
is shuffled to find them are ids and digests; the payloads are shuffled once,
by page.

Defined results: a null payload is an empty one; payloads of under 1000 bytes
are never revisited; of several equal rows (same id and payload) all are what
that id's record is; null ids never become the response others refer to
unless no id of the payload is set, then all of them are responses; an empty
table gives no bundles and no records; extra columns are ignored."""

from __future__ import annotations

import base64
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deidlake.llm.common import scratch

LEAST_REVISITED = 1000
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 4 << 20
#: Magic numbers of Zstandard's skippable frame and seek table (fixed values).
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1


# ------------------------------------------------------------------ records

def record(page_id, url: str | None, kind: str, refers_to, digest: str, payload: bytes) -> bytes:
    """One WARC record; a revisit carries the digest and size of the payload
    but not the payload."""
    block = b"" if kind == "revisit" else payload
    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}#{digest}')}>",
        "WARC-Date: 2000-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{sha1}", f"X-Payload-Length: {len(payload)}",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if url is not None:  # percent sign and line ends can't stand in a header
        lines.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines.append(f"X-Refers-To-Page: {refers_to}")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, offset: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, offset of the next record)."""
    end = data.index(b"\r\n\r\n", offset)
    lines = data[offset:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    start = end + 4
    stop = start + int(headers["Content-Length"])
    return headers, data[start:stop], stop + 4


# ------------------------------------------------------------------ bundles

class BundleWriter:
    """Collects records; ``close`` gives the bytes of the bundle."""

    def __init__(self, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.frame_bytes, self.compressor = frame_bytes, zstandard.ZstdCompressor(level=level)
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.open = bytearray()
        self.written = 0

    def add(self, data: bytes) -> tuple[int, int, int]:
        """(frame, offset in it, length) of the record."""
        if self.open and len(self.open) + len(data) > self.frame_bytes:
            self._flush()
        at = len(self.open)
        self.open += data
        return len(self.frames), at, len(data)

    def _flush(self) -> None:
        frame = self.compressor.compress(bytes(self.open))
        self.frames.append(frame)
        self.sizes.append((len(frame), len(self.open)))
        self.written += len(frame)
        self.open = bytearray()

    def close(self) -> bytes:
        if self.open:
            self._flush()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        head = struct.pack("<II", SKIPPABLE, len(table) + len(footer))
        return b"".join([*self.frames, head, table, footer])


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, decompressed size) of each frame."""
    n, descriptor, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE or descriptor:
        raise ValueError("no seek table")
    table = bundle[len(bundle) - 9 - 8 * n:-9]
    found, at = [], 0
    for k in range(n):
        packed, plain = struct.unpack_from("<II", table, 8 * k)
        found.append((at, packed, plain))
        at += packed
    return found


def read_frame(bundle: bytes, frame: tuple[int, int, int]) -> bytes:
    at, packed, plain = frame
    return zstandard.ZstdDecompressor().decompress(bundle[at:at + packed], max_output_size=plain)


# -------------------------------------------------------------------- Spark

@dataclass(frozen=True)
class Archive:
    """Paths of the bundles and of their index."""

    bundles: str
    index: str


def _payload(html: Column) -> Column:
    return F.coalesce(html.cast("string"), F.lit("")).cast("binary")


def decisions(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(page_id, digest, response): the page whose record holds the payload;
    only for payloads that occur more than once."""
    payload = _payload(F.col(f"`{html_col}`"))
    lean = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.sha1(payload).alias("digest"), F.length(payload).alias("size"))
    lean = lean.where(F.col("size") >= LEAST_REVISITED)
    groups = lean.groupBy("digest").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
    groups = groups.where("n > 1 AND response IS NOT NULL").select("digest", "response")
    return lean.select("page_id", "digest").join(groups, "digest").groupBy("page_id", "digest").agg(
        F.first("response").alias("response"))


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> Archive:
    """Write one record for each row below ``path``."""
    payload = _payload(F.col(f"`{html_col}`"))
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), payload.alias("payload"),
                        F.sha1(payload).alias("digest"))
    found = decisions(pages, id_col, html_col).select(
        F.col("page_id").alias("__page"), F.col("digest").alias("__digest"), "response")
    rows = rows.join(found, rows["page_id"].eqNullSafe(found["__page"]) & (rows["digest"] == found["__digest"]), "left").select(
        "page_id", "url", "payload", "digest", F.when(~F.col("response").eqNullSafe(F.col("page_id")), F.col("response")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, places = BundleWriter(), []

        def closed() -> pa.RecordBatch:
            data = writer.close()
            entry = {"name": uuid.uuid4().hex, "data": data, "places": places}
            return pa.RecordBatch.from_pylist([entry], _BUNDLE)

        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(batch.column(i) for i in range(5))):
                page_id, refers_to, payload = page_id.as_py(), refers_to.as_py(), payload.as_py()
                kind = "response" if refers_to is None else "revisit"
                place = writer.add(record(page_id, url.as_py(), kind, refers_to, digest.as_py(), payload))
                places.append({"page_id": page_id, "frame": place[0], "offset": place[1], "length": place[2]})
                if writer.written >= BUNDLE_BYTES:
                    yield closed()
                    writer, places = BundleWriter(), []
        if places:
            yield closed()

    bundles = rows.mapInArrow(run, "name string, data binary, places array<struct<page_id:long,frame:int,offset:int,length:int>>")
    archive = Archive(f"{path}/bundles", f"{path}/index")
    # the frames are compressed already
    bundles.write.option("compression", "uncompressed").option("parquet.enable.dictionary", "false").parquet(archive.bundles)
    places = pages.sparkSession.read.parquet(archive.bundles).select("name", F.explode("places").alias("p"))
    places.select("name", "p.*").write.parquet(archive.index)
    return archive


_BUNDLE = pa.schema([
    ("name", pa.string()), ("data", pa.binary()),
    ("places", pa.list_(pa.struct([("page_id", pa.int64()), ("frame", pa.int32()), ("offset", pa.int32()), ("length", pa.int32())]))),
])
_RECORD = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _row(headers: dict[str, str], block: bytes, with_payload: bool) -> dict:
    url, page, refers = (headers.get(k) for k in ("WARC-Target-URI", "X-Page-ID", "X-Refers-To-Page"))
    return {
        "page_id": None if page is None else int(page),
        "url": None if url is None else url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
        "payload": block if with_payload and headers["WARC-Type"] == "response" else None,
        "payload_bytes": int(headers["X-Payload-Length"]),
        "payload_digest": base64.b32decode(headers["WARC-Payload-Digest"].partition(":")[2]).hex(),
        "record_type": headers["WARC-Type"], "refers_to": None if refers is None else int(refers),
    }


_ROWS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
])


def read(spark: SparkSession, archive: Archive, payloads: bool = True) -> DataFrame:
    """All records of an archive, frame by frame.  The digest and size of a
    response are compared with its payload."""
    from hashlib import sha1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle in batch.column("data"):
                bundle = bundle.as_py()
                for frame in seek_table(bundle):
                    data, at, rows = read_frame(bundle, frame), 0, []
                    while at < len(data):
                        headers, block, at = parse(data, at)
                        row = _row(headers, block, payloads)
                        if row["record_type"] == "response" and (
                                len(block) != row["payload_bytes"] or sha1(block).hexdigest() != row["payload_digest"]):
                            raise ValueError(f"damaged record of page {row['page_id']}")
                        rows.append(row)
                    yield pa.RecordBatch.from_pylist(rows, _ROWS)

    return spark.read.parquet(archive.bundles).select("data").mapInArrow(run, _RECORD)


def lookup(spark: SparkSession, archive: Archive, ids: DataFrame) -> DataFrame:
    """The records of the pages in ``ids`` (page_id), each by decompressing
    the one frame that holds it."""
    places = spark.read.parquet(archive.index).join(ids.select("page_id").distinct(), "page_id")
    wanted = places.groupBy("name").agg(F.collect_list(F.struct("frame", "offset")).alias("wanted"))
    rows = spark.read.parquet(archive.bundles).select("name", "data").join(wanted, "name").select("data", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle, wanted in zip(batch.column("data"), batch.column("wanted")):
                bundle = bundle.as_py()
                frames, rows, number, data = seek_table(bundle), [], -1, b""
                for place in sorted(wanted.as_py(), key=lambda w: (w["frame"], w["offset"])):
                    if place["frame"] != number:
                        number, data = place["frame"], read_frame(bundle, frames[place["frame"]])
                    headers, block, _ = parse(data, place["offset"])
                    rows.append(_row(headers, block, True))
                yield pa.RecordBatch.from_pylist(rows, _ROWS)

    return rows.mapInArrow(run, _RECORD)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the archives of ``pages`` to the shared folder and read them."""
    spark = pages.sparkSession
    archive = write(pages, scratch(spark, "warc"))
    return read(spark, archive, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
