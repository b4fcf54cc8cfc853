"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding whole records of about
``FRAME_BYTES`` together, and a seek table at its end (a skippable frame with every frame's
sizes, as the seekable format of Zstandard lays it down). Any Zstandard tool reads a bundle
as one stream; the index maps a record id to its bundle, its frame and its offset there,
so one record costs one frame.

Records with equal payloads are stored once: the one with the smallest id is a
``response``, the others are ``revisit`` records that name it.

Each task writes bundles of its own, under names no other attempt uses, and only the index
says which bundles count; a lost or repeated task leaves at most an unnamed file behind.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm.common import settle
from partwise.session import new_scratch_path

FRAME_BYTES = 256 << 10
#: A bundle ends after so many compressed bytes, or so many plain ones.
BUNDLE_BYTES, BUNDLE_PLAIN_BYTES = 32 << 20, 512 << 20
#: Frames that are read together; reading holds one of them, and payloads of about ``FRAME_BYTES``.
READ_FRAMES = 64

# Fixed values of the seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
# Fixed values of WARC 1.1.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_INDEX = "page_id long, record_id string, bundle string, frame int, frame_offset long, offset long, length long"


def record_id(page_id: int | None) -> str:
    return f"urn:partwise:page:{'null' if page_id is None else page_id}"


def page_of(name: str | None) -> int | None:
    """The page id in a record id."""
    last = (name or "null").rpartition(":")[2]
    return None if last == "null" else int(last)


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(page_id: int | None, url: str | None, payload: bytes, first: int | None, date: str) -> bytes:
    """One record; a revisit of page ``first`` if that is given. Control bytes in an address are escaped."""
    kind = "response" if first is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if first is None else b"")
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id(page_id)}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if first is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{record_id(first)}>"]
    lines += [
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def parse_record(record: bytes) -> dict:
    """The fields of one record; checks lengths, and the digest of a stored payload."""
    head, _, rest = record.partition(b"\r\n\r\n")
    if not head.startswith(VERSION.encode()):
        raise ValueError("not a WARC record")
    fields = _fields(head)
    size = int(fields["content-length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length does not fit")
    http, _, payload = block.partition(b"\r\n\r\n")
    full = int(_fields(http)["content-length"])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != full or payload_digest(payload) != digest):
        raise ValueError("a payload does not fit its digest")
    refers_to = fields.get("warc-refers-to")
    return {
        "record_id": fields["warc-record-id"][1:-1],
        "record_type": kind,
        "target_uri": fields.get("warc-target-uri"),
        "refers_to_id": refers_to and refers_to[1:-1],
        "payload_digest": digest,
        "payload_bytes": full,
        "payload": payload if kind == "response" else None,
    }


class BundleWriter:
    """Frames of whole records, then the seek table."""

    def __init__(self, stream):
        self.stream = stream
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.position = self.plain = 0
        self.open: list[bytes] = []
        self.open_bytes = 0

    def add(self, record: bytes) -> tuple[int, int, int, int]:
        """(frame, frame_offset, offset, length) of the record."""
        place = len(self.frames), self.position, self.open_bytes, len(record)
        self.open.append(record)
        self.open_bytes += len(record)
        if self.open_bytes >= FRAME_BYTES:
            self._end_frame()
        return place

    def _end_frame(self) -> None:
        if self.open:
            frame = self.compressor.compress(b"".join(self.open))
            self.stream.write(frame)
            self.frames.append((len(frame), self.open_bytes))
            self.position += len(frame)
            self.plain += self.open_bytes
            self.open, self.open_bytes = [], 0

    def finish(self) -> None:
        self._end_frame()
        table = b"".join(struct.pack("<II", *sizes) for sizes in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(footer)) + table + footer)


def read_seek_table(stream, size: int) -> list[tuple[int, int, int]]:
    """(offset, compressed bytes, bytes) of every frame, from the end of a bundle of ``size`` bytes."""
    stream.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", stream.read(9))
    if magic != SEEKABLE_MAGIC or flags & 0x80:
        raise ValueError("no seek table without checksums at the end")
    stream.seek(size - 9 - 8 * count)
    sizes = struct.iter_unpack("<II", stream.read(8 * count))
    frames, at = [], 0
    for packed, plain in sizes:
        frames.append((at, packed, plain))
        at += packed
    return frames


def read_frame(stream, frame: tuple[int, int, int]) -> bytes:
    offset, packed, plain = frame
    stream.seek(offset)
    return zstandard.ZstdDecompressor().decompress(stream.read(packed), max_output_size=plain)


def _locate(df: DataFrame, folder: str) -> str:
    """``folder`` with the scheme that Spark takes for it, so that all tasks mean the same store."""
    context = df.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(context._jsc.hadoopConfiguration())
    store.mkdirs(path)
    full = store.makeQualified(path).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file:///") else full


def _write(folder: str, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        writer, name, stream, rows = None, "", None, []
        for batch in batches:
            for page, url, html, first in zip(*batch.columns, strict=True):
                if writer is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    stream = store.open_output_stream(f"{top}/{name}", compression=None)  # it is compressed already
                    writer = BundleWriter(stream)
                page = page.as_py()
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                place = writer.add(make_record(page, url.as_py(), payload, first.as_py(), date))
                rows.append((page, record_id(page), name, *place))
                if writer.position >= BUNDLE_BYTES or writer.plain >= BUNDLE_PLAIN_BYTES:
                    writer.finish()
                    stream.close()
                    writer = None
            if rows:  # an index row may go ahead of its bundle's end: a failed task's rows are dropped
                yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=_names(_INDEX)), _INDEX_SCHEMA, False)
                rows = []
        if writer is not None:
            writer.finish()
            stream.close()

    return write


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


_INDEX_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()),
        ("record_id", pa.string()),
        ("bundle", pa.string()),
        ("frame", pa.int32()),
        ("frame_offset", pa.int64()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
    ]
)

_RECORD_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()),
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("target_uri", pa.string()),
        ("refers_to_id", pa.string()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload", pa.binary()),
    ]
)
_RECORDS = (
    "page_id long, record_id string, record_type string, target_uri string, refers_to_id string, "
    "payload_digest string, payload_bytes long, payload binary"
)


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    min_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> tuple[str, DataFrame]:
    """Write a record for every row into bundles below ``folder``; gives the folder and the index.

    Payloads of at least ``min_bytes`` that are equal share the response with the smallest
    id. A null page has an empty payload. Rows that repeat the smallest id are all
    responses; a row with a null id is a revisit if an equal payload has an id, else a
    response. Only the three named columns are read. An empty table writes no bundle.
    """
    spark = pages.sparkSession
    folder = _locate(pages, folder or new_scratch_path(spark, "warc"))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("html"),
    )
    key = F.when(F.length("html") >= min_bytes, F.sha1("html"))
    light = rows.select("page_id", key.alias("same")).where("same is not null")
    shared = light.groupBy("same").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    joined = rows.withColumn("key", key).join(shared, F.col("key") == F.col("same"), "left")
    revisits = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    ready = joined.select("page_id", "url", "html", F.when(revisits, F.col("first")).alias("first"))
    return folder, settle(ready.mapInArrow(_write(folder, date), _INDEX), "warc-index")


def _read(folder: str, payloads: bool):
    """Parse the records of an index that is sorted by bundle and frame; one frame is held at a time."""
    schema = _RECORD_SCHEMA if payloads else _RECORD_SCHEMA.remove(_RECORD_SCHEMA.get_field_index("payload"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        rows = itertools.chain.from_iterable(zip(*(c.to_pylist() for c in batch.columns), strict=True) for batch in batches)
        out, held = [], 0
        for bundle, wanted in itertools.groupby(rows, key=lambda row: row[0]):
            with store.open_input_file(f"{top}/{bundle}") as stream:
                frames = read_seek_table(stream, stream.size())
                for number, places in itertools.groupby(wanted, key=lambda row: row[1]):
                    data = read_frame(stream, frames[number])
                    for _, _, frame_offset, offset, length in places:
                        if frames[number][0] != frame_offset:
                            raise ValueError("the index does not fit the seek table")
                        record = parse_record(data[offset : offset + length])
                        if not payloads:
                            record["payload"] = None
                        out.append({"page_id": page_of(record["record_id"]), **record})
                        held += len(record["payload"] or b"")
                        if held >= FRAME_BYTES or len(out) >= 4096:
                            yield pa.RecordBatch.from_pylist(out, schema)
                            out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return read


def read_archives(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records that ``index`` names, parsed from the bundles below ``folder``.

    The index is dealt by bundle and ``READ_FRAMES`` frames, and a task unpacks every frame
    that is asked for once; it holds one frame at a time, however well a bundle is compressed.
    A revisit has a null payload, but the length and digest of the full one. Without
    ``payloads`` there is no such column; lengths and digests are checked all the same.
    """
    wanted = index.select("bundle", "frame", "frame_offset", "offset", "length")
    dealt = wanted.repartition("bundle", F.floor(F.col("frame") / READ_FRAMES)).sortWithinPartitions("bundle", "frame", "offset")
    return dealt.mapInArrow(_read(folder, payloads), _RECORDS if payloads else _RECORDS.removesuffix(", payload binary"))


def archive_and_read(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records read back."""
    folder, index = write_archives(pages, min_bytes=min_bytes)
    number = F.regexp_extract("refers_to_id", r"(-?\d+)$", 1)
    refers_to = F.when(F.col("refers_to_id").isNotNull(), number.cast("long"))
    return read_archives(index, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", refers_to.alias("refers_to")
    )
