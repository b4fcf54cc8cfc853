"""Archives: exact round trips, the seek table and random access."""

from __future__ import annotations

import base64
import hashlib
import io
from pathlib import Path

import pytest
import zstandard

from partwise.llm import warc

ROWS = [
    (5, "http://a/", "same page"),
    (3, "http://b/\r\nX: y", "same page"),
    (9, None, "same page"),
    (3, "http://b/again", "same page"),
    (4, "http://c/", None),
    (2, "http://d/", ""),
    (7, "http://e/", "\r\n\r\nWARC/1.1\r\n é😀" * 3),
    (8, "http://f/", "long " * 200_000),
    (None, "http://g/", "same page"),
    (None, "http://h/", "only here"),
]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows, min_bytes):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = min(same, default=None)
        revisit = len(data) >= min_bytes and first is not None and (page is None or page > first)
        out.append((page, len(data), digest(html), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*row, "x") for row in ROWS], "page_id long, url string, html string, bundle string")


@pytest.mark.parametrize("min_bytes", [0, 1, 1000])
def test_written_and_read_back(pages, min_bytes):
    found = warc.archive_and_read(pages.repartition(3), min_bytes).collect()
    assert sorted(map(tuple, found), key=repr) == expected(ROWS, min_bytes)


def test_bundles_are_whole_streams_with_an_index(pages, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 2000)
    folder, index = warc.write_archives(pages.coalesce(1))
    rows = index.collect()
    assert len(rows) == len(ROWS) and len({r.record_id for r in rows}) == 8
    for name in {r.bundle for r in rows}:
        data = Path(folder.removeprefix("file://"), name).read_bytes()
        stream = io.BytesIO(data)
        frames = warc.read_seek_table(stream, len(data))
        plain = b"".join(warc.read_frame(stream, f) for f in frames)
        reader = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True)
        assert reader.read() == plain
        for r in (r for r in rows if r.bundle == name):
            record = warc.read_frame(stream, frames[r.frame])[r.offset : r.offset + r.length]
            assert frames[r.frame][0] == r.frame_offset
            assert warc.parse_record(record)["record_id"] == r.record_id
    texts = {(r.page_id, r.payload) for r in warc.read_archives(index, folder).collect() if r.record_type == "response"}
    assert (8, bytearray(b"long " * 200_000)) in [(p, t) for p, t in ((p, bytearray(t)) for p, t in texts)]


def test_repetitive_pages_are_read_frame_by_frame(spark, monkeypatch):
    """40 MB of text that compresses to almost nothing: bundles end by plain bytes, reads by frames."""
    monkeypatch.setattr(warc, "BUNDLE_PLAIN_BYTES", 16 << 20)
    monkeypatch.setattr(warc, "READ_FRAMES", 3)
    docs = spark.range(200).selectExpr("id as page_id", "'http://a/' as url", "concat(id, repeat(' same words', 20000)) as html")
    folder, index = warc.write_archives(docs.coalesce(1))
    sizes = {r.bundle: r.plain for r in index.groupBy("bundle").agg({"length": "sum"}).withColumnRenamed("sum(length)", "plain").collect()}
    assert len(sizes) == 3 and max(sizes.values()) < 17 << 20
    places = [tuple(r) for r in index.select("bundle", "frame", "frame_offset", "offset", "length").orderBy("bundle", "frame", "offset").collect()]
    batch = warc.pa.RecordBatch.from_arrays([warc.pa.array(c) for c in zip(*places, strict=True)], names=list("abcde"))
    parts = list(warc._read(folder, True)([batch]))
    assert sum(len(p) for p in parts) == 200 and max(p.nbytes for p in parts) < 2 * warc.FRAME_BYTES
    back = warc.read_archives(index, folder)
    assert {r.page_id: bytes(r.payload) for r in back.collect()} == {r.page_id: r.html.encode() for r in docs.collect()}
    assert "payload" not in warc.read_archives(index, folder, payloads=False).columns


def test_one_record_by_its_id(pages):
    folder, index = warc.write_archives(pages)
    one = warc.read_archives(index.where(index.record_id == warc.record_id(7)), folder).collect()
    assert [bytes(r.payload).decode() for r in one] == [ROWS[6][2]]


def test_empty_table(pages):
    assert warc.archive_and_read(pages.limit(0)).collect() == []


def test_bad_records_are_refused():
    record = warc.make_record(1, "http://a/", b"abc", None, "2024-01-01T00:00:00Z")
    assert warc.parse_record(record)["payload"] == b"abc"
    for bad in (record[:-1], record.replace(b"abc", b"abd"), b"x" + record):
        with pytest.raises(ValueError):
            warc.parse_record(bad)
