"""Repeated byte windows by a depth-limited radix sort over suffixes.

Two suffixes matter to each other only if they agree through ``window`` bytes. So suffixes
are sorted by their first ``window`` bytes and no further, digit by digit from the most
significant one: a pass sorts the suffixes that are still tied by their next eight bytes,
and those left alone drop out. The groups that remain are exactly the repeated windows.

To sort all suffixes of a corpus would move many times its bytes, so the first digit is an
anchor: of every window one run of ``K`` bytes is chosen by its content alone, at one place
in 15 (a modular minimizer). Equal windows choose equal anchors at equal places.

1. Every batch sends the anchors' hashes, each once per document at most twice, packed and
   bucketed. A hash met twice is shared. The shared hashes go into a bit table of fixed size.
2. Anchors that the table lets through send the bytes around them, once per batch and
   document that is the smallest with these bytes there; larger documents of the batch are
   settled on the spot. A bucket sorts anchors, then the bytes before and after them, in
   passes; a window is covered if its group has a smaller document.
3. The covered runs meet their documents, which drop those bytes.

An anchor that very many batches send is hot. Inside a repeated passage it would arrive as a
row per batch, but at the passage's edges, where the bytes around differ, as one per document.
So the windows of a hot anchor are dealt one by one, by a hash of their own bytes: equal ones
still meet, a row per batch, and different ones are spread over all buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm.words import chunks, mix, text_bytes

#: Windows that are looked at together; longer texts are cut with an overlap.
STEP = 1 << 18
#: Bytes of whole texts whose anchors a task holds and sends together, about.
BATCH_BYTES = 4 << 20
#: Bits of the table of shared anchors: 32 MB.
TABLE_BITS = 28
#: Anchors that one bucket holds, about.
BUCKET_ANCHORS = 1 << 18
#: Bits of the table of hot anchors, and the rows from which on an anchor is hot.
HOT_BITS, HOT_ROWS = 22, 1 << 14

_SPANS = "doc_id long, text_hash long, start long, stop long"


class Scheme(NamedTuple):
    window: int
    reach: int  # an anchor starts within so many bytes of its window's start
    anchor: int  # bytes of an anchor
    probe: int  # bytes whose hash is minimised

    @classmethod
    def of(cls, window: int) -> Scheme:
        if window < 32:
            raise ValueError("a window must have 32 bytes or more")
        reach = (window - 6) // 2
        return cls(window, reach, window + 1 - reach, window + 1 - 2 * reach)


def _loads(data: np.ndarray, at: np.ndarray | int, count: int | None = None) -> np.ndarray:
    """Eight bytes as a number, at places ``at`` or at ``count`` places from ``at`` on."""
    view = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    return view[at : at + count] if count is not None else view[at]


class Anchors(NamedTuple):
    place: np.ndarray  # of the anchor
    first: np.ndarray  # first window that chose it
    last: np.ndarray  # last such window


def find_anchors(data: np.ndarray, bad: np.ndarray, count: int, scheme: Scheme) -> Anchors:
    """The anchors of the windows that start at 0 .. ``count`` - 1, but for ``bad`` places.

    ``data`` goes on for 16 bytes or more after the last window.
    """
    probes = scheme.window - scheme.probe + 1
    n = count + probes - 1
    keys = _loads(data, 0, n) & np.uint64((1 << 8 * scheme.probe) - 1 if scheme.probe < 8 else (1 << 64) - 1)
    keys *= np.uint64(0x9E3779B97F4A7C15)
    keys ^= keys >> np.uint64(29)
    keys *= np.uint64(0xBF58476D1CE4E5B9)
    keys &= np.uint64(0xFFFFFFFFFFE00000)
    keys |= np.arange(n, dtype=np.uint64)  # of equal probes the leftmost
    size = 1
    while size * 2 <= probes:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    if size < probes:
        keys = np.minimum(keys[: count], keys[probes - size : probes - size + count])
    least = (keys[:count] & np.uint64(0x1FFFFF)).astype(np.int64)
    start = np.arange(count)
    place = start + (least - start) % scheme.reach
    place[bad] = -1
    turns = np.flatnonzero(place[1:] != place[:-1]) + 1
    first = np.concatenate([[0], turns])
    last = np.concatenate([turns, [count]]) - 1
    real = place[first] >= 0
    return Anchors(place[first][real], first[real], last[real])


def _hash_anchors(data: np.ndarray, place: np.ndarray, scheme: Scheme) -> np.ndarray:
    hashes = np.full(len(place), scheme.anchor, np.uint64)
    for off in [*range(0, scheme.anchor - 8, 8), scheme.anchor - 8]:
        hashes = mix(hashes * np.uint64(0x9E3779B97F4A7C15) + _loads(data, place + off))
    return hashes


def _pieces(starts: np.ndarray, window: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, text ends) of stretches of whole texts, or of parts of long ones."""
    at, n = 0, len(starts) - 1
    while at < n:
        if starts[at + 1] - starts[at] > STEP:
            low, high = int(starts[at]), int(starts[at + 1])
            for begin in range(low, high - window + 1, STEP):
                end = min(high, begin + STEP + window - 1)
                yield begin, end, np.array([end])
            at += 1
            continue
        end = int(np.searchsorted(starts, starts[at] + STEP, "right")) - 1
        yield int(starts[at]), int(starts[end]), starts[at + 1 : end + 1]
        at = end


class _Found(NamedTuple):
    data: np.ndarray  # all bytes of the batch, and 16 more
    starts: np.ndarray  # of texts
    text: np.ndarray  # of each anchor
    hashes: np.ndarray
    first: np.ndarray  # window places in data
    last: np.ndarray
    place: np.ndarray


def _scan(texts: pa.Array, scheme: Scheme) -> _Found:
    raw, starts = text_bytes(texts)
    data = np.concatenate([raw, np.zeros(16, np.uint8)])
    parts: list[tuple] = []
    for low, high, ends in _pieces(starts, scheme.window):
        count = high - low - scheme.window + 1
        if count <= 0:
            continue
        crossing = (ends[:-1, None] - low - np.arange(1, scheme.window)).ravel()
        crossing = crossing[(crossing >= 0) & (crossing < count)]
        found = find_anchors(data[low : high + 16], crossing, count, scheme)
        parts.append((found.place + low, found.first + low, found.last + low))
    place, first, last = (np.concatenate(p) for p in zip(*parts, strict=True)) if parts else np.zeros((3, 0), np.int64)
    text = np.searchsorted(starts, first, "right") - 1
    return _Found(data, starts, text, _hash_anchors(data, place, scheme), first, last, place)


def _buckets(hashes: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of the sorted hashes; a bucket is a hash's top bits."""
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(bucket)), bool), bucket[1:] != bucket[:-1]]))
    return list(zip(bucket[first].tolist(), first.tolist(), [*first[1:].tolist(), len(bucket)], strict=False))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``BATCH_BYTES`` of text, the second column."""
    for batch in batches:
        for at, texts in chunks(batch.column(1), BATCH_BYTES):
            yield batch.slice(at, len(texts))


def _send_anchors(scheme: Scheme, bits: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            found = _scan(batch.column(1), scheme)
            ids = batch.column(0).to_numpy()[found.text]
            order = np.lexsort([ids, found.hashes])
            hashes, ids = found.hashes[order], ids[order]
            new = np.ones(len(hashes), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (ids[1:] != ids[:-1])
            hashes = hashes[new]
            third = np.zeros(len(hashes), bool)
            third[2:] = hashes[2:] == hashes[:-2]  # twice says that it is shared
            hashes = hashes[~third]
            low = hashes.view(np.uint8).reshape(-1, 8)[:, :6]
            rows = [(b, low[x:y].tobytes()) for b, x, y in _buckets(hashes, bits)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in rows], pa.int32()), pa.array([v for _, v in rows], pa.binary())], ["bucket", "hashes"]
            )

    return send


def _table_place(low: np.ndarray, bits: int, size: int) -> np.ndarray:
    """A hash's bit within its bucket's part of a table of 2^size bits, from its low 48 bits."""
    return (low & np.uint64((1 << size - bits) - 1)).astype(np.int64)


def _share(bits: int, hot_rows: int):
    def share(rows: pd.DataFrame) -> pd.DataFrame:
        """The bucket's part of the tables: hashes that came twice or more, and ``hot_rows`` times or more."""
        six = np.concatenate([np.frombuffer(v, np.uint8) for v in rows["hashes"]]).reshape(-1, 6)
        low = np.zeros((len(six), 8), np.uint8)
        low[:, :6] = six
        low = np.sort(low.view("<u8").ravel())
        out = {"bucket": [int(rows["bucket"].iloc[0])]}
        for name, size, times in (("marks", TABLE_BITS, 2), ("hot", HOT_BITS, hot_rows)):
            marks = np.zeros(1 << size - bits, bool)
            again = low[times - 1 :] == low[: max(0, len(low) - times + 1)]
            marks[_table_place(low[times - 1 :][again], bits, size)] = True
            out[name] = [np.packbits(marks, bitorder="little").tobytes()]
        return pd.DataFrame(out)

    return share


class _Table:
    """Which anchors may be shared, and which of them may be hot."""

    def __init__(self, rows: pa.Table, bits: int):
        self.bits = bits
        self.marks, self.hot = (np.zeros((1 << bits, 1 << size - bits - 3), np.uint8) for size in (TABLE_BITS, HOT_BITS))
        for bucket, marks, hot in zip(rows["bucket"].to_pylist(), rows["marks"], rows["hot"], strict=True):
            self.marks[bucket] = np.frombuffer(marks.as_buffer(), np.uint8)
            self.hot[bucket] = np.frombuffer(hot.as_buffer(), np.uint8)

    def _test(self, table: np.ndarray, size: int, hashes: np.ndarray) -> np.ndarray:
        bucket = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        place = _table_place(hashes, self.bits, size)
        return (table[bucket, place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        return self._test(self.marks, TABLE_BITS, hashes)

    def is_hot(self, hashes: np.ndarray) -> np.ndarray:
        return self._test(self.hot, HOT_BITS, hashes)


def _equal_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's hash, and numbers that only equal rows share; ``rows`` are multiples of eight bytes."""
    hashes = np.zeros(len(rows), np.uint64)
    for digit in rows.view("<u8").T:
        hashes = mix(hashes * np.uint64(0x9E3779B97F4A7C15) + digit)
    _, head, same = np.unique(hashes, return_index=True, return_inverse=True)
    other = np.flatnonzero((rows != rows[head[same]]).any(axis=1))
    same[other] = len(head) + np.arange(len(other))
    return hashes, same


def _send_contexts(table, scheme: Scheme, bits: int):
    most = scheme.window + scheme.reach - 1
    width = -(-(most + 4) // 8) * 8

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a bucket: packed contexts, or runs that are covered already."""
        for batch in _parts(batches):
            found = _scan(batch.column(1), scheme)
            named = batch.column(0).to_numpy()
            text_hash = batch.column(2).to_numpy()
            kept = np.flatnonzero(table.value.holds(found.hashes))
            hot = table.value.is_hot(found.hashes[kept])
            # A hot anchor's windows go each by itself, dealt by its own bytes.
            times = np.where(hot, found.last[kept] - found.first[kept] + 1, 1)
            kept, hot = np.repeat(kept, times), np.repeat(hot, times)
            turn = np.arange(len(kept)) - np.repeat(np.cumsum(times) - times, times)
            first = found.first[kept] + turn
            last = np.where(hot, first, found.last[kept])
            # The bytes from the first window to the end of the last, padded, with what places them.
            length = last - first + scheme.window
            around = np.zeros((len(kept), width), np.uint8)
            columns = np.arange(most)
            for k in range(0, len(kept), 1 << 16):
                some = slice(k, k + (1 << 16))
                at = np.minimum(first[some, None] + columns, len(found.data) - 1)
                around[some, :most] = np.where(columns < length[some, None], found.data[at], 0)
            shape = np.stack([last - first, found.place[kept] - first], axis=1).astype("<u2")
            around[:, most : most + 4] = shape.view(np.uint8)
            hashes, same = _equal_rows(around)
            text = found.text[kept]
            ids = named[text]
            least = np.full(same.max() + 1 if len(same) else 0, np.iinfo(np.int64).max)
            np.minimum.at(least, same, ids)
            later = ids > least[same]
            start = first - found.starts[text]

            rows = []
            texts, a, b = _merge(text[later], start[later], (start + length)[later])
            if len(texts):  # any bucket may hand them on
                bucket = int(named[texts[0]]) & ((1 << bits) - 1)
                rows.append((bucket, None, None, *_owners(texts, named, text_hash), a.astype("<u4").tobytes(), b.astype("<u4").tobytes()))
            key = np.where(hot, hashes, found.hashes[kept])
            rest = np.flatnonzero(~later)
            rest = rest[np.argsort(key[rest], kind="stable")]
            for bucket, x, y in _buckets(key[rest], bits):
                some = rest[x:y]
                held = around[some, :most][columns < length[some, None]]
                starts = start[some].astype("<u4").tobytes()
                rows.append((bucket, held.tobytes(), shape[some].tobytes(), *_owners(text[some], named, text_hash), starts, None))
            for k in range(0, len(rows), 64):
                part = list(zip(*rows[k : k + 64], strict=True))
                columns_out = [pa.array(part[0], pa.int32()), *(pa.array(v, pa.binary()) for v in part[1:])]
                yield pa.RecordBatch.from_arrays(columns_out, _CONTEXT_NAMES)

    return send


def _owners(text: np.ndarray, named: np.ndarray, text_hash: np.ndarray) -> tuple[bytes, bytes]:
    """The documents, each once, and the number of each row's among them."""
    texts, owner = np.unique(text, return_inverse=True)
    return np.stack([named[texts], text_hash[texts]]).tobytes(), owner.astype("<u4").tobytes()


_CONTEXTS = "bucket int, around binary, shape binary, documents binary, owners binary, starts binary, stops binary"
_CONTEXT_NAMES = [field.split()[0] for field in _CONTEXTS.split(", ")]


def _merge(owner: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of an owner that touch or overlap, as one; all sorted."""
    order = np.lexsort([start, owner])
    owner, start, stop = owner[order], start[order], stop[order]
    if not len(owner):
        return owner, start, stop
    span = int(stop.max()) + 1
    rank = np.cumsum(np.concatenate([[0], owner[1:] != owner[:-1]]))
    reach = np.maximum.accumulate(stop + rank * span) - rank * span
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return owner[first], start[first], np.maximum.reduceat(stop, first)


def equal_groups(rows: np.ndarray) -> np.ndarray:
    """Group numbers of equal byte rows, -1 for a row that no other equals.

    Most significant digit first: each pass sorts the rows that are still tied by their next
    eight bytes; rows that are alone by then leave.
    """
    n, width = rows.shape
    group = np.zeros(n, np.int64)
    tied = np.arange(n)
    for at in range(0, width, 8):
        digit = np.zeros((len(tied), 8), np.uint8)
        digit[:, : min(8, width - at)] = rows[tied, at : at + 8]
        digit = digit.view(">u8").ravel().astype(np.uint64)
        order = np.lexsort([digit, group[tied]])
        tied, digit = tied[order], digit[order]
        before = group[tied]
        new = np.ones(len(tied), bool)
        new[1:] = (before[1:] != before[:-1]) | (digit[1:] != digit[:-1])
        number = np.cumsum(new) - 1
        many = np.bincount(number, minlength=1)[number] > 1 if len(tied) else np.zeros(0, bool)
        group[tied] = number
        tied = tied[many]
        if not len(tied):
            break
    out = np.full(n, -1)
    out[tied] = group[tied]
    return out


def in_order(group: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by (group, bytes), and how many bytes each row shares with the one before it.

    Most significant digit first, as above. The first row of a group shares -1 bytes.
    """
    n, width = rows.shape
    order = np.argsort(group, kind="stable")
    group = group[order]
    first = np.ones(n, bool)
    first[1:] = group[1:] != group[:-1]
    run = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    tied = np.arange(n)
    for at in range(0, width, 8):
        digit = np.zeros((len(tied), 8), np.uint8)
        digit[:, : min(8, width - at)] = rows[order[tied], at : at + 8]
        digit = digit.view(">u8").ravel().astype(np.uint64)
        inner = np.lexsort([digit, run[tied]])
        order[tied] = order[tied][inner]
        digit, before = digit[inner], run[tied]
        new = np.ones(len(tied), bool)
        new[1:] = (before[1:] != before[:-1]) | (digit[1:] != digit[:-1])
        number = np.cumsum(new) - 1
        run[tied] = tied[new][number]
        tied = tied[np.bincount(number, minlength=1)[number] > 1]
        if not len(tied):
            break
    shared = np.full(n, -1)
    other = rows[order[1:]] != rows[order[:-1]]
    common = np.where(other.any(axis=1), other.argmax(axis=1), width) if width else np.zeros(max(0, n - 1), int)
    shared[1:] = np.where(first[1:], -1, common)
    return order, shared


def _covered(scheme: Scheme, data: np.ndarray, extra: np.ndarray, lead: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context, window) of the windows that a context of a smaller id has too.

    ``data`` has the contexts one after the other and their ends padded; a context's window k
    starts k bytes after it, up to ``extra``, and its anchor ``lead`` bytes after it. Windows
    can be equal only where their anchors are, so these are sorted first; then the bytes
    before the anchor, outwards, and those after it. A window is equal to another if they
    share the bytes it has on both sides.
    """
    length = extra + scheme.window
    anchor = np.cumsum(length) - length + lead
    group = equal_groups(np.lib.stride_tricks.sliding_window_view(data, scheme.anchor)[anchor])
    tied = np.flatnonzero(group >= 0)
    if not len(tied):
        return np.zeros((2, 0), np.int64)
    least, greatest = (np.full(group.max() + 1, fill) for fill in (np.iinfo(np.int64).max, np.iinfo(np.int64).min))
    np.minimum.at(least, group[tied], ids[tied])
    np.maximum.at(greatest, group[tied], ids[tied])
    tied = tied[least[group[tied]] < greatest[group[tied]]]
    anchor, extra, lead, ids, group = anchor[tied], extra[tied], lead[tied], ids[tied], group[tied]
    beside = np.arange(scheme.window - scheme.anchor)
    before = data[np.maximum(anchor[:, None] - 1 - beside, 0)]
    before[beside >= lead[:, None]] = 0
    after = data[anchor[:, None] + scheme.anchor + beside]
    after[beside >= (extra + scheme.window - scheme.anchor - lead)[:, None]] = 0
    sides = [in_order(group, side) for side in (before, after)]
    contexts, windows = [], []
    for left in range(scheme.reach):
        some = np.flatnonzero((lead - extra <= left) & (left <= lead))
        key = np.zeros(len(tied), np.int64)
        for (order, shared), depth in zip(sides, (left, scheme.window - scheme.anchor - left), strict=True):
            rank = np.empty(len(tied), np.int64)
            rank[order] = np.cumsum(shared < depth)
            key = key * (len(tied) + 1) + rank
        some = some[np.argsort(key[some])]
        if not len(some):
            continue
        new = np.ones(len(some), bool)
        new[1:] = key[some[1:]] != key[some[:-1]]
        smallest = np.minimum.reduceat(ids[some], np.flatnonzero(new))[np.cumsum(new) - 1]
        some = some[ids[some] > smallest]
        contexts.append(tied[some])
        windows.append(lead[some] - left)
    return np.concatenate([*contexts, np.zeros(0, np.int64)]), np.concatenate([*windows, np.zeros(0, np.int64)])


def _sort_windows(scheme: Scheme):
    def named(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and text hashes of the documents of all rows, and the places of owners among them."""
        documents = [np.frombuffer(v, np.int64).reshape(2, -1) for v in rows["documents"]]
        owners = [np.frombuffer(v, "<u4").astype(np.int64) for v in rows["owners"]]
        before = np.cumsum([0, *(d.shape[1] for d in documents[:-1])])
        return *np.concatenate(documents, axis=1), np.concatenate([o + b for o, b in zip(owners, before, strict=True)])

    def numbers(column: pd.Series, kind: str = "<u4") -> np.ndarray:
        return np.concatenate([np.frombuffer(v, kind) for v in column]).astype(np.int64)

    def sort_windows(rows: pd.DataFrame) -> pd.DataFrame:
        early = rows[rows["around"].isna()]
        rows = rows[rows["around"].notna()]
        done = [pd.DataFrame({name: np.zeros(0, np.int64) for name in ("doc_id", "text_hash", "start", "stop")})]
        if len(early):
            ids, hashes, owner = named(early)
            runs = {"start": numbers(early["starts"]), "stop": numbers(early["stops"])}
            done.append(pd.DataFrame({"doc_id": ids[owner], "text_hash": hashes[owner], **runs}))
        if len(rows):
            data = np.concatenate([*(np.frombuffer(v, np.uint8) for v in rows["around"]), np.zeros(2 * scheme.window, np.uint8)])
            extra, lead = numbers(rows["shape"], "<u2").reshape(-1, 2).T
            ids, hashes, owner = named(rows)
            context, window = _covered(scheme, data, extra, lead, ids[owner])
            at = numbers(rows["starts"])[context] + window
            document, a, b = _merge(owner[context], at, at + scheme.window)
            done.append(pd.DataFrame({"doc_id": ids[document], "text_hash": hashes[document], "start": a, "stop": b}))
        return pd.concat(done)

    return sort_windows


def repeated_runs(docs: DataFrame, window: int = 50, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(doc_id, text_hash, start, stop): bytes covered by a window that a smaller document has too.

    ``docs`` has (doc_id, text, text_hash) without null ids. Runs may overlap and repeat.
    An anchor that batches send ``hot_rows`` times or more has its windows dealt one by one;
    the result is the same.
    """
    spark = docs.sparkSession
    scheme = Scheme.of(window)
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    anchors = 2 * size // (window - scheme.probe) + 1
    bits = min(30, max(5, int(anchors // BUCKET_ANCHORS).bit_length()))
    table_bits = min(16, bits)  # of a table of fixed size
    sent = docs.select("doc_id", "text").mapInArrow(_send_anchors(scheme, table_bits), "bucket int, hashes binary")
    shared = sent.groupBy("bucket").applyInPandas(_share(table_bits, hot_rows), "bucket int, marks binary, hot binary")
    # The parts make up tables of 2^TABLE_BITS and 2^HOT_BITS bits, whatever the corpus holds.
    table = spark.sparkContext.broadcast(_Table(shared.toArrow(), table_bits))
    contexts = docs.select("doc_id", "text", "text_hash").mapInArrow(_send_contexts(table, scheme, bits), _CONTEXTS)
    return contexts.groupBy("bucket").applyInPandas(_sort_windows(scheme), _SPANS)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop the covered bytes; the runs are sorted and merged here, per document."""
    for batch in batches:
        kept, removed, spans = [], [], []
        for text, runs in zip(batch.column(1), batch.column(2), strict=True):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            found = runs.values if runs.is_valid else None
            if found is None or not len(found):
                kept.append(data)
                removed.append(0)
                spans.append([])
                continue
            start, stop = (found.field(i).to_numpy() for i in range(2))
            _, start, stop = _merge(np.zeros(len(start), np.int64), start, stop)
            bounds = [0, *np.stack([start, stop], axis=1).ravel().tolist(), len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True)))
            removed.append(int((stop - start).sum()))
            spans.append([{"start": a, "stop": b} for a, b in zip(start.tolist(), stop.tolist(), strict=True)])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        columns = [batch.column(0), pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(spans, kind)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "kept", "n_removed", "spans"])


def drop_repeats(
    docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """(doc_id, kept, n_removed, spans) for every row of ``docs``, with the bytes that remain.

    A byte goes if it lies in a string of ``window`` bytes that also starts in a document
    with a smaller id; all strings are those of the input. ``spans`` are the maximal removed
    runs of bytes, in order.

    A null text is empty. Rows that repeat an id do not cover each other; rows with a null
    id cover nothing and stay whole. Only the two named columns are read. An empty table
    gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    runs = repeated_runs(rows.where("doc_id is not null"), window, hot_rows)
    listed = runs.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
    listed = listed.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "runs")
    same = (F.col("doc_id") == F.col("id")) & (F.col("text_hash") == F.col("hash"))
    joined = rows.join(listed, same, "left").select("doc_id", F.col("text").cast("binary").alias("text"), "runs")
    kind = "doc_id long, kept binary, n_removed long, spans array<struct<start:long,stop:long>>"
    return joined.mapInArrow(_cut, kind)
