"""Repeated byte windows against a dictionary of all windows."""

from __future__ import annotations

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from partwise.llm import suffixes


def brute(rows, window):
    """(doc_id, text) -> kept bytes and removed runs."""
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - window + 1):
            if doc_id is not None:
                key = data[p : p + window]
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - window + 1):
            if doc_id is not None and first[data[p : p + window]] < doc_id:
                gone[p : p + window] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        out.append((doc_id, kept, int(gone.sum()), list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))))
    return sorted(out, key=repr)


def made(seed):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(40)]
    passages = [" ".join(r.choice(words) for _ in range(r.randint(5, 40))) for _ in range(8)]
    rows = []
    for i in r.sample(range(-500, 500), 60):
        parts = [r.choice(passages) if r.random() < 0.4 else " ".join(r.choice(words) for _ in range(r.randint(0, 30))) for _ in range(r.randint(0, 5))]
        rows.append((i, " ".join(parts)))
    rows += [(600, None), (601, ""), (602, "ab" * 300), (603, "ab" * 200), (604, "a" * 49), (605, "a" * 50), (606, "a" * 51)]
    rows += [(None, passages[0] * 2), (None, passages[0] * 2), (700, rows[3][1]), (700, rows[3][1]), (700, rows[4][1] + "x" * 60)]
    return rows


@pytest.mark.parametrize(("seed", "window", "hot_rows"), [(1, 50, 1 << 14), (2, 50, 3), (3, 33, 1 << 14), (4, 33, 2)])
def test_same_as_all_windows(spark, seed, window, hot_rows):
    rows = made(seed)
    docs = spark.createDataFrame([(*row, i, 1.0) for i, row in enumerate(rows)], "doc_id long, text string, start int, runs double")
    found = suffixes.drop_repeats(docs.repartition(5), window, hot_rows=hot_rows).collect()
    got = sorted(((r.doc_id, bytes(r.kept), r.n_removed, [(s.start, s.stop) for s in r.spans]) for r in found), key=repr)
    assert got == brute(rows, window)


def test_windows_of_a_hot_anchor_are_spread():
    """One passage in all documents, with different bytes around: no bucket holds a row of each."""
    r = random.Random(5)
    passage = "".join(r.choice("abcdefgh ") for _ in range(90))
    texts = ["".join(r.choice("xyz") for _ in range(60)) + passage + "".join(r.choice("xyz") for _ in range(60)) for _ in range(300)]
    scheme, bits = suffixes.Scheme.of(50), 8
    batches = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array([t]), pa.array([i])], ["id", "text", "hash"]) for i, t in enumerate(texts)]
    sent = pa.Table.from_batches(suffixes._send_anchors(scheme, 5)(iter(batches)))
    largest = {}
    for hot_rows in (1 << 14, 50):
        parts = [suffixes._share(5, hot_rows)(rows) for _, rows in sent.to_pandas().groupby("bucket")]
        table = SimpleNamespace(value=suffixes._Table(pa.concat_tables([pa.Table.from_pandas(p) for p in parts]), 5))
        distinct = {}
        for batch in suffixes._send_contexts(table, scheme, bits)(iter(batches)):
            for bucket, around, owners in zip(*(batch.column(c).to_pylist() for c in ("bucket", "around", "owners")), strict=True):
                if around is not None:
                    distinct.setdefault(bucket, set()).add(around)
        largest[hot_rows] = max(len(v) for v in distinct.values())
    assert largest[1 << 14] > 200  # else the edges of the passage would prove nothing
    assert largest[50] < 100


@pytest.mark.parametrize("width", [0, 3, 8, 11])
def test_order_and_shared_bytes(width):
    r = np.random.default_rng(width)
    rows, group = r.integers(0, 3, (400, width)).astype(np.uint8), r.integers(-5, 5, 400)
    order, shared = suffixes.in_order(group, rows)
    keys = [(int(group[i]), bytes(rows[i])) for i in order]
    assert keys == sorted(keys) and sorted(order.tolist()) == list(range(400))
    assert shared[0] == -1
    for before, key, common in zip(keys, keys[1:], shared[1:].tolist(), strict=False):
        same = next((k for k in range(width) if before[1][k] != key[1][k]), width)
        assert common == (same if before[0] == key[0] else -1)


def test_long_texts_are_cut_with_an_overlap(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "STEP", 100)
    rows = made(4)
    batch_rows = [(i, t) for i, t in rows if i is not None]
    whole = suffixes._scan(pa.array([t for _, t in batch_rows]), suffixes.Scheme.of(50))
    windows = sum(max(0, len((t or "").encode()) - 49) for _, t in batch_rows)
    assert int((whole.last - whole.first + 1).sum()) == windows


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.drop_repeats(docs).collect() == []


def test_groups_of_equal_rows():
    r = np.random.default_rng(0)
    rows = r.integers(0, 2, (500, 11)).astype(np.uint8)
    rows[:, 9:] = 7
    group = suffixes.equal_groups(rows)
    texts = [bytes(row) for row in rows]
    for i, text in enumerate(texts):
        same = {j for j, other in enumerate(texts) if other == text}
        assert (group[i] < 0) == (len(same) == 1)
        if group[i] >= 0:
            assert same == set(np.flatnonzero(group == group[i]).tolist())
