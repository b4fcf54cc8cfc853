"""Near-duplicate groups against all pairs of shingle sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from partwise.llm import minhash, words
from partwise.llm.components import components


def shingles(text, n):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return set()
    return {tuple(found[i : i + n]) for i in range(max(1, len(found) - n + 1))}


def brute(rows, n, percent):
    """{doc_id: smallest reachable id}"""
    parent = {d: d for d, _ in rows if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(d, shingles(t, n)) for d, t in rows if d is not None]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {d: root(d) for d in parent}


def made(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "é", "The", "the", " x"]
    rows = []
    for base in range(12):
        text = [r.choice(vocabulary) for _ in range(r.randint(1, 120))]
        for _ in range(r.choice([1, 1, 3, 9])):
            own = list(text)
            for _ in range(r.choice([0, 0, 1, 2, 4, 8])):
                own[r.randrange(len(own))] = r.choice(vocabulary)
            rows.append((r.randint(-10_000, 10_000), r.choice([" ", "  ", "\n", "\t "]).join(own)))
    rows += [(20_000, None), (20_001, ""), (20_002, " \n\t"), (20_003, "one"), (20_004, "ONE"), (20_005, "one two"), (None, rows[0][1])]
    rows += [(rows[1][0], rows[1][1]), (20_006, rows[5][1]), (20_006, rows[9][1]), (20_007, " ".join(vocabulary * 30))]
    return rows


@pytest.mark.parametrize(("seed", "n", "percent", "block"), [(1, 2, 80, 1 << 20), (2, 2, 80, 150), (3, 5, 80, 400), (4, 1, 60, 100)])
def test_same_as_all_pairs(spark, monkeypatch, seed, n, percent, block):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", block)
    rows = made(seed)
    docs = spark.createDataFrame([(*row, 0, "k") for row in rows], "doc_id long, text string, kept int, pivot string")
    found = minhash.near_duplicates(docs.repartition(4), words=n, percent=percent).collect()
    want = brute(rows, n, percent)
    assert sorted((r.doc_id, r.n_shingles) for r in found if r.doc_id is not None) == sorted(
        (d, len(shingles(t, n))) for d, t in rows if d is not None
    )
    for r in found:
        assert r.component_id == (want[r.doc_id] if r.doc_id is not None else None)
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)


def linked(spark, sets, bands, percent=80):
    """{id: smallest id} over the links of the members of shared ``bands``."""
    signed = spark.createDataFrame([(i, [band]) for i, band in bands.items()], "id long, bands array<long>")
    rows = [(i, np.array(sorted(s), np.uint64).tobytes()) for i, s in sets.items()]
    listed = spark.createDataFrame(rows, "id long, shingles binary")
    links = minhash.near_duplicate_links(signed, lambda ids: listed.join(ids, "id", "left_semi"), percent)
    found = dict(map(tuple, components(links, "a", "b").collect()))
    return {i: found.get(i, i) for i in sets}


def smallest(sets, bands, percent=80):
    """The same from all pairs."""
    root = {i: i for i in sets}
    for a in sets:
        for b in sets:
            near = 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
            if bands[a] == bands[b] and near and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    return root


def test_a_chain_over_two_blocks_of_a_pivot(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 50)  # five sets of 20: two blocks
    blocks = spark.range(1, 100).selectExpr("id", "pmod(xxhash64(id), 2) AS block").collect()
    x, i, *_ = [r.id for r in blocks if r.block == 0]
    y1, y2, *_ = [r.id for r in blocks if r.block == 1]
    # Only neighbours of the chain x, y2, i, y1 are near; the pivot is near to none.
    sets = {m: set(range(2 * at, 2 * at + 20)) for at, m in enumerate([x, y2, i, y1])} | {0: set(range(1000, 1020))}
    bands = dict.fromkeys(sets, 7)
    low = min(x, y1)
    assert linked(spark, sets, bands) == smallest(sets, bands) == {x: low, i: low, y1: low, y2: low, 0: 0}


@pytest.mark.parametrize("block", [60, 150])
def test_random_chains_over_blocks_of_a_pivot(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", block)
    r = random.Random(block)
    ids = iter(r.sample(range(10**6), 600))
    sets, bands = {}, {}
    for band in range(40):
        for m in [next(ids) for _ in range(r.randint(5, 15))]:
            start = r.randrange(30)
            sets[m], bands[m] = set(range(start, start + 20)), band
    assert linked(spark, sets, bands) == smallest(sets, bands)


def test_dropping_keeps_one_of_each_group(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(5, text, "a"), (3, text + " more", "b"), (3, text + " more", "c"), (8, "other words here", "d"), (None, text, "e"), (9, None, "f"), (10, "", "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rank string")
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    found = kept.collect()
    assert sorted((r.doc_id for r in found), key=repr) == sorted([3, 8, None, 9, 10], key=repr)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(docs).collect() == []
    assert minhash.drop_near_duplicates(docs).collect() == []


def test_bands_find_pairs_at_the_threshold():
    r = np.random.default_rng(1)
    missed = 0
    for _ in range(300):
        a = r.integers(0, 1 << 63, 180, dtype=np.uint64)
        b = np.concatenate([a[:160], r.integers(0, 1 << 63, 20, dtype=np.uint64)])  # 160 / 200
        keys = minhash.band_keys([np.unique(a), np.unique(b)])
        missed += not (keys[0] == keys[1]).any()
    assert missed == 0


def test_words_of_many_texts_in_one_buffer():
    texts = ["A b\tC", None, "", " x", "y", "z ", "É e\x0bq\x1cr", "x" * 10]
    found = words.split_words(pa.array(texts))
    got = [[bytes(found.data[s:e]) for s, e in zip(found.starts[a:b], found.ends[a:b], strict=True)] for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
    assert got == [[w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))] for t in texts]
    flat = [w for own in got for w in own]
    same = {}
    for word, h in zip(flat, found.hashes.tolist(), strict=True):
        assert same.setdefault(word, h) == h
    assert len(set(same.values())) == len(same)


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    r = random.Random(seed)
    nodes = [r.randint(-(10**12), 10**12) for _ in range(120)]
    edges = [(r.choice(nodes), r.choice(nodes)) for _ in range(90)] + [(a, b) for a, b in zip(nodes[:40], nodes[1:41])]
    edges += [(nodes[50], n) for n in nodes[60:100]] + [(7, 7), (None, 3), (3, None)] + edges[:5]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            p, q = root(a), root(b)
            parent[max(p, q)] = min(p, q)
    found = components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()
    assert sorted(map(tuple, found)) == sorted((n, root(n)) for n in parent)
