"""Lattice hashing against all pairs."""

from __future__ import annotations

import itertools

import numpy as np
import pytest

from partwise.llm import lattice


def made(seed, dims):
    r = np.random.default_rng(seed)
    rows = []
    for base in range(40):
        centre = r.normal(size=dims)
        for _ in range(r.choice([1, 1, 4, 12])):
            noise = r.normal(size=dims) * r.choice([0.0, 0.05, 0.2, 0.32])
            rows.append((centre + noise) * r.choice([1e-6, 1.0, 50.0]))
    return rows


def brute(vectors, least):
    links = {i: set() for i in range(len(vectors))}
    for i, j in itertools.combinations(range(len(vectors)), 2):
        a, b = vectors[i], vectors[j]
        if len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= least:
            links[i].add(j)
            links[j].add(i)
    return links


def groups(links):
    least = {}
    for start in sorted(links):
        if start not in least:
            todo = [start]
            while todo:
                at = todo.pop()
                if at not in least:
                    least[at] = start
                    todo += links[at]
    return least


@pytest.mark.parametrize(("kind", "home", "entry"), [("float", 2048, 4096), ("double", 3, 5)])
def test_recall_and_exact_links(spark, monkeypatch, kind, home, entry):
    monkeypatch.setattr(lattice, "HOME_BLOCK", home)
    monkeypatch.setattr(lattice, "ENTRY_BLOCK", entry)
    vectors = [v.astype(np.float32).astype(float) for v in made(1, 64)]
    want = brute(vectors, 0.9)
    docs = spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(vectors)], f"vec_id long, embedding array<{kind}>, cell string")
    found = {r.vec_id: r for r in lattice.near_vectors(docs.repartition(3)).collect()}
    assert len(found) == len(vectors)
    total = sum(map(len, want.values()))
    got = sum(r.n_links for r in found.values())
    assert all(found[i].n_links <= len(want[i]) for i in want)
    assert got >= 0.9 * total and total > 100
    if got == total:
        assert {i: r.component_id for i, r in found.items()} == groups(want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


def test_recall_at_the_threshold():
    """Pairs at cosine 0.9 exactly, the hardest there are."""
    r = np.random.default_rng(3)
    a = r.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    z = r.normal(size=a.shape)
    z -= (z * a).sum(axis=1, keepdims=True) * a
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    x, y = lattice.cells(a), lattice.cells(0.9 * a + np.sqrt(0.19) * z)
    met = (x == y[:, :, :1]).any(axis=(1, 2)) | (y == x[:, :, :1]).any(axis=(1, 2))
    assert met.mean() >= 0.95


@pytest.mark.parametrize("width", [1, 2, 4, 8, 12, 16, 24, 32, 64, 384, 768])
def test_recall_and_cells_at_every_width(width):
    r = np.random.default_rng(width)
    a = r.normal(size=(1000, width))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = a * 3
    if width > 1:
        z = r.normal(size=a.shape)
        z -= (z * a).sum(axis=1, keepdims=True) * a
        b = 0.9 * a + np.sqrt(0.19) * z / np.linalg.norm(z, axis=1, keepdims=True)
    x, y = lattice.cells(a), lattice.cells(b)
    met = (x == y[:, :, :1]).any(axis=(1, 2)) | (y == x[:, :, :1]).any(axis=(1, 2))
    assert met.mean() >= 0.95
    if width >= 16:
        assert max(np.unique(x[:, t, 0], return_counts=True)[1].max() for t in range(lattice.TABLES)) < 20


def test_a_vector_has_the_same_cells_in_any_batch():
    vectors = np.random.default_rng(5).normal(size=(700, 96))
    whole = lattice.cells(vectors)
    for size in (1, 2, 3, 7, 64, 699):
        some = np.concatenate([lattice.cells(vectors[k : k + size]) for k in range(0, 700, size)])
        assert (some == whole).all()


@pytest.mark.parametrize("width", [4, 16, 256])
def test_recall_of_links_at_other_widths(spark, width):
    vectors = [v.astype(np.float32).astype(float) for v in made(width, width)]
    want = brute(vectors, 0.9)
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    found = {r.vec_id: r for r in lattice.near_vectors(docs.repartition(3)).collect()}
    total = sum(map(len, want.values()))
    assert all(found[i].n_links <= len(want[i]) for i in want)
    assert sum(r.n_links for r in found.values()) >= 0.9 * total and total > 100


def test_odd_vectors(spark):
    one = [1.0, 0.0, 0.0]
    rows = [
        (1, one), (2, [2.0, 0.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 0.0]), (7, [float("nan"), 1.0, 0.0]),
        (8, [float("inf"), 0.0, 0.0]), (9, [1e300, 0.0, 0.0]), (10, [1.0, 0.0]), (None, one), (1, one), (11, one), (12, [-1.0, 0.0, 0.0]),
    ]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in lattice.near_vectors(docs).collect()]
    linked = {1: 3, 2: 3, 9: 3, 11: 3}
    want = [(d, linked.get(d, 0), 1 if d in linked else d, d is None or d not in linked or d == 1) for d, _ in rows]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert lattice.near_vectors(docs.limit(0)).collect() == []


def test_nearest_lattice_point():
    r = np.random.default_rng(0)
    z = r.normal(size=(400, 8)) * 2
    point = lattice.nearest_lattice_point(z)
    doubled = np.rint(point * 2)
    assert (np.abs(point * 2 - doubled) < 1e-9).all()
    assert ((doubled % 2 == doubled[:, :1] % 2).all(axis=1)).all() and (np.rint(point.sum(axis=1)) % 2 == 0).all()
    own = ((z - point) ** 2).sum(axis=1)
    near = ((z[:, None, :] - point[:, None, :] - lattice.lattice_roots()) ** 2).sum(axis=2)
    assert (own[:, None] <= near + 1e-9).all() and len(lattice.lattice_roots()) == 240
