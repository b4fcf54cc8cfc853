"""Near-duplicate embeddings by lattice hashing.

Each of ``TABLES`` random projections takes a unit vector to eight dimensions, where the
nearest point of the lattice E8 is its home cell. A vector is entered in its home and, as a
probe, in the ``PROBES`` neighbouring cells (of 240) that lie nearest to it. In a cell all
entries are compared with those at home there, by cosine in double precision.

A cell sends on, for each vector, how many links it found, and as many links as join the
parts of the cell; never its pairs. A pair that meets in several cells is counted in the
first one only, which both vectors' keys tell. Cells with many entries are cut into tiles of
bounded size. Equal vectors form a class and enter once, with their number.

A pair at cosine 0.9 meets in a table with probability of about 0.6, closer ones more often;
the tests hold the recall against brute force. The share of a vector that eight of its
dimensions keep shrinks with its width, so the scale grows with the root of the width: pairs
are as far apart, and cells as full, at every width.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partwise.llm.common import settle
from partwise.llm.components import components
from partwise.llm.words import mix

TABLES, PROBES = 6, 6
#: What a unit vector of 64 dimensions is stretched by.
SCALE = 5.0
#: Entries at home, and entries in all, that one tile of a cell holds.
HOME_BLOCK, ENTRY_BLOCK = 2048, 4096


def lattice_roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    whole = [
        [a if k == i else b if k == j else 0 for k in range(8)]
        for i, j in itertools.combinations(range(8), 2)
        for a, b in itertools.product((1, -1), repeat=2)
    ]
    halves = [signs for signs in itertools.product((0.5, -0.5), repeat=8) if sum(s < 0 for s in signs) % 2 == 0]
    return np.array([*whole, *halves], float)


def _nearest_even(z: np.ndarray) -> np.ndarray:
    """The nearest whole points with an even sum (the lattice D8)."""
    point = np.rint(z)
    off = z - point
    rows = np.flatnonzero(point.sum(axis=1).astype(np.int64) & 1)
    worst = np.abs(off[rows]).argmax(axis=1)
    point[rows, worst] += np.where(off[rows, worst] >= 0, 1, -1)
    return point


def nearest_lattice_point(z: np.ndarray) -> np.ndarray:
    """E8 is D8 and D8 moved by a half in every direction: the nearer of both."""
    a, b = _nearest_even(z), _nearest_even(z - 0.5) + 0.5
    nearer = ((z - a) ** 2).sum(axis=1) <= ((z - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], a, b)


_ROOTS = lattice_roots()


def _cell_names(points: np.ndarray, table: int, width: int) -> np.ndarray:
    """64-bit names of lattice points (twice their coordinates are whole)."""
    name = np.full(points.shape[:-1], table * 100_003 + width, np.uint64)
    for k in range(8):
        name = mix(name * np.uint64(3) + np.rint(points[..., k] * 2).astype(np.int64).view(np.uint64))
    return name


@functools.lru_cache(maxsize=4)
def _projections(width: int) -> tuple[np.ndarray, np.ndarray]:
    """The directions of all tables, width x (8 * tables), stretched, and their offsets."""
    whole = max(width, 8)
    stretch = SCALE * math.sqrt(whole / 64)
    directions, offsets = [], []
    for t in range(TABLES):
        seeded = np.random.default_rng([t, width])
        directions.append(np.linalg.qr(seeded.normal(size=(whole, whole))[:, :8])[0][:width] * stretch)
        offsets.append(seeded.random(8) * 2)
    return np.concatenate(directions, axis=1), np.concatenate(offsets)


def cells(vectors: np.ndarray) -> np.ndarray:
    """Cell names, vectors x tables x (1 + probes); the home cell is first.

    A vector has the same cells in any batch: a matrix product may round by the batch's
    shape, sums taken one dimension after the other do not.
    """
    n, width = vectors.shape
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    directions, offsets = _projections(width)
    projected = np.tile(offsets, (n, 1))
    for unit, direction in zip(units.T, directions, strict=True):
        projected += unit[:, None] * direction
    out = np.empty((n, TABLES, 1 + PROBES), np.uint64)
    for t in range(TABLES):
        z = projected[:, 8 * t : 8 * t + 8]
        home = nearest_lattice_point(z)
        away = ((z - home)[:, None, :] - _ROOTS) ** 2
        near = np.argpartition(away.sum(axis=2), PROBES, axis=1)[:, :PROBES]
        out[:, t, 0] = _cell_names(home, t, width)
        out[:, t, 1:] = _cell_names(home[:, None, :] + _ROOTS[near], t, width)
    return out


def _checked(kind: str):
    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(vec_id, vector): the vector's numbers as bytes, null if it cannot link."""
        for batch in batches:
            vectors = []
            for value in batch.column(1):
                own = value.values if value.is_valid else None
                if own is None or not len(own) or own.null_count:
                    vectors.append(None)
                    continue
                row = own.to_numpy(zero_copy_only=False).astype(kind)
                top = np.abs(row).max()
                # Neither direction nor cosine depends on the length; this keeps squares of doubles finite.
                row = row if 1e-100 < top < 1e100 or not top > 0 else row / top
                vectors.append((row + 0.0).astype(kind).tobytes() if np.isfinite(top) and top > 0 else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vectors, pa.binary())], ["vec_id", "vector"])

    return checked


def _entries(kind: str):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                sizes = np.array([len(v.as_buffer()) for v in part.column(1)], np.int64)
                for size in np.unique(sizes):
                    same = part.take(pa.array(np.flatnonzero(sizes == size)))
                    rows = np.stack([np.frombuffer(v.as_buffer(), kind) for v in same.column(1)]).astype(float)
                    found = cells(rows).reshape(len(rows), -1).view(np.int64)
                    each = pa.array(np.repeat(np.arange(len(rows)), found.shape[1]))
                    home = np.tile(np.arange(found.shape[1]) % (1 + PROBES) == 0, len(rows))
                    columns = [same.column(0).take(each), pa.array(found.ravel()), pa.array(home)]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "cell", "home"])

    return entries


def _first_meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cell in which each pair of key tables (pairs x tables x (1 + probes)) meets first.

    A pair meets in the home of either one, if the other is entered there; of two such cells
    in the same table the one with the smaller name is first.
    """
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    at_a = np.where((b == a[:, :, :1]).any(axis=2), a[:, :, 0], none)
    at_b = np.where((a == b[:, :, :1]).any(axis=2), b[:, :, 0], none)
    either = np.minimum(at_a, at_b)
    table = (either != none).argmax(axis=1)
    return either[np.arange(len(a)), table]


def _compare(rows: pa.Table, kind: str, least: float) -> tuple[list, list]:
    """The links that a tile owns: (id, number of linked vectors), and (a, b) that join its parts."""
    cell = np.int64(rows["cell"][0].as_py()).view(np.uint64)
    ids, copies = rows["id"].to_numpy(), rows["copies"].to_numpy()
    home, asks, answers = (rows[name].to_numpy() for name in ("home", "asks", "answers"))
    vectors = np.stack([np.frombuffer(v.as_buffer(), kind) for v in rows["vector"]]).astype(float)
    norms = np.linalg.norm(vectors, axis=1)
    asks, answers = np.flatnonzero(asks), np.flatnonzero(answers)
    found = []
    for at in range(0, len(asks), 256):
        some = asks[at : at + 256]
        cosine = (vectors[some] @ vectors[answers].T) / (norms[some][:, None] * norms[answers])
        x, y = np.nonzero(cosine >= least)
        x, y = some[x], answers[y]
        found.append(np.stack([x, y])[:, ids[x] != ids[y]])
    pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    if not pairs.size:
        return [], []
    linked, place = np.unique(pairs, return_inverse=True)
    place = place.reshape(pairs.shape)
    keys = cells(vectors[linked])
    counts = np.zeros(len(linked), np.int64)
    part = list(range(len(linked)))
    links = []

    def root(i: int) -> int:
        while part[i] != i:
            part[i] = i = part[part[i]]
        return i

    for k in range(0, pairs.shape[1], 20_000):
        a, b = place[:, k : k + 20_000]
        mine = _first_meeting(keys[a], keys[b]) == cell
        a, b = a[mine], b[mine]
        np.add.at(counts, a, copies[linked[b]])
        visiting = ~home[linked[b]]
        np.add.at(counts, b[visiting], copies[linked[a[visiting]]])
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            p, q = root(i), root(j)
            if p != q:
                part[p] = q
                links.append((int(ids[linked[i]]), int(ids[linked[j]])))
    own = [(int(ids[linked[i]]), int(counts[i])) for i in np.flatnonzero(counts)]
    return own, links


def _tiles(kind: str, least: float):
    """Compare the tiles of a partition that is sorted by tile; only one is held at a time."""

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def outcome(rows: pa.Table) -> pa.RecordBatch:
            own, links = _compare(rows, kind, least)
            a = [i for i, _ in own] + [i for i, _ in links]
            b = [None] * len(own) + [j for _, j in links]
            n = [c for _, c in own] + [0] * len(links)
            return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (a, b, n)], ["a", "b", "n"])

        held: list[pa.RecordBatch] = []
        name = None
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("cell", "i", "j")]
            turns = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            bounds = [0, *turns.tolist(), len(batch)]
            for a, b in itertools.pairwise(bounds):
                if a == b:
                    continue
                here = tuple(int(c[a]) for c in columns)
                if held and here != name:
                    yield outcome(pa.Table.from_batches(held))
                    held = []
                name = here
                held.append(batch.slice(a, b - a))
        if held:
            yield outcome(pa.Table.from_batches(held))

    return tiles


def near_vectors(vectors: DataFrame, least: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Two vectors link if they are found and their cosine, in double precision, is ``least``
    or more; ``component_id`` is the smallest id reachable over links.

    Vectors that are null, empty, zero, or hold a null or a number that is not finite link
    with nothing, nor do vectors of different lengths with each other. Rows that repeat an
    id have the links of all its rows; equal rows with one id do not link with each other.
    A row with a null id has no links, a null component and is kept. Only the two named
    columns are read. An empty table gives an empty result.
    """
    floats = dict(vectors.dtypes)[vector_col] == "array<float>"
    kind, column = ("<f4", "array<float>") if floats else ("<f8", "array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(column).alias("embedding"))
    checked = settle(rows.mapInArrow(_checked(kind), "vec_id long, vector binary"), "vectors")
    usable = checked.where("vec_id is not null and vector is not null").withColumn("digest", F.sha2("vector", 256))
    distinct = usable.select("digest", "vec_id").distinct()
    classes = settle(distinct.groupBy("digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "classes")
    first = usable.join(classes, "digest").where("vec_id = rep").dropDuplicates(["digest"])
    reps = settle(first.select(F.col("rep").alias("id"), "vector", "copies"), "reps")

    entries = settle(reps.select("id", "vector").mapInArrow(_entries(kind), "id long, cell long, home boolean"), "entries")
    sizes = entries.groupBy("cell").agg(F.sum(F.col("home").cast("long")).alias("homes"), F.count("*").alias("all"))
    shared = sizes.where("homes > 0 and `all` > 1").select(
        "cell",
        F.ceil(F.col("homes") / HOME_BLOCK).cast("int").alias("home_blocks"),
        F.ceil(F.col("all") / ENTRY_BLOCK).cast("int").alias("entry_blocks"),
    )
    placed = entries.join(settle(shared, "cells"), "cell")
    row = F.pmod(F.xxhash64("id", F.lit(0)), F.col("home_blocks")).cast("int")
    column = F.pmod(F.xxhash64("id", F.lit(1)), F.col("entry_blocks")).cast("int")

    def place(i: Column, j: Column, asks: Column, answers: bool) -> Column:
        return F.struct(i.alias("i"), j.alias("j"), asks.alias("asks"), F.lit(answers).alias("answers"))

    # An entry answers in its column of tiles; at home it also asks, along its row of tiles.
    every_row = F.sequence(F.lit(0), F.col("home_blocks") - 1)
    every_column = F.filter(F.sequence(F.lit(0), F.col("entry_blocks") - 1), lambda j: F.col("home") & (j != column))
    answering = F.transform(every_row, lambda i: place(i, column, F.col("home") & (i == row), True))
    asking = F.transform(every_column, lambda j: place(row, j, F.lit(True), False))
    tiles = placed.select("id", "cell", "home", F.inline(F.concat(answering, asking))).join(reps, "id")
    sorted_tiles = tiles.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    outcome = settle(sorted_tiles.mapInArrow(_tiles(kind, least), "a long, b long, n long"), "links")

    counts = outcome.where("b is null").groupBy(F.col("a").alias("counted")).agg(F.sum("n").alias("links"))
    # All ids of a class link to its smallest; an id in several classes ties them together.
    ties = usable.join(classes, "digest").select("vec_id", "rep", "copies").distinct()
    roots = components(
        outcome.where("b is not null").select("a", "b").union(ties.select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))), "a", "b"
    )
    own = (
        ties.join(counts, F.col("rep") == F.col("counted"), "left")
        .groupBy("vec_id")
        .agg(F.sum(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    known = own.join(roots, F.col("vec_id") == F.col("node"), "left").select(F.col("vec_id").alias("known"), "n_links", F.coalesce("root", "vec_id").alias("component_id"))
    joined = checked.select("vec_id").join(known, F.col("vec_id") == F.col("known"), "left")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
