"""Near-duplicate documents by min-max hashing, with links confirmed on the full sets.

Every permutation of a document's word shingles gives two signature values, the smallest
and the largest image, so ``PERMUTATIONS`` hash passes fill twice as many places. The
values are banded; documents that agree in a band meet in its bucket.

1. Documents with equal shingle sets form a class, known by its smallest id. Only classes
   go on, so copies are never paired.
2. Every bucket names a pivot: its most popular member, the one that meets most others over
   all buckets. In a group of edited copies that is the text they were made from.
3. All members that share a pivot are compared there, in blocks of bounded size: first with
   the pivot, then those it does not reach with all others. Any two members of a bucket
   share its pivot, so no candidate pair is left out, yet no list of pairs is ever made:
   only links that join separate parts of a block come out.
4. Members that a block leaves out of the pivot's part are compared with the other blocks of
   the pivot, and linked to every part there that they are near to.

With 24 bands of 4 values a pair at similarity 0.8 stays unseen with probability 3e-6.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm.bits import BitTable
from partwise.llm.common import keep_ids_once, settle
from partwise.llm.components import components
from partwise.llm.words import chunks, mix, shingle_sets, split_words

BANDS, ROWS = 24, 4
PERMUTATIONS = BANDS * ROWS // 2
#: Shingles that one block of a pivot's members holds, about; 8 bytes each.
BLOCK_SHINGLES = 1 << 20

_SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"


def _multipliers() -> np.ndarray:
    return mix(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64)) | np.uint64(1)


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``BANDS`` bucket keys for each set; the sets must not be empty."""
    starts = np.cumsum([0, *map(len, sets[:-1])])
    items = np.concatenate(sets)
    keys = np.tile(mix(np.arange(BANDS, dtype=np.uint64)), (len(sets), 1))
    for i, a in enumerate(_multipliers()):
        images = (items ^ (a >> np.uint64(7))) * a
        images ^= images >> np.uint64(32)
        images *= a
        band = i * 2 // ROWS
        keys[:, band] = mix(keys[:, band] + np.minimum.reduceat(images, starts))
        keys[:, band] = mix(keys[:, band] * np.uint64(3) + np.maximum.reduceat(images, starts))
    return keys


def _sign(words: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in chunks(batch.column(1)):
                sets = shingle_sets(split_words(texts), words)
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                sums = np.zeros((2, len(sets)), np.uint64)
                sums[0, full] = [s.sum(dtype=np.uint64) for s in sets if len(s)]
                sums[1, full] = [mix(s).sum(dtype=np.uint64) for s in sets if len(s)]
                bands: list = [None] * len(sets)
                if len(full):
                    rows = band_keys([sets[i] for i in full]).view(np.int64)
                    for i, row in zip(full, rows, strict=True):
                        bands[i] = row
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        pa.array(sizes),
                        *(pa.array(s.view(np.int64)) for s in sums),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "d1", "d2", "bands"],
                )

    return sign


def _only(table):
    def only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            held = table.value.holds(ids.fill_null(0).to_numpy()) & ids.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(held))

    return only


def _list_shingles(words: int):
    def list_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in chunks(batch.column(1)):
                sets = [s.tobytes() for s in shingle_sets(split_words(texts), words)]
                ids = batch.column(0).slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([ids, pa.array(sets, pa.binary())], ["id", "shingles"])

    return list_shingles


class _Block:
    """Shingle sets side by side, to intersect one of them with all others at once."""

    def __init__(self, sets: list[bytes]):
        arrays = [np.frombuffer(s, np.uint64) for s in sets]
        self.sizes = np.array([len(a) for a in arrays], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        names, self.items = np.unique(np.concatenate(arrays), return_inverse=True)
        self.mark = np.zeros(len(names), bool)

    def near(self, i: int, percent: int) -> np.ndarray:
        """Which sets have 100 * intersection >= percent * union with the ``i``-th."""
        own = self.items[self.starts[i] : self.starts[i + 1]]
        self.mark[own] = True
        common = np.add.reduceat(self.mark[self.items], self.starts[:-1], dtype=np.int64)
        self.mark[own] = False
        return 100 * common >= percent * (self.sizes + self.sizes[i] - common)


def _compare(ids: np.ndarray, block: _Block, asking: Iterable[int], percent: int, part: np.ndarray) -> list:
    """Links that join separate parts; ``part`` says where each member is, and follows.

    ``asking`` members compare themselves with all others.
    """
    found = []
    for i in asking:
        near = np.flatnonzero(block.near(i, percent))
        parts, first = np.unique(part[near], return_index=True)
        for p, j in zip(parts, near[first], strict=True):
            if p != part[i]:
                found.append((int(ids[i]), int(ids[j])))
                part[part == p] = part[i]
    return found


def _within_block(percent: int):
    def within_block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["is_pivot", "id"], ascending=[False, True], ignore_index=True)
        ids = rows["id"].to_numpy()
        part = np.arange(len(ids))
        # The pivot asks, then those that have not come to its part when their turn comes.
        asking = (i for i in range(len(ids)) if not i or part[i] != part[0])
        out = [(a, b, None) for a, b in _compare(ids, _Block(list(rows["shingles"])), asking, percent, part)]
        if rows["blocks"][0] > 1:
            # A part is known by one of its members.
            out += [(int(ids[i]), int(ids[part[i]]), int(rows["pivot"][0])) for i in np.flatnonzero(part != part[0])]
        return pd.DataFrame(out, columns=["a", "b", "pivot"], dtype="Int64")

    return within_block


def _across_blocks(percent: int):
    def across_blocks(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["asks", "id"], ascending=[False, True], ignore_index=True)
        ids, asks = rows["id"].to_numpy(), int(rows["asks"].sum())
        _, part = np.unique(rows["part"].to_numpy(), return_inverse=True)
        found = _compare(ids, _Block(list(rows["shingles"])), range(asks), percent, part)
        return pd.DataFrame(found, columns=["a", "b"], dtype="Int64")

    return across_blocks


def _star_members(signed: DataFrame) -> DataFrame:
    """(pivot, id) of all members of shared buckets, pivots with themselves included."""
    entries = settle(signed.select("id", F.explode("bands").alias("key")).distinct(), "buckets")
    shared = entries.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    met = settle(entries.join(shared, "key"), "met")
    popular = met.groupBy("id").agg(F.sum("members").alias("popularity"))
    ranked = met.drop("members").join(popular, "id")
    best = F.max(F.struct("popularity", (-F.col("id")).alias("negative")))
    pivots = ranked.groupBy("key").agg(best.alias("best"))
    return met.join(pivots, "key").select((-F.col("best.negative")).alias("pivot"), "id").distinct()


def near_duplicate_links(signed: DataFrame, sets_of, percent: int) -> DataFrame:
    """Links (a, b) that connect what the confirmed pairs connect; settled.

    ``signed`` has (id, bands), one row per class; ``sets_of(ids)`` gives (id, shingles).
    """
    stars = settle(_star_members(signed), "stars")
    sets = settle(sets_of(stars.select("id").distinct()), "shingles")
    sizes = sets.select("id", (F.length("shingles") / 8).cast("long").alias("size"))
    weights = stars.join(sizes, "id").groupBy("pivot").agg(F.sum("size").alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK_SHINGLES).cast("int")
    weights = settle(weights.select("pivot", blocks.alias("blocks")), "blocks")
    members = stars.join(weights, "pivot").withColumn("is_pivot", F.col("id") == F.col("pivot"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    places = F.when(F.col("is_pivot"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))
    placed = members.select("*", F.explode(places).alias("block"))
    tiles = placed.join(sets, "id").groupBy("pivot", "block")
    outcome = settle(tiles.applyInPandas(_within_block(percent), "a long, b long, pivot long"), "within")
    links = outcome.where("pivot is null").select("a", "b")

    # Only pivots with more than one block have rows from here on. What a member's links within
    # its block connect it to is its part; the pivot's is the same one in all blocks.
    alone = outcome.where("pivot is not null").groupBy("pivot", F.col("a").alias("id")).agg(F.min("b").alias("part"))
    counts = alone.groupBy("pivot").agg(F.count("*").alias("n"))
    wide = weights.join(counts, "pivot")
    slices = F.greatest(F.lit(1), F.ceil(F.col("n") / 512)).cast("int")
    wide = wide.select("pivot", "blocks", slices.alias("slices"))
    home = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    asking = (
        alone.join(wide, "pivot")
        .select("pivot", "id", "part", F.explode(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: j != home)).alias("block"), F.pmod(F.xxhash64("id", F.lit(1)), F.col("slices")).cast("int").alias("slice"))
        .withColumn("asks", F.lit(True))
    )
    asked = (
        stars.join(wide, "pivot")
        .join(alone, ["pivot", "id"], "left")
        .select("pivot", "id", F.coalesce("part", "pivot").alias("part"), home.alias("block"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
        .withColumn("asks", F.lit(False))
    )
    tiles = asking.unionByName(asked).join(sets, "id").groupBy("pivot", "block", "slice")
    return links.union(tiles.applyInPandas(_across_blocks(percent), "a long, b long"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Two documents are linked if 100 * |A & B| >= percent * |A | B| for their sets of
    ``words``-word shingles (words lower-cased A-Z, split at space and 0x09-0x0D; fewer
    words: the whole sequence). ``component_id`` is the smallest id reachable over links.

    Null, empty and blank texts have no shingles and link with nothing. Rows that repeat an
    id are one document, linked through any of its texts; each row is returned. Rows with a
    null id get their number of shingles, a null component and ``kept`` true. Only the two
    named columns are read. An empty table gives an empty result.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = settle(texts.mapInArrow(_sign(words), _SIGNED), "signatures")
    named = signed.where("doc_id is not null and n_shingles > 0")
    digest = ["d1", "d2", "n_shingles"]
    classes = settle(named.groupBy(*digest).agg(F.min("doc_id").alias("rep")), "classes")
    members = named.join(classes, digest)

    def sets_of(ids: DataFrame) -> DataFrame:
        # Texts that met no other leave before the join moves them.
        table = docs.sparkSession.sparkContext.broadcast(BitTable.of(ids))
        met = texts.mapInArrow(_only(table), texts.schema)
        wanted = met.join(ids, F.col("doc_id") == F.col("id"), "left_semi")
        listed = wanted.mapInArrow(_list_shingles(words), "id long, shingles binary")
        return listed.where(F.length("shingles") > 0)

    reps = members.where("doc_id = rep").select(F.col("doc_id").alias("id"), "bands")
    links = near_duplicate_links(reps, sets_of, percent)
    # A repeated id may stand in several classes; its rows tie them together.
    ties = members.where("doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    repeated = named.groupBy("doc_id").agg(F.min("d1").alias("lo"), F.max("d1").alias("hi")).where("lo != hi")
    ties = ties.join(repeated, F.col("a") == F.col("doc_id"), "left_semi")
    roots = components(links.union(ties), "a", "b")
    grouped = members.join(roots, F.col("rep") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "rep").alias("component_id")
    )
    rest = signed.where("doc_id is null or n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    every = grouped.unionByName(rest)
    return every.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with the smallest id of each group of near duplicates, all columns.

    Of rows that repeat an id the first by a hash of all columns stays; rows with a null id
    all stay, as do documents without words.
    """
    found = near_duplicates(docs, words=words, percent=percent)
    return keep_ids_once(docs, found.where("kept and doc_id is not null").select("doc_id"))
