"""Benchmark decontamination: rare words and word pairs, then Smith-Waterman alignment.

1. The words and pairs of neighbouring words of the test items are its features; their
   occurrences in the whole corpus are counted.
2. An alignment of m matching words in b unbroken blocks scores 2 m - (b - 1) at most and
   matches 2 m - b features. So one that is good enough matches ``_needed`` features, and
   however the most frequent features are left out up to a share of that number, the others
   hold the rest of it. They are the item's seeds.
3. Documents are cut into passages that overlap by more than an alignment can reach. Passages
   with enough seeds of an item are joined to it; no other can hold a good alignment.
4. Local alignment of the item's words with the passage scores what replaced, added and
   dropped words leave of it, as a share of the score of a whole copy.

Words split at blanks and ASCII marks, A-Z lower-cased; they are compared by 64-bit hashes.
The tasks get a bit table of the features, of fixed size whatever the benchmark holds; it only
spares rows, the joins on the features themselves decide.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partwise.llm.bits import BitTable
from partwise.llm.common import drop_ids, settle
from partwise.llm.words import chunks, gram_hashes, mix, split_words

#: Of shorter items a part is no evidence (half of two words is one word), so they count whole only.
PART_WORDS = 3
#: Words in a feature.
GRAMS = (1, 2)
#: The part of the needed features that has to be found among the seeds.
SEEN = 0.25
PASSAGE_WORDS = 256
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST = 0.5


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, words, runs) of every item; runs are its features, repeated ones too."""
    for batch in batches:
        for at, texts in chunks(batch.column(1)):
            found = split_words(texts, at_marks=True)
            words, runs = [], []
            for a, b in zip(found.first[:-1], found.first[1:], strict=True):
                words.append(found.hashes[a:b].view(np.int64))
                runs.append(np.concatenate([gram_hashes(found.hashes[a:b], n) for n in GRAMS]).view(np.int64))
            kind = pa.list_(pa.int64())
            columns = [batch.column(0).slice(at, len(texts)), pa.array(words, kind), pa.array(runs, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["item_id", "words", "runs"])


def _inside(found, n: int) -> tuple[np.ndarray, np.ndarray]:
    """All runs of ``n`` words that lie within one text: their hashes and their texts."""
    runs = gram_hashes(found.hashes, n)
    owner = np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))
    owner = owner[: len(runs)]
    last = found.first[1:][owner]
    whole = np.arange(len(runs)) + n <= last
    return np.where(whole, runs, np.uint64(0)), np.where(whole, owner, -1)


def _held(found, table) -> tuple[np.ndarray, np.ndarray]:
    """The features within the texts that the table lets through, and the words they start at."""
    every, at = [], []
    for n in GRAMS:
        runs, owner = _inside(found, n)
        hits = np.flatnonzero((owner >= 0) & table.holds(runs))
        every.append(runs[hits])
        at.append(hits)
    return np.concatenate(every), np.concatenate(at)


def _count(table):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                runs, _ = _held(split_words(texts, at_marks=True), table.value)
                names, n = np.unique(runs, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(n)], ["run", "n"])

    return count


def _digests(found) -> np.ndarray:
    """A hash of each text's words in their order."""
    place = np.arange(len(found.hashes)) - np.repeat(found.first[:-1], np.diff(found.first))
    sums = np.zeros(len(found.hashes) + 1, np.uint64)
    np.cumsum(mix(found.hashes + mix(place.astype(np.uint64))), out=sums[1:])
    return sums[found.first[1:]] - sums[found.first[:-1]]


def _names(digests: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """One hash for a passage; should two share it, both are aligned with what either needs."""
    return mix(mix(digests) + parts.astype(np.uint64))


def _hits(table, overlap: int):
    """(passage, run) of the seeds; passage k has the words from k * ``PASSAGE_WORDS`` on, and ``overlap`` of the next."""

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                found = split_words(texts, at_marks=True)
                runs, at = _held(found, table.value)
                text = np.searchsorted(found.first, at, "right") - 1
                place = at - found.first[text]
                last = place // PASSAGE_WORDS
                copies = last - np.maximum(0, (place - overlap) // PASSAGE_WORDS) + 1
                row = np.repeat(np.arange(len(at)), copies)
                back = np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
                names = _names(_digests(found)[text[row]], last[row] - back)
                columns = [pa.array(names.view(np.int64)), pa.array(runs[row].view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "run"])

    return hits


def _passages(table, overlap: int):
    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        for batch in batches:
            for at, texts in chunks(batch.column(1)):
                found = split_words(texts, at_marks=True)
                parts = -(-np.diff(found.first) // PASSAGE_WORDS)
                text = np.repeat(np.arange(len(parts)), parts)
                part = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
                names = _names(_digests(found)[text], part)
                wanted = np.flatnonzero(table.value.holds(names))
                text, starts = text[wanted], part[wanted] * PASSAGE_WORDS
                first = found.first[text] + starts
                last = np.minimum(first + PASSAGE_WORDS + overlap, found.first[text + 1])
                words = [found.hashes[a:b].view(np.int64) for a, b in zip(first, last, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at + text, pa.int64())),
                        pa.array(names[wanted].view(np.int64)),
                        pa.array(starts, pa.int64()),
                        pa.array(words, kind),
                    ],
                    ["doc_id", "key", "start", "passage"],
                )

    return passages


def _needed(n: F.Column, least: float) -> F.Column:
    """How many features of an item of ``n`` words any alignment of that score matches."""
    share = F.when(n < PART_WORDS, 1.0).otherwise(least)
    return F.greatest(F.lit(1), F.ceil(MATCH * share * n - 1e-9).cast("int") - 1)


def align(item: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best local score of ``item`` in each row of ``passages``, and where it ends.

    Row ``i`` of the table is the item's word ``i`` against all places of all passages; gaps
    along a passage are a running maximum.
    """
    count, width = passages.shape
    slope = -GAP * np.arange(width + 1, dtype=np.int32)
    above = np.zeros((count, width + 1), np.int32)
    best = np.zeros(count, np.int32)
    end = np.zeros(count, np.int64)
    for word in item:
        row = np.maximum(above + GAP, 0)
        np.maximum(row[:, 1:], above[:, :-1] + np.where(passages == word, MATCH, MISMATCH), out=row[:, 1:])
        row = np.maximum.accumulate(row + slope, axis=1) - slope
        at = row.argmax(axis=1)
        top = row[np.arange(count), at]
        end = np.where(top > best, at, end)
        best = np.maximum(best, top)
        above = row
    return best, end


def _padded(lists: list[np.ndarray]) -> np.ndarray:
    """One row each; the fill is a hash that no word is likely to have."""
    out = np.full((len(lists), max(map(len, lists))), -1, np.int64)
    for row, values in zip(out, lists, strict=True):
        row[: len(values)] = values
    return out


def _score(least: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "item_id", "score", "first_word", "last_word"]
        for batch in batches:
            doc, item, starts, passages, words = (batch.column(i) for i in range(5))
            # An id may stand for several texts, so the words are part of the key.
            groups: dict[tuple, list[int]] = {}
            for i, name in enumerate(item.to_pylist()):
                groups.setdefault((name, words[i].values.to_numpy().tobytes()), []).append(i)
            out = []
            for (name, key), rows in groups.items():
                own = np.frombuffer(key, np.int64)
                for k in range(0, len(rows), 64):
                    some = rows[k : k + 64]
                    texts = [passages[i].values.to_numpy() for i in some]
                    best, end = align(own, _padded(texts))
                    for i, text, top, last in zip(some, texts, best, end, strict=True):
                        share = float(top) / (MATCH * len(own))
                        if share >= (least if len(own) >= PART_WORDS else 1.0):
                            # The same alignment read backwards ends where it starts.
                            _, back = align(own[::-1], text[None, :last][:, ::-1])
                            start = starts[i].as_py()
                            out.append((doc[i].as_py(), name, share, start + int(last - back[0]), start + int(last) - 1))
            columns = zip(*out, strict=True) if out else [[]] * 5
            kinds = [doc.type, item.type, pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names)

    return score


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, least_words: int = 1) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word) of documents that hold a test item.

    ``score`` is the alignment's share of a whole copy's score, at least ``least``; the words
    count from 0 within the document. A pair is returned once, with its best place (ties:
    the first). The same corpus and benchmark give the same pairs in any partitioning.

    Items of one or two words count as held only where they stand whole; callers whose benchmark
    has such items by accident leave them out by ``least_words``. Null and empty texts match
    nothing, nor do items of fewer than ``least_words`` words, without words or with a null id. Rows that repeat a document or an item give one pair with the best score; rows
    without a document id are one document with a null id. Only doc_id and text, and item_id
    and text, are read. An empty table on either side gives no pairs.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text")
    asked = benchmark.where("item_id is not null").select("item_id", "text")
    item_kind, doc_kind = dict(asked.dtypes)["item_id"], dict(texts.dtypes)["doc_id"]
    kinds = f"item_id {item_kind}, words array<long>, runs array<long>"
    numbered = asked.mapInArrow(_items, kinds).withColumn("item", F.monotonically_increasing_id())
    items = settle(numbered.where(F.size("words") >= max(1, least_words)), "items")
    longest = items.agg(F.max(F.size("words"))).head()[0]
    found = f"doc_id {doc_kind}, item_id {item_kind}, score double, first_word long, last_word long"
    if longest is None:
        return spark.createDataFrame([], found)

    # A feature that an item has several times counts as often.
    each = items.select("item", F.size("words").alias("words"), F.explode("runs").alias("run"))
    runs = settle(each.groupBy("item", "words", "run").agg(F.count("*").alias("times")), "runs")
    table = spark.sparkContext.broadcast(BitTable.of(runs.select("run")))
    counts = texts.select("text").mapInArrow(_count(table), "run long, n long").groupBy("run").agg(F.sum("n").alias("n"))
    counted = runs.join(counts, "run", "left").withColumn("needed", _needed(F.col("words"), least))
    frequent = Window.partitionBy("item").orderBy(F.coalesce("n", F.lit(0)).desc(), "run").rowsBetween(Window.unboundedPreceding, 0)
    counted = counted.withColumn("left_out", F.sum("times").over(frequent))
    counted = counted.withColumn("seen", F.ceil(F.col("needed") * SEEN))
    rare = counted.where(F.col("left_out") > F.col("needed") - F.col("seen"))
    seeds = settle(rare.select("item", "run", "times", "seen"), "seeds")

    # Words that an alignment adds cost GAP each, and so many at most leave it good enough.
    overlap = longest + math.ceil(MATCH * longest * (1 - least))
    chosen = spark.sparkContext.broadcast(BitTable.of(seeds.select("run")))
    hits = texts.select("text").mapInArrow(_hits(chosen, overlap), "key long, run long").distinct()
    held = hits.join(seeds, "run").groupBy("key", "item").agg(F.sum("times").alias("times"), F.first("seen").alias("seen"))
    pairs = settle(held.where("times >= seen").select("key", "item"), "pairs")

    wanted = spark.sparkContext.broadcast(BitTable.of(pairs.select("key")))
    cut = texts.mapInArrow(_passages(wanted, overlap), f"doc_id {doc_kind}, key long, start long, passage array<long>")
    joined = cut.join(pairs, "key").join(items.drop("runs"), "item")
    rows = joined.select("doc_id", "item_id", "start", "passage", "words")
    scored = rows.mapInArrow(_score(least), found)
    best = F.max_by(F.struct("score", "first_word", "last_word"), F.struct("score", -F.col("first_word"), -F.col("last_word")))
    return scored.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, least_words: int = 1) -> DataFrame:
    """``docs`` that hold no test item, all columns; rows with a null id stay."""
    return drop_ids(docs, contaminated(docs, benchmark, least, least_words).select("doc_id").distinct())
