"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from whole texts, with numpy over the bytes of an Arrow batch. Training uses
a bounded sample of labelled documents (``SAMPLE``, by a hash of the id), whose statistics
alone reach the driver. The trees have equal depth and lie in flat arrays, so that all
documents of a batch walk one level of all trees in a few numpy operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partwise.llm.common import free_name
from partwise.llm.words import chunks, split_words, text_bytes

#: Labelled documents to learn from, at most: about 2 MB of statistics on the driver.
SAMPLE = 8192
TREES, DEPTH, BINS, RATE, LEAST_IN_LEAF, RIDGE = 120, 4, 64, 0.1, 20, 1.0

_CLASSES = 9
_BYTE_CLASS = np.full(256, 6, np.int64)  # other ASCII marks
_BYTE_CLASS[0x80:] = 0
_BYTE_CLASS[[ord(c) for c in "abcdefghijklmnopqrstuvwxyz"]] = 1
_BYTE_CLASS[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 2
_BYTE_CLASS[[ord(c) for c in "0123456789"]] = 3
_BYTE_CLASS[[ord(c) for c in ".,;:'\"-()"]] = 4
_BYTE_CLASS[[ord(c) for c in " \t\v\f\r"]] = 5
_BYTE_CLASS[ord("\n")] = 7
_BYTE_CLASS[[ord(c) for c in "!?"]] = 8

STATISTICS = [
    "log_bytes", "log_words",
    *(f"share_of_{name}" for name in ("wide", "lower", "upper", "digit", "stop", "blank", "mark", "line", "cry")),
    "mean_word", "spread_of_words", "longest_word", "distinct_words", "top_word", "repeats", "words_with_mark", "words_a_line",
]


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum over each bounds[i]:bounds[i + 1]."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` for each text; an empty or null text has zeros."""
    words = split_words(texts)
    raw, starts = text_bytes(texts)
    n = len(texts)
    size = np.diff(starts)
    owner = np.repeat(np.arange(n) * _CLASSES, size)
    counts = np.bincount(owner + _BYTE_CLASS[raw], minlength=n * _CLASSES).reshape(n, _CLASSES)
    n_words = np.diff(words.first)
    some_words = np.maximum(n_words, 1)
    lengths = (words.ends - words.starts).astype(float)
    mean = _sums(lengths, words.first) / some_words
    spread = np.sqrt(np.maximum(0, _sums(lengths**2, words.first) / some_words - mean**2))
    marked = np.isin(_BYTE_CLASS[raw[words.ends - 1]], (6, 8)) if len(raw) else np.zeros(0)
    again = np.zeros(len(words.hashes))
    again[1:] = words.hashes[1:] == words.hashes[:-1]
    again[words.first[:-1][n_words > 0]] = 0  # a text's first word has none before it
    longest, distinct, top = np.zeros((3, n))
    for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
        if b > a:
            _, times = np.unique(words.hashes[a:b], return_counts=True)
            longest[i], distinct[i], top[i] = lengths[a:b].max(), len(times), times.max()
    share = counts / np.maximum(size, 1)[:, None]
    return np.column_stack(
        [
            np.log1p(size),
            np.log1p(n_words),
            share,
            mean,
            spread,
            np.log1p(longest),
            distinct / some_words,
            top / some_words,
            _sums(again, words.first) / some_words,
            _sums(marked, words.first) / some_words,
            np.log1p(n_words / (counts[:, 7] + 1)),
        ]
    )


class Model(NamedTuple):
    """Trees of equal depth: inner node k of a tree has children 2 k + 1 and 2 k + 2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # go right if greater
    leaf: np.ndarray  # trees x leaves

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row of statistics."""
        trees, inner = self.feature.shape
        tree = np.arange(trees)
        node = np.zeros((len(rows), trees), np.int64)
        at = np.arange(len(rows))[:, None]
        for _ in range((inner + 1).bit_length() - 1):
            right = rows[at, self.feature[tree, node]] > self.threshold[tree, node]
            node = 2 * node + 1 + right
        margin = self.base + self.leaf[tree, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-margin))


def fit(rows: np.ndarray, labels: np.ndarray) -> Model:
    """Boost trees on binned statistics by the logistic loss.

    Without rows, or with a single label, there are no splits: the score is the smoothed
    share of label 1, (ones + 1) / (rows + 2).
    """
    n, width = rows.shape
    rate = (labels.sum() + 1) / (n + 2)
    base = float(np.log(rate / (1 - rate)))
    inner = (1 << DEPTH) - 1
    feature = np.zeros((TREES, inner), np.int64)
    threshold = np.full((TREES, inner), np.inf)
    leaf = np.zeros((TREES, inner + 1))
    model = Model(base, feature, threshold, leaf)
    if not 0 < labels.sum() < n:
        return model
    cuts = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    bins = np.column_stack([np.searchsorted(c, rows[:, j], "left") for j, c in enumerate(cuts)])
    offsets = np.arange(width) * BINS
    margin = np.full(n, base)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        slope, weight = labels - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, count = (1 << level) - 1, 1 << level
            cell = ((node - first)[:, None] * (width * BINS) + offsets + bins).ravel()
            shape = count, width, BINS
            total = count * width * BINS
            g, h, c = (
                np.bincount(cell, np.repeat(v, width), total).reshape(shape).cumsum(axis=2)
                for v in (slope, weight, np.ones(n))
            )
            whole = [v[:, :, -1:] for v in (g, h, c)]
            gain = g**2 / (h + RIDGE) + (whole[0] - g) ** 2 / (whole[1] - h + RIDGE) - whole[0] ** 2 / (whole[1] + RIDGE)
            gain[(c < LEAST_IN_LEAF) | (whole[2] - c < LEAST_IN_LEAF)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            for k in range(count):
                j, b = divmod(int(best[k]), BINS)
                if gain[k, j, b] > 1e-6 and b < len(cuts[j]):
                    feature[t, first + k], threshold[t, first + k] = j, cuts[j][b]
            node = 2 * node + 1 + (rows[np.arange(n), feature[t, node]] > threshold[t, node])
        place = node - inner
        step = np.bincount(place, slope, inner + 1) / (np.bincount(place, weight, inner + 1) + RIDGE)
        leaf[t] = RATE * step
        margin += leaf[t][place]
    return model


def held_out(doc_id: Column) -> Column:
    """Whether the id belongs to the fourth of documents that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, texts in chunks(batch.column(1)):
            rows = pa.array(list(statistics(texts)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), rows], ["doc_id", "row"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents that are not held out.

    Only ``doc_id`` and ``quality`` of ``labels`` and ``doc_id`` and ``text`` of ``docs`` are
    read. An id with several labels has their majority (a tie: 1); rows with a null id or
    label are left out, as are labels without a document. Of a repeated document the text
    with the smallest hash counts. No usable label: every score is 0.5.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    voted = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    order = [F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id")]
    chosen = voted.orderBy(*order).limit(sample).select(F.col("doc_id").alias("labelled"), "label")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen.select("labelled")), F.col("doc_id") == F.col("labelled"), "left_semi")
    texts = texts.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    kind = dict(docs.dtypes)["doc_id"]
    measured = texts.mapInArrow(_measure, f"doc_id {kind}, row array<double>")
    rows = measured.join(chosen, F.col("doc_id") == F.col("labelled")).select("doc_id", "row", "label").collect()
    rows.sort(key=lambda r: r.doc_id)
    table = np.array([r.row for r in rows]).reshape(len(rows), len(STATISTICS))
    return fit(table, np.array([r.label for r in rows], float))


def score(docs: DataFrame, model: Model, to: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 in a new column (underscores before it if taken).

    Only the text is looked at. Null and empty texts are scored from their all-zero
    statistics; repeated rows get equal scores; an empty table stays empty.
    """
    name = free_name(docs, to)
    at = docs.columns.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in chunks(batch.column(at)):
                part = batch.slice(begin, len(texts))
                scores = pa.array(model.scores(statistics(texts)))
                yield pa.RecordBatch.from_arrays([*part.columns, scores], [*part.schema.names, name])

    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def drop_low_quality(docs: DataFrame, labels: DataFrame, least: float = 0.7, train_on: DataFrame | None = None) -> DataFrame:
    """``docs`` whose score is ``least`` or more, with their columns as they are."""
    name = free_name(docs, "score")
    return score(docs, train(train_on if train_on is not None else docs, labels), name).where(F.col(name) >= least).drop(name)
