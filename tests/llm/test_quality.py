"""The quality trees: held-out accuracy, statistics and edge cases."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from partwise.llm import quality

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet")


def test_held_out_accuracy(tables):
    docs, labels = tables
    model = quality.train(docs, labels)
    scored = quality.score(docs, model).join(labels, "doc_id").where(quality.held_out(F.col("doc_id")))
    rows = scored.select("score", "quality").collect()
    assert len(rows) > 50 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([(r.score >= 0.7) == (r.quality == 1) for r in rows]) >= 0.97
    assert not [r for r in rows if r.quality == 1 and r.score < 0.7]


def test_held_out_labels_are_never_learned_from(tables):
    docs, labels = tables
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(docs, labels), quality.train(docs, turned)
    assert all(np.array_equal(x, y) for x, y in zip(a, b, strict=True))


def test_held_out_is_the_crc(spark):
    rows = spark.range(-50, 50).select("id", quality.held_out(F.col("id")).alias("held")).collect()
    assert all(r.held == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


def test_odd_rows(spark, tables):
    _, labels = tables
    rows = [(1, "", 1.0), (1, "", 2.0), (None, None, 3.0), (2, "word " * 100_000, 4.0), (3, "%%%", 5.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    model = quality.train(*tables)
    found = quality.score(docs, model).collect()
    assert len(found) == 5 and all(0 <= r._score <= 1 for r in found)
    assert len({r._score for r in found if not r.text}) == 1
    assert quality.score(docs.limit(0), model).collect() == []
    kept = quality.drop_low_quality(docs, labels, least=0.0)
    assert kept.columns == docs.columns and kept.count() == 5


def test_without_usable_labels(spark, tables):
    docs, labels = tables
    for some in (labels.limit(0), labels.withColumn("quality", F.lit(None).cast("int"))):
        model = quality.train(docs, some)
        assert {r.score for r in quality.score(docs.limit(5), model).collect()} == {0.5}
    ones = quality.train(docs, labels.where("quality = 1"))
    assert all(r.score > 0.9 for r in quality.score(docs.limit(5), ones).collect())
    assert quality.train(docs.limit(0), labels).base == 0.0


def test_statistics_of_each_text_alone():
    texts = ["Ab, c!\nd d", None, "", "1 2\t3 é", "x" * 3000]
    together = quality.statistics(pa.array(texts))
    assert together.shape == (5, len(quality.STATISTICS)) and np.isfinite(together).all()
    for text, row in zip(texts, together, strict=True):
        assert np.allclose(quality.statistics(pa.array([text], pa.string()))[0], row)
    assert not together[1].any() and not together[2].any()
    named = dict(zip(quality.STATISTICS, together[0], strict=True))
    assert np.isclose(named["share_of_upper"], 1 / 10) and np.isclose(named["distinct_words"], 3 / 4)


def test_flat_trees_walk_like_nested_ones():
    r = np.random.default_rng(0)
    rows = r.normal(size=(600, 5))
    labels = ((rows[:, 0] > 0) ^ (rows[:, 1] > 0.5)).astype(float)
    model = quality.fit(rows, labels)

    def walk(tree, row):
        node = 0
        for _ in range(quality.DEPTH):
            node = 2 * node + 1 + (row[model.feature[tree, node]] > model.threshold[tree, node])
        return model.leaf[tree, node - model.feature.shape[1]]

    for row, score in zip(rows[:20], model.scores(rows[:20]), strict=True):
        margin = model.base + sum(walk(t, row) for t in range(quality.TREES))
        assert np.isclose(score, 1 / (1 + np.exp(-margin)))
    assert ((model.scores(rows) > 0.5) == labels).mean() > 0.95


def test_neighbours_do_not_show():
    """A text has the statistics that it has alone, whatever lies before it in the batch."""
    texts = ["one two", "two three four", "aaa", "aaa", "", "aaa aaa", None, "aaa", "four", "four four"]
    together = quality.statistics(pa.array(texts, pa.string()))
    alone = np.concatenate([quality.statistics(pa.array([text], pa.string())) for text in texts])
    assert np.array_equal(together, alone)


def test_repeats_against_a_plain_count():
    texts = ["a a b b b", "b", "b c c", "x y"]
    at = quality.STATISTICS.index("repeats")
    plain = [sum(v == w for v, w in zip(t.split(), t.split()[1:], strict=False)) / len(t.split()) for t in texts]
    assert quality.statistics(pa.array(texts))[:, at].tolist() == pytest.approx(plain)


def test_scores_do_not_follow_partitions(tables):
    docs, labels = tables
    model = quality.train(docs, labels)
    scores = [
        sorted((r.doc_id, r.score) for r in quality.score(cut.select("doc_id", "text"), model).collect())
        for cut in (docs.coalesce(1), docs.orderBy("text").repartition(7))
    ]
    assert scores[0] == scores[1]


def test_a_repeated_document_has_one_choice(spark, tables):
    """Two texts under an id: the same model whatever their order."""
    docs, labels = tables
    twice = docs.unionByName(docs.withColumn("text", F.concat(F.lit("other "), "text")))
    a = quality.train(twice.coalesce(1), labels)
    b = quality.train(twice.orderBy(F.desc("text")).repartition(5), labels)
    assert all(np.array_equal(x, y) for x, y in zip(a, b, strict=True))
