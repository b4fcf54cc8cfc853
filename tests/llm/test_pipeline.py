"""The pipeline against plain versions of its stages, and the registered queries."""

from __future__ import annotations

from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

import __spark_entry__ as entry_points
import corpus_pipeline
from partwise.llm import bpe, decontaminate, lines, quality, words
from partwise.llm.oracle import ORACLE
from partwise.llm.queries import QUERIES, VOCABULARY

from .test_lines import brute as brute_lines
from .test_minhash import brute as brute_groups

SF_DIR = "/root/testdata/sf0.001"


def plain_pipeline(spark, rows):
    """{doc_id: text} after the first four stages, each by comparing everything with everything."""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality.train(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    kept = [(d, t) for d, t in rows if model.scores(quality.statistics(pa.array([t], pa.string())))[0] >= 0.7]

    gone = brute_lines(kept, lines.MIN_WORDS, lines.PERCENT)
    left = []
    for d, t in kept:
        if d not in gone:
            left.append((d, t))
        else:
            text = "\n".join(line for i, line in enumerate(t.split("\n")) if i not in gone[d])
            left += [(d, text)] if text.strip() else []

    groups = brute_groups(left, 5, 80)
    left = [(d, t) for d, t in left if groups[d] == d]

    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    split = [words.split_words(pa.array([i.text]), at_marks=True).hashes.view(np.int64) for i in items]
    clean = []
    for d, t in left:
        doc = words.split_words(pa.array([t], pa.string()), at_marks=True).hashes.view(np.int64)
        scores = [decontaminate.align(item, doc[None, :])[0][0] / (decontaminate.MATCH * len(item)) if len(doc) else 0 for item in split]
        if max(scores) < decontaminate.LEAST:
            clean.append((d, t))
    return dict(clean)


def test_run_is_the_plain_pipeline(spark):
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    want = plain_pipeline(spark, rows)
    assert {d: r.text for d, r in found.items()} == want
    assert 100 < len(want) < len(rows)
    ranks = bpe.read_ranks(bpe.load_vocabulary(VOCABULARY))
    theirs = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in found.values():
        assert r.token_ids == theirs.encode_ordinary(r.text) and r.n_tokens == len(r.token_ids) and r.round_trip
        assert r.n_chars == len(r.text)


@pytest.mark.parametrize("stage", range(5))
def test_stages_keep_odd_rows_and_columns(spark, stage):
    name, function = corpus_pipeline.STAGES[stage]
    normal = "A line of several plain words that stands alone in here.\nAnd one more line to make it longer, of other words."
    rows = [(1, normal, "x", None), (1, normal, "x", None), (None, None, None, 1), (2, "", "", 2), (3, None, "k", 3), (4, "w " * 50_000, "n", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, n_chars int")
    found = function(spark, docs, SF_DIR)
    assert found.columns[: len(docs.columns)] == docs.columns
    if stage < 4:
        assert found.columns == docs.columns and found.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    ids = [r.doc_id for r in found.collect()]
    if name != "quality_filter":  # whether odd texts are good is for the model to say
        assert {None, 1, 2, 3, 4} == set(ids)
        assert ids.count(1) == (1 if name == "near_dedup" else 2)
    assert function(spark, docs.limit(0), SF_DIR).collect() == []


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    rows = found.collect()
    assert rows or name == "op4_decontaminate"
    if name in ORACLE:
        columns = sorted(found.columns)
        twin = duck.sql(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()
        assert sorted(repr(tuple(r[c] for c in columns)) for r in rows) == sorted(map(repr, twin))


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
