"""Contaminated documents against alignment of every item with every whole document."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from partwise.llm import decontaminate


def word_list(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow_score(item, doc):
    """Smith-Waterman by the book."""
    best = 0
    above = [0] * (len(doc) + 1)
    for x in item:
        row = [0] * (len(doc) + 1)
        for j, y in enumerate(doc, 1):
            hit = above[j - 1] + (decontaminate.MATCH if x == y else decontaminate.MISMATCH)
            row[j] = max(0, hit, above[j] + decontaminate.GAP, row[j - 1] + decontaminate.GAP)
        best = max(best, *row)
        above = row
    return best / (decontaminate.MATCH * len(item)) if item else 0.0


def made(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["the"] * 60 + ["of"] * 40

    def text(n):
        return [r.choice(words) for _ in range(n)]

    items = [(i, " ".join(text(r.randint(20, 60)))) for i in range(15)]
    docs = []
    for d in range(60):
        own = text(r.randint(0, 700))
        if d % 3 == 0:
            copy = r.choice(items)[1].split()
            for _ in range(int(len(copy) * r.choice([0, 0.05, 0.15, 0.3]))):
                k = r.randrange(len(copy))
                copy[k : k + 1] = r.choice([[], [r.choice(words)], [copy[k], r.choice(words)]])
                copy = copy or ["w"]
            at = r.randint(0, len(own))
            own[at:at] = copy
        docs.append((d, r.choice([" ", ", ", "\n"]).join(w.upper() if r.random() < 0.1 else w for w in own)))
    return items, docs


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_all_alignments(spark, seed):
    items, rows = made(seed)
    docs = spark.createDataFrame([(*row, 1, "s") for row in rows], "doc_id long, text string, run int, score string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs.repartition(3), benchmark).collect()}
    want = {}
    for d, text in rows:
        doc = word_list(text)
        for i, item in items:
            score = slow_score(word_list(item), doc) if doc else 0
            if score >= decontaminate.LEAST:
                want[d, i] = score
    assert found.keys() == want.keys() and len(want) >= 15
    for key, row in found.items():
        assert row.score == pytest.approx(want[key])
        place = word_list(dict(rows)[key[0]])[row.first_word : row.last_word + 1]
        assert slow_score(word_list(dict(items)[key[1]]), place) == pytest.approx(row.score)


def same_as_brute_force(spark, items, rows, partitions=3):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(docs, benchmark).collect()}
    scores = {(d, i): slow_score(word_list(item), word_list(text)) for d, text in rows for i, item in items}
    assert found == pytest.approx({pair: score for pair, score in scores.items() if score >= decontaminate.LEAST})
    return found


def test_edited_copies_beside_an_exact_one(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    items, rows = [], []
    for i in range(12):
        item = r.sample(words, r.randint(12, 20))
        items.append((i, " ".join(item)))
        copies = [item, [w if k % 5 != 4 else r.choice(words) for k, w in enumerate(item)]]
        copies += [[w if r.random() < 0.75 else r.choice(words) for w in item] for _ in range(8)]
        for copy in copies:
            rows.append((len(rows), " ".join([*r.choices(words, k=r.randint(0, 60)), *copy, *r.choices(words, k=30)])))
    assert len(same_as_brute_force(spark, items, rows)) >= 90


def test_copies_without_three_words_in_a_row(spark):
    item = [f"w{i}" for i in range(17)]
    edits = [
        [w if k % 3 != 2 else "x" for k, w in enumerate(item)],
        [w for k, w in enumerate(item) if k % 3 != 2],
        [v for k, w in enumerate(item) for v in ([w, "x"] if k % 2 else [w])],
        [v for w in item for v in (w, "x")],
        [*item[:9], *["x"] * 8, *item[9:]],
        [w if k % 2 else "x" for k, w in enumerate(item)],
    ]
    # The copies also lie across the ends of passages.
    rows = [(1000 * k + at, " ".join([*["y"] * at, *edit, *["z"] * 300])) for k, edit in enumerate(edits) for at in (0, 240, 255, 500)]
    rows += [(10_000 + k, " ".join(item)) for k in range(5)]
    found = same_as_brute_force(spark, [(1, " ".join(item))], rows)
    assert len(found) == 5 * 4 + 5


def test_odd_rows(spark):
    item = " ".join(f"word{i}" for i in range(20))
    rows = [(1, f"x {item} y"), (1, f"x {item} y"), (None, item), (2, None), (3, ""), (4, "word1 word2 word3"), (5, f"{item} " * 300), (6, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, item), (7, item), (8, "a b"), (9, None), (None, item), (10, "")], "item_id long, text string")
    found = decontaminate.contaminated(docs, benchmark, least_words=3).collect()
    assert sorted(((r.doc_id, r.item_id, r.score) for r in found), key=repr) == [(1, 7, 1.0), (5, 7, 1.0), (None, 7, 1.0)]
    kept = decontaminate.drop_contaminated(docs, benchmark, least_words=3)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([None, 2, 3, 4, 6], key=repr)
    assert decontaminate.contaminated(docs.limit(0), benchmark).collect() == []
    assert decontaminate.contaminated(docs, benchmark.limit(0)).collect() == []


def test_short_items_count_whole(spark):
    rows = [(1, "a b"), (2, "x A, b y"), (3, "a x b"), (4, "b a"), (5, "a"), (6, "solo"), (7, "x " * 300 + "a b"), (8, "p q r"), (9, "p q x"), (10, "p x y"), (11, None)]
    items = [(1, "a b"), (2, "solo"), (3, "p q r"), (4, "?!"), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(docs, benchmark).collect()}
    scores = {(d, i): slow_score(word_list(item), word_list(text)) for d, text in rows if word_list(text) for i, item in items}
    lengths = {i: len(word_list(item)) for i, item in items}
    want = {(d, i): s for (d, i), s in scores.items() if lengths[i] and s >= (decontaminate.LEAST if lengths[i] > 2 else 1)}
    assert found == pytest.approx(want) and len(want) == 6


def test_an_item_id_with_two_texts(spark):
    texts = [" ".join(f"{letter}{i}" for i in range(16)) for letter in "ab"]
    rows = [(d, f"x {texts[d % 2]} y") for d in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    benchmark = spark.createDataFrame([(7, text) for text in texts], "item_id long, text string")
    found = decontaminate.contaminated(docs, benchmark).collect()
    assert sorted((r.doc_id, r.item_id, r.score) for r in found) == [(d, 7, 1.0) for d in range(6)]


def test_align_matches_the_slow_table():
    r = np.random.default_rng(0)
    for _ in range(30):
        item = r.integers(0, 6, r.integers(1, 12))
        passages = [r.integers(0, 6, r.integers(1, 30)) for _ in range(5)]
        best, end = decontaminate.align(item, decontaminate._padded(passages))
        for passage, top, last in zip(passages, best, end, strict=True):
            assert top / (2 * len(item)) == pytest.approx(slow_score(item.tolist(), passage.tolist()))
            assert last <= len(passage)


def test_counts_of_runs(spark):
    texts = pa.array(["a b c a b c", None, "a b"])
    runs, owner = decontaminate._inside(decontaminate.split_words(texts, at_marks=True), 3)
    assert (owner >= 0).sum() == 4 and len(np.unique(runs[owner >= 0])) == 3
