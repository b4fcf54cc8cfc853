"""Periodic runs against brute force over all periods."""

from __future__ import annotations

import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from partwise.llm import runs
from partwise.llm.queries import QUERIES, with_planted_runs


def brute_runs(words, least, times):
    found = {}
    for p in range(len(words) // times, 0, -1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, times * p):
                found[i, j + p - i] = p  # smaller periods come later and replace larger ones
            i = j + 1
    return sorted((start, length, p) for (start, length), p in found.items())


def brute_collapse(words, found):
    gone = {i for start, length, p in found for i in range(start + p, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_text(r, letters):
    words, want = [], r.randint(0, 150)
    while len(words) < want:
        unit = [r.choice(letters) for _ in range(r.randint(1, 9))]
        words += unit * r.randint(1, 8)
    return words


@pytest.mark.parametrize(("least", "times"), [(24, 3), (2, 2), (5, 2), (10, 4), (30, 3)])
def test_random_texts(least, times):
    r = random.Random(least)
    for _ in range(60):
        texts = [random_text(r, range(r.randint(1, 4))) for _ in range(r.randint(1, 6))]
        words = np.array([w for text in texts for w in text], np.int64)
        got = runs.find_runs(words, np.array([len(t) for t in texts]), least, times)
        want = [(i, *run) for i, text in enumerate(texts) for run in brute_runs(text, least, times)]
        assert list(zip(*(column.tolist() for column in got), strict=True)) == want


def test_common_extensions():
    """Both directions of the grammar's extension against comparing symbol by symbol."""
    r = np.random.default_rng(1)
    for letters in (1, 2, 5):
        body = np.repeat(r.integers(0, letters, 200), r.integers(1, 5, 200))
        string = np.concatenate([[letters], body, [letters + 1]])
        grammar = runs.Grammar(string)
        a, b = r.integers(1, len(string) - 1, (2, 500))
        a, b = a[a != b], b[a != b]
        ahead, back = grammar.extend(a, b), grammar.extend(a, b, back=True)
        for i, j, end, start in zip(a, b, ahead, back, strict=True):
            n = next(n for n in range(len(string)) if string[i + n] != string[j + n])
            m = next(m for m in range(len(string)) if string[i - m - 1] != string[j - m - 1])
            assert (end, start) == (i + n, i - m)


def test_levels_shrink():
    grammar = runs.Grammar(np.random.default_rng(2).integers(0, 50, 20_000))
    assert len(grammar.levels) < 120
    assert sum(len(level.symbols) for level in grammar.levels) < 8 * 20_000


def test_odd_rows(spark):
    period = "a b c " * 12
    rows = [
        (1, period, 1, "x"),
        (1, period, 2, "y"),
        (None, None, 3, None),
        (2, "", 4, ""),
        (3, " \t\n ", 5, ""),
        (4, "A a b é " * 9, 6, ""),
        (5, "one two", 7, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int, collapsed string")
    found = {row.runs: row for row in runs.collapse_runs(docs).collect()}
    assert len(found) == len(rows)
    for row in found.values():
        words = [w.decode() for w in (row.text or "").encode().split()]
        want = brute_runs(words, 24, 3)
        assert [tuple(x) for x in row._runs] == want
        assert (row.n_words, row._collapsed) == (len(words), brute_collapse(words, want))
    assert found[1]._collapsed == "a b c" and [tuple(x) for x in found[4]._runs] == []
    assert runs.collapse_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        runs.collapse_runs(docs, times=1)


def test_long_texts_in_time():
    start = time.perf_counter()
    one_word = runs.find_runs(np.zeros(300_000, np.int64), np.array([300_000]), 24, 3)
    assert [x.tolist() for x in one_word] == [[0], [0], [300_000], [1]]
    unit = np.random.default_rng(3).integers(0, 1000, 40_000)
    long_period = runs.find_runs(np.tile(unit, 4), np.array([160_000]), 24, 3)
    assert [x.tolist() for x in long_period] == [[0], [0], [160_000], [40_000]]
    assert time.perf_counter() - start < 60


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query(spark, tmp_path):
    """The registered query on a small table, against brute force."""
    import hashlib

    r = random.Random(5)
    docs = [(i, " \t".join(random_text(r, ["a", "b", "Ä", "dd"]))) for i in range(120)]
    docs += [(i, " ".join(str(r.randrange(1000)) for _ in range(r.randint(1, 300)))) for i in range(120, 300)]
    docs += [(300, None), (301, ""), (None, "a " * 40), (7, "again " * 30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    texts = with_planted_runs(frame).where("doc_id between 120 and 299").collect()
    for row in texts:
        assert row.text.split() == planted(row.doc_id, docs[row.doc_id][1].split())
    want = []
    for doc_id, text in docs:
        words = (text or "").split()
        words = planted(doc_id, words) if doc_id is not None else words
        found = brute_runs(words, 24, 3)
        top = max(found, key=lambda run: (run[1] / run[2], -run[0], -run[2]), default=None)
        spans = "".join(f"{s},{n},{p}\n" for s, n, p in sorted(found, key=lambda run: (run[0], run[2])))
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (spans, brute_collapse(words, found))]
        want.append((doc_id, len(found), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None, *digests))
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = QUERIES["op12_periodic_runs"](spark, str(tmp_path)).select(*columns)
    assert [kind for name, kind in got.dtypes if name in columns[1:6]] == ["bigint"] * 5
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert got.where(F.col("n_runs") > 0).count() > 40
