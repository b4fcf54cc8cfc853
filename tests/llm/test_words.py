"""Word hashes against the words themselves."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from partwise.llm import minhash
from partwise.llm.words import split_words


def thue_morse(length, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(length))


def test_equal_hashes_for_equal_words_only():
    r = random.Random(1)
    words = ["".join(r.choice("ab") for _ in range(r.randint(1, 30))) for _ in range(20_000)]
    words += [thue_morse(n, pair) for n in (64, 1024, 1025, 2048, 4096) for pair in ("ab", "ba")]
    words += ["a" * n for n in range(1, 1100)] + ["a\0", "a\0\0", "\0", "é" * 700]
    found = split_words(pa.array([" ".join(words)]))
    names = [found.data[a:b].tobytes() for a, b in zip(found.starts, found.ends, strict=True)]
    assert names == [word.encode() for word in words]
    assert len({*zip(names, found.hashes.tolist(), strict=True)}) == len(set(names)) == len(np.unique(found.hashes))


def test_hashes_do_not_follow_the_place():
    alone = split_words(pa.array(["Word"])).hashes
    among = split_words(pa.array(["x", None, "a word", "", "wOrd" + " z" * 9])).hashes
    assert among[2] == among[3] == alone[0]


def test_complement_words_are_no_copies(spark):
    """Two words that share a polynomial hash modulo a power of two are different documents."""
    rows = [(1, thue_morse(2048, "ab")), (2, thue_morse(2048, "ba")), (3, thue_morse(2048, "ab"))]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2, percent=80)
    assert {r.doc_id: r.component_id for r in found.collect()} == {1: 1, 2: 2, 3: 1}
