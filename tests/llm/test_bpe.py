"""The encoder against a reference encoder, and round trips."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from partwise.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
CONTENT = bpe.load_vocabulary(PATH)
OURS = bpe.Encoder(CONTENT, public_tokenizers.PATTERN)
THEIRS = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(CONTENT), special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    assert OURS.encode(text) == THEIRS.encode_ordinary(text)


@pytest.mark.parametrize("alphabet", ["abcdest", "=-_*#", " \t\n\r\x0b\x0c\x1c\x85  a1.", "é漢字😀'sll x"])
def test_hard_alphabets(alphabet):
    r = random.Random(1)
    for _ in range(2000):
        text = "".join(r.choice(alphabet) for _ in range(r.randint(0, 60)))
        assert OURS.encode(text) == THEIRS.encode_ordinary(text)


@pytest.mark.parametrize("piece", [b"a", b"ab", b"the", b"aab", bytes(range(97, 123))])
def test_long_pieces(piece):
    text = (piece * 4000)[:20_000].decode()
    assert OURS.encode(text) == THEIRS.encode_ordinary(text)


def test_all_tables_are_built():
    vocabulary = OURS.vocabulary
    assert len(vocabulary.halves) == len(vocabulary.ranks) - 256
    for rank, (left, right) in vocabulary.halves.items():
        assert vocabulary.tokens[left] + vocabulary.tokens[right] == vocabulary.tokens[rank]


def test_columns(spark):
    rows = [(1, "Hello world", 1), (1, "Hello world", 2), (None, None, 3), (2, "", 4), (3, "<|endoftext|> é" * 3000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids int")
    found = bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH, "_token_ids").collect()
    assert len(found) == len(rows)
    for row in found:
        assert row._token_ids == THEIRS.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == (row.text or "").encode()
    assert bpe.encode(docs.limit(0), PATH, public_tokenizers.PATTERN).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id long, token_ids array<int>")
    assert [bytes(r.decoded) for r in bpe.decode(nulls, PATH).collect()] == [b"", b""]
