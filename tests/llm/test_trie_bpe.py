"""The trie encoder against the tokenizers library, and round trips."""

from __future__ import annotations

import json
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from partwise.llm import trie_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
CONTENT = trie_bpe.load_file(PATH)
OURS = trie_bpe.Encoder(CONTENT)
DECODER = trie_bpe.Decoder(CONTENT)
THEIRS = tokenizers.Tokenizer.from_file(PATH)


def encode(texts):
    ids, bounds = OURS.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def expected(texts):
    return [THEIRS.encode(text, add_special_tokens=False).ids for text in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_any_texts(texts):
    assert encode(texts) == expected(texts)


@pytest.mark.parametrize("alphabet", ["abcdest", "=-_*#", " \t\n\r\x0b\x0c\x1c\x85  a1.", "é漢字😀'sll x"])
def test_hard_alphabets(alphabet):
    r = random.Random(1)
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(2000)]
    assert encode(texts) == expected(texts)


def test_added_tokens_are_cut_out_first():
    r = random.Random(2)
    parts = [" ", "<|endoftext|>", "the", "<|endof", "\0 ", "\0", "|>"]
    texts = ["".join(r.choice(parts) for _ in range(8)) for _ in range(500)]
    assert encode(texts) == expected(texts)


@pytest.mark.parametrize("piece", ["a", "ab", "the", "aab", "abcdefghijklmnopqrstuvwxyz", "é"])
def test_long_words(piece):
    text = (piece * 8000)[:20_000]
    assert encode([text, text[:-1], text + "b"]) == expected([text, text[:-1], text + "b"])


def test_every_pair_of_neighbours_is_what_the_merges_leave():
    """Whether a token may follow another, against merging their bytes."""
    r = random.Random(3)
    tokenizer = OURS.tokenizer
    rank = {pair: i for i, pair in enumerate(tokenizer.halves) if pair}
    for _ in range(3000):
        pair = [r.randrange(len(tokenizer.tokens)) for _ in range(2)]
        parts = list(tokenizer.tokens[pair[0]] + tokenizer.tokens[pair[1]])  # single bytes are tokens 0 to 255
        while True:
            ranks = [rank.get(two, len(rank) + 256) for two in zip(parts, parts[1:], strict=False)]
            if not ranks or min(ranks) == len(rank) + 256:
                break
            at = ranks.index(min(ranks))
            parts[at : at + 2] = [min(ranks)]
        assert tokenizer.may_follow(*pair) == (parts == pair)


def test_decoding_of_broken_characters():
    ids = [THEIRS.encode("é漢", add_special_tokens=False).ids, [], THEIRS.encode("é漢", add_special_tokens=False).ids[:1]]
    assert DECODER.decode(pa.array(ids, pa.list_(pa.int32()))).to_pylist() == [THEIRS.decode(x, skip_special_tokens=False) for x in ids]
    halves = [[THEIRS.token_to_id("Ã")], [THEIRS.token_to_id("©")]]  # together they would be one letter
    assert DECODER.decode(pa.array(halves, pa.list_(pa.int32()))).to_pylist() == ["�", "�"]
    with pytest.raises(ValueError):
        DECODER.decode(pa.array([[50257]], pa.list_(pa.int32())))


def test_other_files_are_refused():
    file = json.loads(CONTENT)
    for change in ({"normalizer": {"type": "Lowercase"}}, {"model": file["model"] | {"byte_fallback": True}}):
        with pytest.raises(ValueError):
            trie_bpe.Tokenizer(json.dumps(file | change).encode())


def test_columns(spark):
    rows = [(1, "Hello world", 1), (1, "Hello world", 2), (None, None, 3), (2, "", 4), (3, "<|endoftext|> é" * 3000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids int")
    found = trie_bpe.decode(trie_bpe.encode(docs, PATH), PATH, "_token_ids").collect()
    assert len(found) == len(rows)
    for row in found:
        assert row._token_ids == THEIRS.encode(row.text or "", add_special_tokens=False).ids
        assert row.decoded == (row.text or "")
    assert trie_bpe.encode(docs.limit(0), PATH).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id long, token_ids array<int>")
    assert [row.decoded for row in trie_bpe.decode(nulls, PATH).collect()] == ["", ""]


def test_many_batches(spark, monkeypatch):
    """Texts longer than a batch and batches that end anywhere give what each text gives alone."""
    texts = [f"word{i % 7} " * (i % 40) for i in range(300)]
    ids = [row.token_ids for row in trie_bpe.encode(spark.createDataFrame([(t,) for t in texts], "text string"), PATH).collect()]
    assert ids == expected(texts)
    monkeypatch.setattr(trie_bpe, "REMEMBERED_PAIRS", 3)
    assert encode(texts[:50]) == expected(texts[:50])
