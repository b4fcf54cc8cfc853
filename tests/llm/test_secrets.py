"""The secret scan against plain regular expressions over every text."""

from __future__ import annotations

import random
import re

import pytest

from partwise.llm import secrets
from partwise.llm.secrets import Rule, trigram_query

# The base rules as they are given, before the lengths went into two of the patterns.
GIVEN = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}


def brute(text):
    found = []
    for number, rule in enumerate([*secrets.BASE, *secrets.MORE]):
        pattern, group, least = GIVEN.get(rule.kind, (rule.pattern, rule.group, rule.least))
        for m in re.finditer(pattern, text or "", re.ASCII):
            if len(m[group]) >= least:
                found.append((m.start(), number, m.end()))
    return sorted(found)


def made(seed):
    r = random.Random(seed)
    pieces = [
        "password=", "PassWd: ", "secret", "token", "api_key", "apikey=", "API_KEY : ", "=", ":", '"', "'", " ", "  ", "abc", "abcdef", "x1/+_.=-",
        "AKIA", "AKIAAKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "deadbeef", "é", "😀", "\n", ";", "ghp_" + "a" * 36, "xoxb-1234567890-x",
        "-----BEGIN RSA PRIVATE KEY-----", "Kelvin\u212aey", "\u017fecret=abcdefg", "token=token:abcdefgh", "password=ab:token=abcdef",
    ]
    return ["".join(r.choice(pieces) for _ in range(r.randint(0, 25))) for _ in range(400)]


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_plain_expressions(spark, seed):
    texts = [*made(seed), None, "", "password=" + "a" * 100_000, "deadbeef" * 5_000]
    rows = [(i, t, "r") for i, t in enumerate(texts)] + [(None, "AKIA" + "Z" * 16, "r"), (3, texts[3], "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rules string").repartition(4)
    found = secrets.find_secrets(docs).collect()
    got = sorted(((r.doc_id, [(s.start, s.kind, s.end) for s in r.found]) for r in found), key=repr)
    assert got == sorted(((d, brute(t)) for d, t, _ in rows), key=repr)
    assert sum(len(r.found) for r in found) > 300


def test_empty_table(spark):
    assert secrets.find_secrets(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_queries_follow_from_the_expressions():
    one = [[frozenset({"aki", "kia"})]]
    assert trigram_query(r"AKIA[A-Z0-9]{16,}") == one
    assert trigram_query(r"[0-9a-f]{24,}") == trigram_query(r"ab|cde") == trigram_query("(abc)?") == []
    (choices,) = trigram_query(secrets.BASE[0].pattern)
    assert {frozenset({"api", "pik", "ike", "key"}), frozenset({"api", "pi_", "i_k", "_ke", "key"})} < set(choices)
    assert trigram_query("abc.*def") == [[frozenset({"abc"})], [frozenset({"def"})]]
    assert trigram_query("a(b|c)cd") == [[frozenset({"abc", "bcd"}), frozenset({"acc", "ccd"})]]


def test_every_match_satisfies_its_query():
    r = random.Random(3)
    for rule in [*secrets.BASE, *secrets.MORE, Rule("x", "fo+bar(baz|qux)?[ab]z")]:
        query = trigram_query(rule.pattern)
        for text in [*made(5), "foobaraz fooobarquxbz"]:
            for m in re.finditer(rule.pattern, text, re.ASCII):
                low = m[0].lower()
                held = {low[i : i + 3] for i in range(len(low) - 2)}
                assert all(any(clause <= held for clause in part) for part in query), (rule, m[0])
    assert r


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = secrets.find_secrets(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_very_many_matches_in_one_text(spark):
    """100 000 matches in a text take time in proportion, and every one has its place."""
    import time

    key = "AKIA" + "Z" * 16
    text = "".join(f"é{key} " if i % 3 else f"AKIA{i % 10} " for i in range(100_000))
    docs = spark.createDataFrame([(1, text), (2, text[:2_000])], "doc_id long, text string")
    start = time.perf_counter()
    rows = {r.doc_id: [(s.start, s["end"]) for s in r.found if s.kind == 1] for r in secrets.find_secrets(docs).collect()}
    assert time.perf_counter() - start < 120
    for doc_id, whole in ((1, text), (2, text[:2_000])):
        assert rows[doc_id] == [m.span() for m in re.finditer("AKIA[A-Z0-9]+", whole) if len(m[0]) >= 20]
