"""The prefix trie against one built in memory."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from partwise.llm import prefixes
from partwise.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_nodes(conversations):
    """The nodes for {conversation: [(role, text), …]}."""
    members, children = {}, {}
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[c] for c in below) if below else 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[c] for c in below)
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(conversations[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(node), parent, len(convs), len(children.get(node, [])), leaves[node], saved[node], digest))
    return sorted(out)


def brute_turns(rows):
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            found.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [(role, text) for _, _, role, text in sorted(turns)] for conv, turns in found.items()}


def random_conversations(r, n, longest):
    """Conversations that go on from the first turns of earlier ones."""
    made = [[]]
    for _ in range(n):
        start = r.choice(made)
        turns = start[: r.randint(0, len(start))]
        made.append(turns + [(r.choice("ua"), r.choice(["x", "é", "", "long " * 9])) for _ in range(r.randint(0, longest))])
    return {i: turns for i, turns in enumerate(made[1:])}


def rows_of(conversations):
    return [(conv, t, role, text) for conv, turns in conversations.items() for t, (role, text) in enumerate(turns)]


def nodes(frame):
    return sorted(tuple(row) for row in frame.collect())


@pytest.mark.parametrize(("light", "block"), [(1 << 16, 64), (25, 3)])
def test_random_conversations(spark, light, block):
    """With small bounds, components are split in Spark and prefixes go over several levels of blocks."""
    conversations = random_conversations(random.Random(light), 60, 12)
    convs = spark.createDataFrame([(c,) for c in conversations], "conv long")
    turns = prefixes.digest_turns(spark.createDataFrame(rows_of(conversations), SCHEMA))
    assert nodes(prefixes.prefix_trie(turns, convs, light, block)) == brute_nodes(conversations)


def test_one_long_conversation(spark):
    """A chain of 700 turns with a branch, split at centroids in Spark."""
    chain = [("u", str(i)) for i in range(700)]
    conversations = {5: chain, 9: [*chain[:650], ("a", "other")], -3: chain[:10]}
    turns = prefixes.digest_turns(spark.createDataFrame(rows_of(conversations), SCHEMA))
    assert nodes(prefixes.prefix_trie(turns, light=300, block=8)) == brute_nodes(conversations)


def test_forest_on_arrays():
    r = np.random.default_rng(1)
    for n in (1, 2, 50, 3000):
        for reach in (1, 3, n):
            parent = np.array([-1] + [r.integers(max(0, i - reach), i) if r.random() < 0.99 else -1 for i in range(1, n)])
            depth, weight, own = np.zeros(n, np.int64), r.integers(1, 9, n), r.integers(0, 99, (n, 2))
            want = own.copy()
            for i in range(n):
                depth[i] = depth[parent[i]] + 1 if parent[i] >= 0 else 0
            for i in range(n - 1, 0, -1):
                if parent[i] >= 0:
                    weight[parent[i]] += weight[i]
                    want[parent[i]] += want[i]
            assert (prefixes.Forest(parent, depth, weight).roll_up(own) == want).all()


def test_batches_end_between_components(spark, monkeypatch):
    r = random.Random(4)
    conversations = {i: [("u", str(i % 40))] + [("a", str(r.randrange(3))) for _ in range(r.randint(0, 6))] for i in range(200)}
    turns = prefixes.digest_turns(spark.createDataFrame(rows_of(conversations), SCHEMA))
    monkeypatch.setattr(prefixes, "TOGETHER", 7)
    assert nodes(prefixes.prefix_trie(turns)) == brute_nodes(conversations)


def test_odd_rows(spark):
    """Nulls, ties, repeated rows, long texts, other columns and an empty table."""
    rows = [
        (1, None, "u", "first"),
        (1, 2, "u", "tie b"),
        (1, 2, "u", "tie b"),
        (2, 0, None, None),
        (3, 0, "", ""),
        (None, 1, "u", "nobody"),
        (4, 1, "u", "x" * 300_000),
        (4, 1 << 60, "ab", "c"),
        (6, 1, "u", "x" * 300_000),
        (6, 2, "a", "bc"),
    ]
    frame = spark.createDataFrame([(*row, 7, "z") for row in rows], f"{SCHEMA}, key int, conv string")
    turns = prefixes.digest_turns(frame)
    assert nodes(prefixes.prefix_trie(turns)) == brute_nodes(brute_turns(rows))
    assert prefixes.prefix_trie(prefixes.digest_turns(frame.limit(0))).collect() == []
    none = spark.createDataFrame([(8,), (3,), (8,)], "conv long")
    assert nodes(prefixes.prefix_trie(turns.limit(0), none)) == brute_nodes({3: [], 8: []})


def test_ties_do_not_follow_the_order_of_rows(spark):
    rows = [(1, 1, "u", "a"), (1, 1, "u", "b"), (2, 1, "u", "b"), (2, 1, "u", "a")]
    found = prefixes.prefix_trie(prefixes.digest_turns(spark.createDataFrame(rows, SCHEMA)))
    assert found.where("n_convs = 2 and depth = 2").count() == 1


def test_a_conversation_over_many_tasks(spark):
    """Numbers come out of offsets between tasks."""
    rows = [(i % 20 if i % 3 else 100, i, "u", str(i)) for i in range(6000)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        turns = prefixes.digest_turns(spark.createDataFrame(rows, SCHEMA).repartition(7))
        hot = turns.where("conv = 100").agg(F.count("*"), F.min("no"), F.max("no"), F.countDistinct("no"), F.max("length")).head()
        assert tuple(hot) == (2000, 1, 2000, 2000, 2000)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_query(spark, tmp_path):
    r = random.Random(6)
    conversations = random_conversations(r, 90, 14)
    conversations = {conv * (3 if conv % 2 else 1): turns for conv, turns in conversations.items()}
    rows = rows_of(conversations)
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    own = brute_turns(rows)
    rebuilt = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        rebuilt[conv] = own.get(conv - conv % 5, [])[:h] + turns[h:]
    assert nodes(QUERIES["op13_prefix_trie"](spark, str(tmp_path))) == brute_nodes(rebuilt)
    assert any(not turns for turns in rebuilt.values())
