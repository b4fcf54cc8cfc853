"""Line deduplication against all pairs of lines."""

from __future__ import annotations

import random

import pytest

from partwise.llm import lines


def word_set(line):
    return frozenset(w for w in line.lower().split() if w)


def brute(rows, min_words, percent):
    """{doc_id: removed line numbers}"""
    every = sorted({(d, i, word_set(line)) for d, t in rows if d is not None and t is not None for i, line in enumerate(t.split("\n"))}, key=lambda x: x[:2])
    every = [x for x in every if len(x[2]) >= min_words]
    gone = {}
    for k, (d, i, s) in enumerate(every):
        for e, j, o in every[:k]:
            if (e, j) != (d, i) and 100 * len(s & o) >= percent * len(s | o):
                gone.setdefault(d, set()).add(i)
                break
    return {d: sorted(v) for d, v in gone.items()}


def made(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["the", "of", "É", "x"]
    base = [[r.choice(words) for _ in range(r.randint(1, 25))] for _ in range(25)]

    def line():
        own = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
            if own and r.random() < 0.5:
                own[r.randrange(len(own))] = r.choice(words)
            elif r.random() < 0.5:
                own.insert(0, r.choice(words))
        text = r.choice([" ", "  ", "\t"]).join(own)
        return text.upper() if r.random() < 0.1 else text

    rows = [(i, "\n".join(line() for _ in range(r.randint(0, 8)))) for i in r.sample(range(-50, 200), 40)]
    rows += [(300, None), (301, ""), (302, "\n\n"), (303, "a b"), (304, "a b"), (305, " ".join(f"long{i}" for i in range(5000)))]
    rows += [(306, " ".join(f"long{i}" for i in range(4500))), (None, rows[0][1]), (307, rows[1][1]), (307, rows[1][1])]
    return rows


@pytest.mark.parametrize(("seed", "min_words", "percent"), [(1, 3, 80), (2, 1, 80), (3, 3, 60)])
def test_same_as_all_pairs(spark, seed, min_words, percent):
    rows = made(seed)
    docs = spark.createDataFrame([(*row, "k") for row in rows], "doc_id long, text string, k1 string")
    found = lines.line_report(docs.repartition(3), min_words, percent).collect()
    want = brute(rows, min_words, percent)
    assert len(found) == len(rows)
    for row in found:
        assert row.removed == want.get(row.doc_id, []), row.doc_id
        assert row.n_removed == len(row.removed)


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_rounds_do_not_change_the_result(spark, monkeypatch, rounds):
    """One large group of edited copies, in which most lines have many candidates, and not all of them match."""
    monkeypatch.setattr(lines, "ROUNDS", rounds)
    r = random.Random(9)
    base = [f"w{i}" for i in range(50)]
    rows = []
    for d in range(120):
        own = [w if r.random() > r.choice([0.04, 0.12]) else f"e{r.randrange(400)}" for w in base]
        rows.append((d, " ".join(own) + "\n" + " ".join(f"u{d}x{i}" for i in range(12))))
    found = lines.line_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    want = brute(rows, 1, 80)
    assert {x.doc_id: x.removed for x in found if x.removed} == want and 60 < len(want) < 119


def test_short_lines_are_compared_by_default(spark):
    rows = [(1, "Ietzte.\nhttps://a.example/b?c=d\none two"), (2, "Two  one\nietzte.\n\n \nother"), (3, "https://a.example/b?c=d\n\n \none three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.removed for r in lines.line_report(docs).collect()}
    assert found == {1: [], 2: [0, 1], 3: [0]}
    assert {r.doc_id: r.text for r in lines.drop_repeated_lines(docs).collect()} == {1: rows[0][1], 2: "\n \nother", 3: "\n \none three"}


def test_short_lines_share_no_empty_extreme(spark):
    docs = spark.createDataFrame([(i, f"a{i}\nb{i} c{i}") for i in range(20)], "doc_id long, text string")
    classes = lines._classes(docs, 1, 80)
    assert lines._with_earliest(classes, 0).count() == 0


def test_kept_text(spark):
    rows = [
        (1, "one two three four\nonly here", 1, "a"),
        (2, "x y z\nONE  two three four\nq", 2, "b"),
        (3, "one two three four", 3, "c"),
        (4, "", 0, "d"),
        (5, None, None, "e"),
        (None, "one two three four", 7, "f"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, gone string")
    kept = lines.drop_repeated_lines(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(
        [rows[0], (2, "x y z\nq", 7, "b"), rows[3], rows[4], rows[5]], key=repr
    )


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lines.line_report(docs).collect() == []
    assert lines.drop_repeated_lines(docs).collect() == []


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b c\nd e f")], "doc_id long, text string")
    plan = lines.line_report(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("packed", [lines.PACKED, lines.PACKED_CODES])
def test_filters_let_all_names_through(spark, packed):
    names = spark.range(3000).selectExpr("cast(id * 7919 as int) as code")
    assert names.where(lines._in_filter(names, "code", packed=packed)).count() == 3000


@pytest.mark.parametrize("packed", [lines.PACKED, lines.PACKED_CODES])
def test_no_filter_is_written_into_the_plan(spark, packed):
    names = spark.range(3000).selectExpr("cast(id * 7919 as int) as code")
    kept = names.where(lines._in_filter(names, "code", packed=packed))
    kept.count()
    assert len(kept._jdf.queryExecution().toString()) < 20_000


def test_entries_are_told_apart_by_lengths_alone(spark):
    """``most`` is the exact bound of lengths and places, and nothing that a pair is asked for can be null."""
    classes = lines._classes(spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(40)))], "doc_id long, text string"), 1, 80)
    assert not classes.schema["prefix"].dataType.containsNull
    entries = lines._entries(classes.selectExpr("*", "1 as open"), 80)
    assert [f.name for f in entries.schema if f.nullable] == ["doc_id"]
    most = sorted(r.most for r in entries.collect())
    assert most == sorted(max(n for n in range(200) if 180 * (40 - at) >= 80 * (40 + n)) for at in range(9))


@pytest.mark.parametrize(("text", "n_lines"), [(None, 0), ("", 1), ("a", 1), ("\n", 2), ("a\n\né\n", 4), ("a\r\nb", 2)])
def test_number_of_lines(spark, text, n_lines):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert lines.line_report(docs).first().n_lines == n_lines


def test_only_entries_of_candidates_meet(spark):
    """Lines that share rare words, of which two match; the others are too long, too short or hold other words."""
    pair = [f"w{i}" for i in range(20)]
    rows = [(0, " ".join(pair)), (1, " ".join([*pair[:-1], "other"]))]
    rows += [(i, " ".join(pair[i % 20 : i % 20 + 2] + [f"x{i}y{j}" for j in range(5 + i)])) for i in range(2, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = lines._classes(docs, 1, 80)
    none = classes.select("doc_id", "line").limit(0)
    found = lines._sharing_prefix(classes, none, 80)
    assert {(r.doc_id, r.open) for r in found.collect()} == {(0, 1), (1, 1)}
    gone = classes.where("doc_id = 1").select("doc_id", "line")
    assert lines._sharing_prefix(classes, gone, 80).count() == 0
    assert [r.doc_id for r in lines._late_by_prefix(docs, found, 80).distinct().collect()] == [1]


def test_marked_classes(spark):
    classes = spark.range(50).selectExpr("id as doc_id", "0 as line")
    gone = spark.range(0, 50, 7).selectExpr("id as doc_id", "0 as line")
    marked = {r.doc_id: r.open for r in lines._marked(classes, gone).collect()}
    assert marked == {i: int(i % 7 != 0) for i in range(50)}


def test_earliest_by_extreme_without_a_join(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (2, "a b c d e f g h i"), (3, "x y z")], "doc_id long, text string")
    pairs = lines._with_earliest(lines._classes(docs, 1, 80), 80)
    assert "Join" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r) for r in pairs.collect()} <= {(1, 0, 2, 0)}
