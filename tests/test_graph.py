"""Graph operators against fixtures and a brute force over plain Python."""

from __future__ import annotations

import random
import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from partwise.operators import graph
from partwise.session import child_session
from partwise.sources import pair_lines

# The small inputs whose results are known.
TAB_GRAPH = ("A\tB,C,D", "B\tA,C,E", "C\tA,B,D", "D\tA,C", "E\tB")
ARROW_GRAPH = ("A -> B,C,D", "B -> A,C", "C -> A,B,E", "D -> A", "E -> C")

# How the work is cut up must not show in the result.
BLOCKS = [256, 1, 2, 3]


def as_lists(df):
    return sorted((r.user, r.friends) for r in df.collect())


def gathered(df):
    """Members per pair, of which there is one row."""
    rows = df.collect()
    pairs = {(row.f1, row.f2): row.members for row in rows}
    assert len(pairs) == len(rows)
    assert all(m == sorted(set(m)) for m in pairs.values())
    return pairs


def pairs_of(friends):
    return {tuple(sorted(p)) for p in combinations(friends, 2)}


def brute_common(adjacency):
    found = {}
    for user, friends in adjacency:
        for pair in pairs_of(friends):
            found.setdefault(pair, set()).add(user)
    return {pair: sorted(users) for pair, users in found.items()}


def brute_intersection(adjacency):
    found = {}
    for _, friends in adjacency:
        for pair in pairs_of(friends):
            found[pair] = found.get(pair, set(friends)) & set(friends)
    rest = {pair: sorted(names - set(pair)) for pair, names in found.items()}
    return {pair: names for pair, names in rest.items() if names}


def random_graph(seed):
    """Lists of many lengths, copies, repeats, blanks, and two names on nearly all of them."""
    rng = random.Random(seed)
    names = [f"n{i}" for i in range(12)] + ["", "é", "Z"]
    graph_rows = []
    for line in range(40):
        friends = [rng.choice(names) for _ in range(rng.randrange(0, 9))]
        if rng.random() < 0.7:
            friends += ["hot1", "hot2"]
        graph_rows.append((f"u{rng.randrange(25)}", friends))
    copies = [(f"u{i}", ["hot1", "hot2", "n1", "n2"]) for i in range(25)]
    return graph_rows + copies + graph_rows[:10]


@pytest.fixture
def adjacency(spark):
    return lambda rows: spark.createDataFrame(rows, "user string, friends array<string>")


@pytest.mark.parametrize("block", BLOCKS)
def test_friend_list_intersection(lines, block):
    found = gathered(graph.friend_list_intersection(graph.parse_tab_lines(lines(*TAB_GRAPH)), block=block))
    assert found == {
        ("A", "B"): ["D"],
        ("A", "D"): ["B"],
        ("A", "E"): ["C"],
        ("B", "C"): ["D"],
        ("C", "D"): ["B"],
        ("C", "E"): ["A"],
    }


@pytest.mark.parametrize("cut", [{}, {"block": 2, "part_members": 1}])
def test_common_friends_of_both_formats(lines, cut):
    tab = gathered(graph.common_friends(graph.parse_tab_lines(lines(*TAB_GRAPH)), **cut))
    assert tab == {
        ("A", "B"): ["C"],
        ("A", "C"): ["B", "D"],
        ("A", "D"): ["C"],
        ("A", "E"): ["B"],
        ("B", "C"): ["A"],
        ("B", "D"): ["A", "C"],
        ("C", "D"): ["A"],
        ("C", "E"): ["B"],
    }
    arrow = gathered(graph.common_friends(graph.parse_arrow_lines(lines(*ARROW_GRAPH)), **cut))
    assert arrow == {
        ("A", "B"): ["C"],
        ("A", "C"): ["B"],
        ("A", "E"): ["C"],
        ("B", "C"): ["A"],
        ("B", "D"): ["A"],
        ("B", "E"): ["C"],
        ("C", "D"): ["A"],
    }


@pytest.mark.parametrize(("seed", "block"), list(enumerate(BLOCKS)))
def test_against_brute_force(adjacency, seed, block):
    rows = random_graph(seed)
    df = adjacency(rows)
    assert gathered(graph.friend_list_intersection(df, block=block)) == brute_intersection(rows)
    assert gathered(graph.common_friends(df, block=block)) == brute_common(rows)


@pytest.mark.parametrize("part_members", [1, 3, 20])
def test_parts_do_not_show(adjacency, part_members):
    rows = random_graph(7)
    assert gathered(graph.common_friends(adjacency(rows), part_members=part_members)) == brute_common(rows)


@pytest.mark.parametrize("block", [1, 2, 256])
def test_long_forms(adjacency, block):
    rows = random_graph(3)
    pairs = graph.friend_pairs(adjacency(rows), block=block).collect()
    distinct_lists = {(user, tuple(sorted(friends))) for user, friends in rows}
    wanted = sorted((user, *pair) for user, friends in distinct_lists for pair in pairs_of(friends))
    assert sorted(map(tuple, pairs)) == wanted
    members = {(r.f1, r.f2, r.member) for r in graph.common_friend_rows(adjacency(rows)).collect()}
    assert members == {(*pair, u) for pair, users in brute_common(rows).items() for u in users}


def test_user_on_many_lines_is_one_member(adjacency):
    rows = [("hot", ["a", "b", f"n{i}"]) for i in range(60)] + [("u", ["b", "a"])]
    assert gathered(graph.common_friends(adjacency(rows))) == brute_common(rows)


@pytest.mark.parametrize("cut", [{}, {"block": 16}])
def test_long_list(adjacency, cut):
    names = [f"{i:04d}" for i in range(120)]
    found = graph.friend_list_intersection(adjacency([("star", names)]), **cut)
    sizes = found.selectExpr("f1 < f2 as ordered", "size(members) as n").distinct().collect()
    assert [tuple(r) for r in sizes] == [(True, 118)]
    assert found.count() == 120 * 119 // 2


def test_guard_counts_repeats_and_is_strict(adjacency):
    rows = [("a", ["x", "y", "x"]), ("b", ["x", "y", "x", "z"]), ("c", ["p", "q", ""])]
    kept = gathered(graph.common_friends(adjacency(rows), max_friends=3))
    assert kept == brute_common([rows[0], rows[2]])


def test_repeated_name_pairs_with_itself_unless_cleaned(adjacency):
    rows = [("a", ["B", "B", "", "C"])]
    assert ("B", "B") in gathered(graph.common_friends(adjacency(rows)))
    clean = graph.clean_lists(adjacency(rows))
    assert gathered(graph.common_friends(clean)) == {("B", "C"): ["a"]}


@pytest.mark.parametrize(
    ("line", "parsed"),
    [
        ("", None),
        ("  \t ", None),
        (" # A\tB,C", None),
        ("nodelim", None),
        ("Z\t", None),
        (" X \t b , a ,, ", ("X", ["b", "a"])),
        ("X\ta,,b", ("X", ["a", "", "b"])),
        ("X\ta, ,", ("X", ["a", ""])),
        ("X\t,a", ("X", ["", "a"])),
        ("X\ta\tb,c", ("X", ["a\tb", "c"])),
        ("X\t,,,", ("X", [])),
        ("X\ta\x01 ,\x02b", ("X", ["a", "b"])),
    ],
)
def test_tab_line(lines, line, parsed):
    assert as_lists(graph.parse_tab_lines(lines(line))) == ([] if parsed is None else [parsed])


@pytest.mark.parametrize(
    ("line", "parsed"),
    [
        ("", None),
        ("nodelim", None),
        ("Y -> ", None),
        (" -> ", None),
        ("P -> Q -> R", None),
        ("P ->  -> R", None),
        ("P -> Q -> ", ("P", ["Q"])),
        ("P -> Q ->  -> ", ("P", ["Q"])),
        ("P -> -> ", ("P", ["->"])),
        (" -> a", ("", ["a"])),
        ("# P -> a,b", ("# P", ["a", "b"])),
        ("  P -> a , b ", ("P", ["a", "b"])),
        ("P -> a, ,", ("P", ["a", ""])),
        ("P -> ,", ("P", [])),
        ("P ->  ", ("P", [""])),
        ("P->a,b", None),
    ],
)
def test_arrow_line(lines, line, parsed):
    assert as_lists(graph.parse_arrow_lines(lines(line))) == ([] if parsed is None else [parsed])


def test_outcomes(lines):
    df = lines(*TAB_GRAPH, "", "# c", "nodelim", "S\ta,b,c,d")
    found = {r.outcome: r.n for r in graph.graph_outcomes(df).collect()}
    assert found["processed"] == 6 and "celebrity" not in found
    found = {r.outcome: r.n for r in graph.graph_outcomes(df, max_friends=3).collect()}
    assert found == {
        "skipped": 2,
        "malformed": 1,
        "celebrity": 1,
        "processed": 5,
        "pairs_with_members": 6,
    }


@pytest.mark.parametrize("seed", [11, 12])
def test_outcomes_count_the_pairs_with_members(adjacency, lines, seed):
    rows = [(u, [f for f in friends if f]) for u, friends in random_graph(seed)]
    df = lines(*[f"{user}\t{','.join(friends)}" for user, friends in rows if friends])
    found = {r.outcome: r.n for r in graph.graph_outcomes(df).collect()}
    assert found["pairs_with_members"] == len(brute_intersection(rows))


def test_source_is_scanned_once_and_no_pair_is_sorted(spark, tmp_path):
    path = str(tmp_path / "graph")
    spark.createDataFrame([(v,) for v in TAB_GRAPH], "value string").write.text(path)
    plain = child_session(spark, spark__sql__autoBroadcastJoinThreshold=-1)
    for made in (graph.friend_list_intersection(graph.parse_tab_lines(plain.read.text(path))), graph.graph_outcomes(plain.read.text(path))):
        made.collect()
        final = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "FileScan text" not in final and "Window" not in final  # the lists are written once
        shuffled = re.findall(r"(?<!Reused)Exchange hashpartitioning\(f1#\d+, f2#\d+, \d+\)", final)
        assert len(shuffled) <= 6


def test_pairs_are_made_once(adjacency):
    """One explosion of pairs in each job, and in the parts of a hot pair as well."""
    rows = adjacency(random_graph(5))
    lists = graph._bare_lists(rows.select(graph._sorted_friends(None).alias("friends")))
    for made in (graph._met(lists, 256), graph.common_friends(rows)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Generate posexplode(left") == 1


def test_more_candidates_than_bits_of_a_word(adjacency):
    """Pairs on two lists of 150 names that share 130: the bitmaps are full, the division exact."""
    names = [f"{i:03d}" for i in range(170)]
    rows = [("a", names[:150]), ("b", names[20:]), ("c", [*names[20:150], "x", "x"]), ("d", ["x", "x", "020", "y"])]
    found = gathered(graph.friend_list_intersection(adjacency(rows), block=64))
    wanted = brute_intersection(rows)
    assert found == wanted and len(found["030", "031"]) == 128 and found["x", "x"] == ["020"]


def test_hot_pairs_are_routed_apart(adjacency):
    """Only a pair of two names on many lists is gathered in parts."""
    rows = [(f"u{i:03d}", ["hot1", "hot2", f"n{i % 5}"]) for i in range(90)] + [("v", ["hot1", "n1", "n2"])]
    assert gathered(graph.common_friends(adjacency(rows), part_members=30)) == brute_common(rows)
    lists = graph._with_hot_names(graph._user_lists(adjacency(rows), None), 30)
    hot = lists.selectExpr("user", "map_keys(hot) as names").collect()
    assert all(set(r.names) == ({"hot1", "hot2"} if r.user != "v" else {"hot1"}) for r in hot)


def test_one_hot_name_with_itself_is_one_row(adjacency):
    """The only hot name stands twice in each list: its pair with itself comes in parts, which are merged."""
    rows = [(f"u{i:03d}", ["x", "x", f"n{i % 9}"]) for i in range(40)]
    found = graph.common_friends(adjacency(rows), part_members=10).collect()
    assert len(found) == len(brute_common(rows)) and {(r.f1, r.f2): list(r.members) for r in found} == brute_common(rows)


def test_pairs_take_numbers_not_all_hot_names(adjacency):
    """Counts lie beside the names, so no pair looks anything up, and the parts are not written between."""
    rows = random_graph(7)
    made = graph.common_friends(adjacency(rows), block=2, part_members=1)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "map_contains_key" not in plan and "map_from_entries" not in plan and "Union" not in plan
    assert plan.count("collect_set") == 1 and "RepartitionByExpression [f1" in plan
    lists = graph._with_hot_names(graph._user_lists(adjacency(rows), None), 1)
    for r in lists.select("names", "counts", "hot").collect():
        assert dict(zip(r.names, r.counts, strict=True)) == {name: r.hot.get(name) for name in r.names}


def test_lines_written_member_by_member(spark, adjacency, tmp_path):
    """The long form as lines: a pair of 30 000 members, repeats, odd names, and a repeated write."""
    rows = [(f"u{i:05d}", ["hot1", "hot2"]) for i in range(30_000)] + random_graph(4) + [("é, [x]", ["n1", "n2"])]
    pairs = graph.friend_pairs(adjacency(rows))
    path = tmp_path / "lines"
    for _ in range(2):
        pair_lines.write_member_lines(pairs.unionByName(pairs), F.concat_ws(",", "f1", "f2"), F.col("user"), str(path))
    wanted = {f"{a},{b}\t[{', '.join(users)}]" for (a, b), users in brute_common(rows).items()}
    found = [line for file in path.glob("part-*") for line in file.read_text().split("\n")[:-1]]
    assert set(found) == wanted and len(found) == len(wanted)
    assert {r.value for r in spark.read.text(str(path)).collect()} == wanted
    members = graph.common_friend_rows(adjacency(rows)).count()
    assert members == sum(len(users) for users in brute_common(rows).values())


def test_a_failed_write_of_lines_leaves_the_first(spark, tmp_path):
    path = tmp_path / "lines"
    good = spark.range(20).select(F.col("id").alias("k"), F.lit("m").alias("m"))
    pair_lines.write_member_lines(good, F.col("k"), F.col("m"), str(path))
    bad = good.withColumn("m", F.when(F.col("k") == 19, F.raise_error(F.lit("broken"))).otherwise(F.col("m")))
    with pytest.raises(Exception, match="broken"):
        pair_lines.write_member_lines(bad, F.col("k"), F.col("m"), str(path))
    assert spark.read.text(str(path)).count() == 20
    pair_lines.write_member_lines(good.limit(0), F.col("k"), F.col("m"), str(path))
    assert spark.read.text(str(path)).count() == 0


@pytest.mark.parametrize("hot_names", [0, 12, 40, 1000])
@pytest.mark.parametrize("block", [2, 256])
def test_hot_names_do_not_show(adjacency, lines, hot_names, block):
    """No name, some names and all names are hot; the intersection and its number are the same."""
    rows = [(u, [f for f in friends if f]) for u, friends in random_graph(21)]
    wanted = brute_intersection(rows)
    assert gathered(graph.friend_list_intersection(adjacency(rows), block=block, hot_names=hot_names)) == wanted
    df = lines(*[f"{user}\t{','.join(friends)}" for user, friends in rows if friends])
    found = {r.outcome: r.n for r in graph.graph_outcomes(df, block=block, hot_names=hot_names).collect()}
    assert found["pairs_with_members"] == len(wanted)


def test_no_pair_is_shuffled_unless_both_names_are_hot(adjacency):
    """Lists go to their names: before, every pair row was shuffled, and pairs on more lists with each of these."""
    rows = [(f"u{i}", [f"p{i % 7}", f"q{i % 5}", f"r{i}", "brand"]) for i in range(60)]
    made = graph.friend_list_intersection(adjacency(rows))
    assert gathered(made) == brute_intersection(rows)
    plan = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert re.findall(r"Exchange hashpartitioning\((\w+)#", plan) == ["owner"]
