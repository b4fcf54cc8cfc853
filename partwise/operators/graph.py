"""Social graphs given as friend lists, one user per line.

Both pair jobs ask for every pair of names that share a list, so the pair rows are
the work. They are made and grouped so that neither a long list nor a popular pair
ends up in one task:

* copies of a list are merged before any pair is made;
* a list is cut into blocks, and every two blocks form a tile that is shuffled on
  its own, so the pairs of one long list are made by many tasks;
* the members of a pair on very many lists are gathered in parts first.

No job makes the pairs of a list more than once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partwise.functions.lists import no_names, repeated_names, split_names, without
from partwise.functions.text import strip
from partwise.session import written

# Fixed values of the two line formats.
TAB = "\t"
ARROW = " -> "
COMMENT = "#"
# The names under which a job reports how its lines fared.
COUNTER_NAMES = {
    "malformed": "Lignes malformées",
    "celebrity": "Célébrités ignorées",
    "processed": "Utilisateurs traités",
    "pairs_with_members": "Paires avec amis communs",
}

# Names per block of a list; longer lists use larger blocks.
BLOCK = 256
# A pair on more lists than this is gathered in parts of about so many members.
PART_MEMBERS = 1_000_000
# Pairs that one task makes, about.
TASK_PAIRS = 4_000_000
# A name whose lists hold more names than this, together, is hot: they are not brought into a row.
HOT_NAMES = 100_000
# Pairs that one task divides, about; they stand there with the names of their lists.
TASK_DIVIDED = 1_000_000


def classify_tab_lines(lines: DataFrame, max_friends: int | None = None) -> DataFrame:
    """``user<TAB>a,b,…`` lines with user, friends and an outcome per line.

    Outcomes: skipped (blank or comment), malformed (no tab), celebrity (more than
    ``max_friends`` names, repeats included; only if that is given), processed.
    """
    line = strip(F.col("value"))
    parts = lines.select(line.alias("line"), F.split(line, TAB, 2).alias("parts"))
    parsed = parts.select(
        "line",
        strip(F.get("parts", F.lit(0))).alias("user"),
        split_names(strip(F.get("parts", F.lit(1)))).alias("friends"),
    )
    outcome = (
        F.when((F.col("line") == "") | F.col("line").startswith(COMMENT), "skipped")
        .when(~F.contains("line", F.lit(TAB)), "malformed")
        .when(_too_long(max_friends), "celebrity")
        .otherwise("processed")
    )
    return parsed.select("user", "friends", outcome.alias("outcome"))


def parse_tab_lines(lines: DataFrame) -> DataFrame:
    """(user, friends) of the well-formed ``user<TAB>a,b,…`` lines."""
    classified = classify_tab_lines(lines)
    return classified.filter(F.col("outcome") == "processed").select("user", "friends")


def parse_arrow_lines(lines: DataFrame) -> DataFrame:
    """(user, friends) of the ``user -> a,b,…`` lines.

    Lines are not trimmed and know no comments. One arrow must part two texts;
    what is empty after the second does not count.
    """
    parts = lines.select(F.split("value", ARROW).alias("parts"))
    listed = F.get("parts", F.lit(1))
    rest = F.array_join(F.slice("parts", 3, F.size("parts")), "")
    return parts.filter((listed != "") & (rest == "")).select(
        strip(F.get("parts", F.lit(0))).alias("user"), split_names(listed).alias("friends")
    )


def _too_long(max_friends: int | None) -> Column:
    return F.lit(False) if max_friends is None else F.size("friends") > max_friends


def clean_lists(adjacency: DataFrame) -> DataFrame:
    """Friend lists without blank and repeated names."""
    return adjacency.withColumn("friends", without(F.array_distinct("friends"), F.lit("")))


def _bitmap(names: Column, seed: int) -> Column:
    """A bit of 64 for each name, by its hash."""

    def add(bits: Column, name: Column) -> Column:
        at = F.xxhash64(name, F.lit(seed)).bitwiseAND(63).cast("int")
        return bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))

    return F.aggregate(names, F.lit(0).cast("long"), add)


def _with_names(merged: DataFrame) -> DataFrame:
    """Distinct ``names`` of the sorted ``friends``, those met ``twice``, and the ``size``."""
    return merged.withColumns(
        {
            "names": F.array_distinct("friends"),
            "twice": repeated_names(F.col("friends")),
            "size": F.size("friends"),
        }
    ).filter(F.col("size") > 1)


def _sorted_friends(max_friends: int | None) -> Column:
    ordered = F.coalesce(F.sort_array("friends"), no_names())
    return F.when(_too_long(max_friends), no_names()).otherwise(ordered)


def _user_lists(adjacency: DataFrame, max_friends: int | None) -> DataFrame:
    """Each list of a user that has a pair, once: ``names``, ``twice`` and a ``list`` number."""
    merged = adjacency.select("user", _sorted_friends(max_friends).alias("friends")).distinct()
    lists = _with_names(merged).select("user", "names", "twice", "size")
    return written(lists.withColumn("list", F.monotonically_increasing_id()), "friend-lists")


def _bare_lists(merged: DataFrame) -> DataFrame:
    """Each distinct list that has a pair, with a ``list`` number, whoever it belongs to.

    ``bits`` and ``more_bits`` are hash bitmaps of its ``distinct`` names.
    """
    lists = _with_names(merged.select("friends").distinct()).select("names", "twice", "size")
    lists = lists.withColumns(
        {"distinct": F.size("names"), "bits": _bitmap(F.col("names"), 1), "more_bits": _bitmap(F.col("names"), 2)}
    )
    return written(lists.withColumn("list", F.monotonically_increasing_id()), "friend-lists")


def _with_tiles(lists: DataFrame, block: int) -> DataFrame:
    """A row per tile ``(i, j)``, ``i <= j``, of each list.

    The block width grows with the list, so that the copied names stay few next to
    the pairs made from them. With repeats the last blocks may be empty.
    """
    width = F.greatest(F.lit(block), F.ceil(F.sqrt(F.col("size")) * (block / 64)))
    last = F.floor((F.col("size") - 1) / F.col("width"))
    return (
        lists.withColumn("width", width.cast("int"))
        .withColumn("last", last.cast("int"))
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("last"))))
        .withColumn("j", F.explode(F.sequence(F.col("i"), F.col("last"))))
    )


def _tasks(lists: DataFrame, task_pairs: int = TASK_PAIRS) -> int:
    """Tasks for the pairs, by their number: the tiles are far smaller than their pairs,
    and adaptive execution would merge them by their own size."""
    size = F.col("size").cast("double")
    pairs = lists.agg(F.sum(size * size / 2)).head()[0] or 0
    least = lists.sparkSession.sparkContext.defaultParallelism
    return max(least, int(pairs // task_pairs) + 1)


def _pairs(lists: DataFrame, keep: Sequence[str], block: int, spread: bool = True) -> DataFrame:
    """``f1 <= f2`` once for each list that holds both, with the columns to ``keep``.

    A name met twice in a list pairs with itself. Without ``spread`` lists of one tile stay
    where they are, for callers who combine the pairs to few before any shuffle. If the lists
    have ``counts``, a number or null beside each name, those of the pair follow as n1 and n2.
    """

    def part(index: str, of: str = "names") -> Column:
        return F.slice(of, F.col(index) * F.col("width") + 1, F.col("width"))

    same = F.col("i") == F.col("j")
    counts = [part("i", "counts").alias("left_counts"), part("j", "counts").alias("right_counts")] if "counts" in lists.columns else []
    tiles = (
        _with_tiles(lists, block)
        .select("list", *[c for c in keep if c != "list"], "i", "j", "last", "twice", part("i").alias("left"), part("j").alias("right"), *counts)
        .withColumn("twice", F.when(same, F.array_intersect("left", "twice")).otherwise(no_names()))
    )
    if spread:
        tiles = tiles.repartition(_tasks(lists), "list", "i", "j")
    else:
        long = tiles.filter("last > 0").repartition(_tasks(lists), "list", "i", "j")
        tiles = tiles.filter("last = 0").unionByName(long)
    tiles = tiles.drop("last")
    start = F.col("at") + F.when(F.array_contains("twice", F.col("f1")), 1).otherwise(2)
    right = F.arrays_zip("right", "right_counts") if counts else F.col("right")
    partners = F.when(same, F.slice(right, start, F.size("right"))).otherwise(right)
    first = tiles.select("*", F.posexplode("left").alias("at", "f1"))
    if counts:
        return first.select(*keep, "f1", F.get("left_counts", F.col("at")).alias("n1"), F.inline(partners).alias("f2", "n2"))
    return first.select(*keep, "f1", F.explode(partners).alias("f2"))


def friend_pairs(adjacency: DataFrame, max_friends: int | None = None, block: int = BLOCK) -> DataFrame:
    """(user, f1, f2): the pairs of each friend list, ``f1 <= f2``, once per list."""
    return _pairs(_user_lists(adjacency, max_friends), ["user"], block)


def common_friend_rows(
    adjacency: DataFrame, max_friends: int | None = None, block: int = BLOCK
) -> DataFrame:
    """(f1, f2, member): each user whose list holds both names, one per row.

    The long form of :func:`common_friends`; no pair is gathered anywhere.
    """
    pairs = friend_pairs(adjacency, max_friends, block)
    return pairs.select("f1", "f2", F.col("user").alias("member")).distinct()


def _with_hot_names(lists: DataFrame, part_members: int) -> DataFrame:
    """``lists`` with ``hot``, of its names the ones on more than ``part_members`` lists, with their number.

    If there are any, ``counts`` are the same numbers beside the ``names``, null for others.
    Names are counted, not pairs: that is linear in the lists. A pair is on at most as many
    lists as the rarer of its names.
    """
    counts = lists.select(F.explode("names").alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    hot = written(counts.filter(F.col("n") > part_members), "hot-names")
    if hot.isEmpty():
        return lists.withColumn("hot", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>")))
    held = lists.select("list", "user", "twice", "size", F.posexplode("names").alias("at", "name")).join(hot, "name", "left")
    whole = [F.first(c).alias(c) for c in ("user", "twice", "size")]
    beside = F.sort_array(F.collect_list(F.struct("at", "name", "n"))).alias("beside")
    grouped = held.groupBy("list").agg(*whole, beside)
    pairs = F.transform(F.filter("beside", lambda x: x["n"].isNotNull()), lambda x: F.struct(x["name"], x["n"]))
    names = [F.col("beside.name").alias("names"), F.col("beside.n").alias("counts"), F.map_from_entries(pairs).alias("hot")]
    return grouped.select("list", "user", "twice", "size", *names)


def common_friends(
    adjacency: DataFrame,
    max_friends: int | None = None,
    block: int = BLOCK,
    part_members: int = PART_MEMBERS,
) -> DataFrame:
    """(f1, f2, members): the sorted users whose list holds both names, a row per pair.

    The pair rows are made once, and routed as they are made: a pair whose names are both on
    more than ``part_members`` lists is gathered by a hash of the user in several tasks,
    before the parts become its row; all others in one group. A pair whose members do not
    fit into a row is a case for :func:`common_friend_rows` and the sink of pair lines.
    """
    lists = _with_hot_names(_user_lists(adjacency, max_friends), part_members)
    pairs = _pairs(lists, ["user"], block)
    if "counts" in lists.columns:
        lists_at_most = F.least("n1", "n2")
        parts = F.ceil(lists_at_most / part_members).cast("int")
        # Least ignores a null; a pair with one hot name is not hot.
        is_hot = F.col("n1").isNotNull() & F.col("n2").isNotNull()
        part = F.when(is_hot, F.pmod(F.xxhash64("user"), parts))
        # The rows of a part meet in one task, which gathers them before the parts are merged.
        pairs = pairs.select("f1", "f2", part.alias("part"), "user").repartition("f1", "f2", "part")
    # A user on many lists is met once per task before the last shuffle, and once after it.
    # The hash comes first, as numbers are sorted faster than names.
    gathered = pairs.groupBy(F.hash("f1", "f2"), "f1", "f2").agg(F.collect_set("user").alias("members"))
    return gathered.select("f1", "f2", F.sort_array("members").alias("members"))


def _rest(names: str) -> Column:
    return without(F.col(names), F.col("f1"), F.col("f2"))


def _wanted() -> Column:
    """How many names of a list are the pair's own; a name with itself is one."""
    return F.when(F.col("f1") == F.col("f2"), 1).otherwise(2)


def _met(lists: DataFrame, block: int, names: DataFrame | None = None) -> DataFrame:
    """Each pair, of ``names`` if they are given, whose lists all hold more than it, with the number ``n`` of its lists and one of them.

    One pass over the pair rows. Beside the counts, the lists' bitmaps are combined by a
    bitwise and, before the shuffle and after it: a name on all lists has its bits left.
    For pairs on one list nothing but the list is kept.
    """
    pairs = _pairs(lists, ["list", "distinct", "bits", "more_bits"], block, spread=names is None)
    if names is not None:
        for end in ("f1", "f2"):
            pairs = pairs.join(names, F.col(end) == F.col("hot"), "left_semi")
    met = pairs.groupBy("f1", "f2").agg(
        F.count("*").alias("n"),
        F.min("list").alias("list"),
        F.min("distinct").alias("distinct"),
        F.bit_and("bits").alias("bits"),
        F.bit_and("more_bits").alias("more_bits"),
    )
    return met.filter(F.col("distinct") > _wanted()).drop("distinct")


def _candidates(met: DataFrame, lists: DataFrame) -> DataFrame:
    """Pairs on more than one list, with the names of one list that the bitmaps leave."""
    more = met.filter(F.col("n") > 1).join(lists.select("list", "names"), "list")

    def has_bits(bits: str, name: Column, seed: int) -> Column:
        at = F.xxhash64(name, F.lit(seed)).bitwiseAND(63).cast("int")
        return F.call_function("getbit", F.col(bits), at) == 1

    def is_left(name: Column) -> Column:
        is_other = (name != F.col("f1")) & (name != F.col("f2"))
        return is_other & has_bits("bits", name, 1) & has_bits("more_bits", name, 2)

    left = more.select("f1", "f2", F.filter("names", is_left).alias("candidates"))
    return written(left.filter(F.size("candidates") > 0), "candidates")


#: Bits of a word that say which of so many candidates are on all lists.
_WORD = 60


def _divided(candidates: DataFrame, lists: DataFrame) -> DataFrame:
    """(f1, f2, members): the ``candidates`` that are on every list of their pair.

    The lists of a pair come from those of the rarer of its names, each list standing by all
    its names. Each gives a bitmap over the candidates, by their place, and one aggregation
    with a bitwise and divides them.
    """
    held = lists.select(F.explode("names").alias("name"), "names", "twice")
    names = candidates.select(F.explode(F.array("f1", "f2")).alias("name")).distinct()
    held = held.join(names, "name", "left_semi")
    counts = held.groupBy("name").agg(F.count("*").alias("on_lists"))
    asked = candidates
    for name in ("f1", "f2"):
        asked = asked.join(counts.select(F.col("name").alias(name), F.col("on_lists").alias(f"n_{name}")), name)
    rarer = F.when(F.col("n_f1") <= F.col("n_f2"), F.col("f1")).otherwise(F.col("f2"))
    other = F.when(F.col("n_f1") <= F.col("n_f2"), F.col("f2")).otherwise(F.col("f1"))
    asked = asked.select("f1", "f2", "candidates", rarer.alias("name"), other.alias("other"))
    has_other = F.when(F.col("name") == F.col("other"), F.array_contains("twice", F.col("other")))
    rows = asked.join(held, "name").filter(has_other.otherwise(F.array_contains("names", F.col("other"))))
    size = F.size("candidates")
    starts = F.sequence(F.lit(0), size - 1, F.lit(_WORD))

    def word(start: Column) -> Column:
        """The bits of the candidates from ``start`` on that are on this list."""
        part = F.slice("candidates", start + 1, F.lit(_WORD))
        bits = F.transform(
            part,
            lambda name, at: F.when(
                F.array_contains("names", name), F.call_function("shiftleft", F.lit(1).cast("long"), at)
            ).otherwise(0),
        )
        return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))

    words = F.transform(starts, lambda start: F.struct(start.alias("start"), word(start).alias("bits")))
    rows = rows.select("f1", "f2", F.inline(words))
    left = rows.groupBy("f1", "f2", "start").agg(F.bit_and("bits").alias("bits")).filter("bits <> 0")
    found = left.join(candidates, ["f1", "f2"])
    part = F.slice("candidates", F.col("start") + 1, F.lit(_WORD))
    is_on = F.filter(part, lambda name, at: F.call_function("getbit", F.col("bits"), at) == 1)
    return found.select("f1", "f2", is_on.alias("members"))


def _hot_names(lists: DataFrame, hot_names: int) -> DataFrame:
    """(hot): the names whose lists hold more than ``hot_names`` names together; names are counted, not pairs."""
    counts = lists.select("size", F.explode("names").alias("hot")).groupBy("hot").agg(F.sum("size").alias("held"))
    return written(counts.filter(F.col("held") > hot_names).select("hot"), "hot-names")


def _owned_pairs(lists: DataFrame, hot: DataFrame | None, block: int) -> DataFrame:
    """(owner, other, names): each pair of a list with a name that is not hot, under that one.

    Of two such names the smaller is the owner. A list goes once to each of its owners, not to
    each of its pairs, and the pairs are made there: all lists of an owner meet in one task, and
    they hold at most as many names as make one hot. The owners of a long list are taken in
    blocks by many tasks.
    """
    width = F.greatest(F.lit(block), F.ceil(F.sqrt(F.col("size")) * (block / 64))).cast("int")
    long = F.size("names") > width
    starts = F.explode(F.sequence(F.lit(1), F.size("names"), width)).alias("start")
    blocks = lists.filter(long).select("list", "names", "twice", width.alias("width"), starts)
    tasks = _tasks(lists, TASK_DIVIDED)
    blocks = blocks.repartition(tasks, "list", "start")
    own = blocks.select("names", "twice", F.explode(F.slice("names", F.col("start"), F.col("width"))).alias("owner"))
    rows = lists.filter(~long).select("names", "twice", F.explode("names").alias("owner")).unionByName(own)
    if hot is not None:
        rows = rows.join(hot, F.col("owner") == F.col("hot"), "left_anti")
    rows = rows.select("owner", "names", F.array_contains("twice", F.col("owner")).alias("twice"))
    pairs = rows.repartition(tasks, "owner").select("owner", "names", "twice", F.explode("names").alias("other"))
    itself = (F.col("other") == F.col("owner")) & F.col("twice")
    is_pair = itself | (F.col("other") > F.col("owner"))
    if hot is not None:
        pairs = pairs.join(hot, F.col("other") == F.col("hot"), "left")
        is_pair |= F.col("hot").isNotNull()
    return pairs.filter(is_pair).select("owner", "other", "names")


def _divided_at_owners(pairs: DataFrame) -> DataFrame:
    """(f1, f2, members) of the owned ``pairs``, where there are members; they are grouped where they are made."""
    met = pairs.groupBy("owner", "other").agg(F.collect_list("names").alias("lists"))
    names = F.aggregate(F.slice("lists", 2, F.size("lists")), F.get("lists", F.lit(0)), F.array_intersect)
    members = without(names, F.col("owner"), F.col("other"))
    # Exploded, not filtered: a filter would have the names divided twice.
    some = F.explode(F.filter(F.array(members), lambda left: F.size(left) > 0)).alias("members")
    return met.select(F.least("owner", "other").alias("f1"), F.greatest("owner", "other").alias("f2"), some)


def _hot_pairs(lists: DataFrame, hot: DataFrame, block: int) -> DataFrame:
    """(f1, f2, members) of the pairs of two hot names, where there are members; these may come in parts.

    Such a pair is on many lists, but there are few: they are combined before the shuffle.
    """
    several = F.col("n") > 1
    kept = [F.when(several, F.col(name)).alias(name) for name in ("bits", "more_bits")]
    met = _met(lists, block, hot).select("f1", "f2", "n", "list", *kept)
    met = written(met, "met-pairs")
    alone = met.filter(~several).join(lists.select("list", "names"), "list")
    alone = alone.select("f1", "f2", _rest("names").alias("members"))
    candidates = _candidates(met, lists)
    return alone if candidates.isEmpty() else alone.unionByName(_divided(candidates, lists))


def _found(lists: DataFrame, block: int, hot_names: int) -> tuple[DataFrame, DataFrame | None]:
    """(f1, f2, members): the pairs with a name that is not hot, and those of two hot names in parts, if any."""
    hot = _hot_names(lists, hot_names)
    if hot.isEmpty():
        return _divided_at_owners(_owned_pairs(lists, None, block)), None
    return _divided_at_owners(_owned_pairs(lists, hot, block)), _hot_pairs(lists, hot, block)


def _intersections(lists: DataFrame, block: int, hot_names: int = HOT_NAMES) -> DataFrame:
    found, parts = _found(lists, block, hot_names)
    if parts is None:
        return found
    parts = parts.groupBy("f1", "f2").agg(F.collect_list("members").alias("parts"))
    return found.unionByName(parts.select("f1", "f2", F.sort_array(F.flatten("parts")).alias("members")))


def friend_list_intersection(
    adjacency: DataFrame, max_friends: int | None = None, block: int = BLOCK, hot_names: int = HOT_NAMES
) -> DataFrame:
    """(f1, f2, members): the names on every list that holds both, without the two.

    Pairs with no such name have no row. Not the same as :func:`common_friends`.

    Only the set of distinct lists matters, so each is written once under a number. A list
    goes to each of its names, and the pairs of a name are made and divided where its lists
    are. Pairs of two names whose lists hold more than ``hot_names`` names, each, are combined
    before the shuffle instead: hash bitmaps leave few candidates, which are then divided.
    """
    lists = _bare_lists(adjacency.select(_sorted_friends(max_friends).alias("friends")))
    return _intersections(lists, block, hot_names)


def _classified_lists(lines: DataFrame, max_friends: int | None) -> tuple[DataFrame, DataFrame]:
    """(outcome, n) of the lines and the distinct lists, from one scan."""
    classified = classify_tab_lines(lines, max_friends)
    used = F.when(F.col("outcome") == "processed", F.coalesce(F.sort_array("friends"), no_names()))
    merged = classified.select("outcome", used.alias("friends")).groupBy("outcome", "friends")
    merged = written(merged.agg(F.count("*").alias("n")), "graph-lines")
    outcomes = merged.groupBy("outcome").agg(F.sum("n").alias("n"))
    return outcomes, _bare_lists(merged.filter(F.col("friends").isNotNull()))


def graph_outcomes(
    lines: DataFrame, max_friends: int | None = None, block: int = BLOCK, hot_names: int = HOT_NAMES
) -> DataFrame:
    """Lines per outcome, and the pairs that have a friend-list intersection.

    The pairs are found as in :func:`friend_list_intersection`, and counted where they are found.
    """
    outcomes, lists = _classified_lists(lines, max_friends)
    found, parts = _found(lists, block, hot_names)
    found = found.agg(F.count("*").alias("n"))
    if parts is not None:
        parts = parts.select("f1", "f2").distinct().agg(F.count("*").alias("n"))
        found = found.unionByName(parts).agg(F.sum("n").alias("n"))
    found = found.filter(F.col("n") > 0).select(F.lit("pairs_with_members").alias("outcome"), "n")
    return outcomes.unionByName(found)


def intersection_and_outcomes(lines: DataFrame, max_friends: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The friend-list intersection and (outcome, n) of the lines, from one scan."""
    outcomes, lists = _classified_lists(lines, max_friends)
    return _intersections(lists, BLOCK), outcomes
