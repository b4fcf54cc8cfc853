"""Line deduplication by an exact set-similarity join, in DataFrame functions only.

A line is the set of its words. Two lines match if 100 * |A & B| >= percent * |A | B|, and a
line goes if it matches one that comes earlier, by (doc_id, line number).

1. Words are counted over the whole corpus in ``COUNTERS`` counters, by hash: a table of
   fixed size. Any order of the words makes the filters exact; that by rarity makes them fast.
2. Equal lines form a class, known by its first place.
3. Most edited copies are settled against one line each: of the classes that share their
   smallest and largest word hashes, all are compared with the earliest.
4. What is left enters the join under the rarest words of its prefix, |A| - ceil(t |A|) + 1
   of them: matching sets share one there. Length, the words left behind the shared one, and
   the parities of the words' hashes bound the overlap from above before anything is verified.
   Two semi joins find the entries of candidate pairs, those that ask and those that answer, without a pair.
5. One earlier match is enough for a line to go. So those few lines meet the earliest line of
   each of their words first, in ``ROUNDS`` rounds, and only lines that no round settles are
   paired with all their candidates.
6. Every match is verified on the words of the lines themselves.

A line that fills a third of the corpus is a single class, and a class that has found an
earlier match is not paired again.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partwise.llm.common import free_name, settle

COUNTER_BITS = 18
COUNTERS = 1 << COUNTER_BITS
#: Numbers of 64 bits that a filter of documents is packed into.
PACKED = 1 << 14
#: The same for the filter of prefix words, of which a line has several.
PACKED_CODES = 1 << 17
MIN_WORDS, PERCENT = 1, 80
#: Rounds against one line per word, before all candidates are paired; no number changes the result.
ROUNDS = 3
_KEY, _PLACE = ["k1", "k2"], ["doc_id", "line"]


def _split_words(line: Column) -> Column:
    for blank in ("\t", "\r"):
        line = F.replace(line, F.lit(blank), F.lit(" "))
    return F.split(F.lower(line), " ")


def line_words(line: Column) -> Column:
    """The distinct lower-case words of a line, split at spaces, tabs and carriage returns."""
    return F.array_remove(F.array_distinct(_split_words(line)), "")


def _word_hashes(line: Column) -> Column:
    """The hashes of those words, sorted; numbers are told apart faster than words."""
    hashes = F.array_distinct(F.transform(_split_words(line), lambda w: F.xxhash64(w)))
    return F.sort_array(F.array_remove(hashes, F.xxhash64(F.lit(""))))


def _rarity(texts: DataFrame) -> Column:
    """The level of each counter, floor(log2(count)) to 15: a constant array of fixed size in the plan.

    Words are counted as they are written. Their lower-case forms are looked up, and any order is exact.
    """
    words = texts.select(F.explode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")).alias("word"))
    counts = words.groupBy(_counter(F.xxhash64("word")).alias("counter")).agg(F.count("*").alias("n"))
    levels = ["0"] * COUNTERS
    for row in counts.select("counter", F.least(F.floor(F.log2("n")), F.lit(15)).alias("level")).toLocalIterator():
        levels[row["counter"]] = str(row["level"])
    return F.split(F.lit(",".join(levels)), ",").cast("array<int>")


def _counter(h: Column) -> Column:
    """A word's counter is the upper part of its hash."""
    return F.shiftrightunsigned(h, 64 - COUNTER_BITS).cast("int")


def _parities(hashes: Column) -> Column:
    """64 bits, each word flips that of its hash's bits 57 to 62; a shift looks at six bits only."""

    def flipped(bits: Column, h: Column) -> Column:
        place = F.shiftrightunsigned(h, 57).cast("int")
        return bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))

    return F.aggregate(hashes, F.lit(0).cast("long"), flipped)


def _needed(n: Column, percent: int) -> Column:
    """ceil(percent * n / 100) for whole numbers."""
    return F.floor((n * percent + 99) / 100).cast("int")


def _lines(texts: DataFrame) -> DataFrame:
    """(doc_id, line, text, k1, k2) of every line."""
    split = texts.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    return split.withColumns({"k1": F.xxhash64("text"), "k2": F.hash("text")})


def _classes(texts: DataFrame, min_words: int, percent: int) -> DataFrame:
    """The distinct lines of enough words: key, first place, n, parities, prefix and extremes.

    A word's code is its rarity level, then 27 bits of its hash.
    """
    rarity = _rarity(texts)
    hashed = _lines(texts).select(*_KEY, *_PLACE, _word_hashes(F.col("text")).alias("hashes"))

    def code(h: Column) -> Column:
        level = F.shiftleft(F.get(rarity, _counter(h)), 27)
        # Numbers that cannot be null are sorted as such, not as objects.
        return F.coalesce(level.bitwiseOR(F.shiftrightunsigned(h, 37).cast("int")), F.lit(0))

    n = F.size("hashes")
    prefix = F.slice(F.sort_array(F.transform("hashes", code)), F.lit(1), n - _needed(n, percent) + 1)
    # The place of a zero among the sorted hashes: those before it are below zero.
    middle = F.array_position(F.sort_array(F.array_append("hashes", F.lit(0).cast("long"))), F.lit(0).cast("long")).cast("int")
    hashed = hashed.select(*_KEY, *_PLACE, "hashes", prefix.alias("prefix"), middle.alias("middle"))
    high = _parities(F.slice("hashes", F.lit(1), F.col("middle") - 1))
    low = _parities(F.slice("hashes", F.col("middle"), n))
    # Lines of one or two words have fewer extremes, or they would all share the one of no word.
    ends = [F.xxhash64(F.get("hashes", F.lit(i)), F.get("hashes", n - 1 - i), F.lit(i)) for i in range(3)]
    extremes = F.slice(F.array(*ends), F.lit(1), F.least(n, F.lit(3)))
    row = F.struct(*_PLACE, n.alias("n"), low.alias("low"), high.alias("high"), F.col("prefix"), extremes.alias("extremes"))
    classes = hashed.select(*_KEY, row.alias("row")).groupBy(*_KEY).agg(F.min("row").alias("row"))
    # Not earlier: a test of the size before the grouping would have the words split twice.
    return classes.where(F.col("row.n") >= min_words).select(*_KEY, "row.*")


def _parities_allow(percent: int, dot: str = "_") -> Column:
    """Whether parities allow a match of a and b: each word that only one of them has flips a bit."""
    flipped = [F.bit_count(F.col(f"a{dot}{half}").bitwiseXOR(F.col(f"b{dot}{half}"))).cast("double") for half in ("low", "high")]
    both = F.col(f"a{dot}n").cast("double") + F.col(f"b{dot}n").cast("double")  # doubles are not checked for overflow
    return (100.0 + percent) * (flipped[0] + flipped[1]) <= (100.0 - percent) * both


def _may_match(percent: int, dot: str = "_") -> Column:
    """Whether lengths and parities allow a match of a and b."""
    a, b = F.col(f"a{dot}n"), F.col(f"b{dot}n")
    return (100 * F.least(a, b) >= percent * F.greatest(a, b)) & _parities_allow(percent, dot)


_PAIR = ["a_doc_id", "a_line", "b_doc_id", "b_line"]


def _named(df: DataFrame, side: str, *columns: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{side}_{c}") for c in columns])


def _earlier(dot: str = "_") -> Column:
    a, b = ([F.col(f"{side}{dot}{c}") for c in _PLACE] for side in "ab")
    return (a[0] < b[0]) | ((a[0] == b[0]) & (a[1] < b[1]))


def _with_earliest(classes: DataFrame, percent: int) -> DataFrame:
    """Each class with the earliest of those that share an extreme with it."""
    columns = [*_PLACE, "n", "low", "high"]
    entries = classes.select(*columns, F.explode("extremes").alias("key"))
    # A window, not a join with the earliest: the entries are moved once.
    by_key = Window.partitionBy("key").orderBy(*_PLACE)
    sides = [F.first(c).over(by_key).alias(f"a_{c}") for c in columns] + [F.col(c).alias(f"b_{c}") for c in columns]
    return entries.select(*sides).where(_earlier() & _may_match(percent)).select(*_PAIR).distinct()


def _entries(classes: DataFrame, percent: int, *more: str) -> DataFrame:
    """A row for each prefix word of each class: (doc_id, line, n, low, high, open, most, code) and ``more``.

    ``most`` is the largest n of a line that may match by this word: with the words from here on, ``rest``,
    as the overlap, (100 + percent) * rest >= percent * (n + most). It bounds the lengths, too.
    """
    columns = [*_PLACE, "n", "low", "high", "open", *more]
    placed = classes.select(*columns, F.posexplode("prefix").alias("at", "code"))
    most = F.floor((100 + percent) * (F.col("n") - F.col("at")) / max(percent, 1)).cast("int") - F.col("n")
    placed = placed.withColumn("most", most if percent else F.lit(2**31 - 1))
    # None of these is null; said here, the joins do not ask that of every pair.
    return placed.select("doc_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in [*columns[1:], "most", "code"]])


def _side(entries: DataFrame, side: str) -> DataFrame:
    return _named(entries, side, "code", *_PLACE, "n", "low", "high", "open", "most")


def _candidates(percent: int, dot: str = "_") -> Column:
    """Whether an open b may match the earlier a by a word of the prefixes that both have."""
    a, b = ({c: F.col(f"{side}{dot}{c}") for c in ("code", "n", "most", "open")} for side in "ab")
    bounds = (a["n"] <= b["most"]) & (b["n"] <= a["most"])  # the cheapest first
    # b must be open; said of both sides, so that both read the same shuffle.
    opened = 2 * b["open"] + a["open"] >= 2
    return (a["code"] == b["code"]) & bounds & _earlier(dot) & _parities_allow(percent, dot) & opened


def _marked(classes: DataFrame, gone: DataFrame) -> DataFrame:
    """``classes`` with ``open``, 0 for those ``gone`` and 1 for all others."""
    # Only classes that the filter takes for gone are moved.
    maybe = _in_filter(gone, *_PLACE, packed=PACKED_CODES)
    joined = classes.where(maybe).join(gone.withColumn("gone", F.lit(1)), _PLACE, "left")
    joined = joined.withColumn("open", F.when(F.col("gone").isNull(), 1).otherwise(0)).drop("gone")
    return classes.where(~maybe).withColumn("open", F.lit(1)).unionByName(joined)


def _size_step(n: Column) -> Column:
    return F.floor(2 * F.log2(n)).cast("int")


def _sharing_prefix(classes: DataFrame, gone: DataFrame, percent: int) -> DataFrame:
    """The entries that make a candidate pair at their own code, on either side of it. Settled.

    Classes not ``gone`` are open; only they are the later one of a pair.
    """
    marked = _marked(classes, gone)
    entries = _entries(marked, percent)
    # Aliases, not new names: the optimizer moves names on one side only, and the sides would be shuffled apart.
    asking = settle(entries.alias("b").join(entries.alias("a"), _candidates(percent, "."), "left_semi"), "line-asking")
    # Few entries ask, so few pass a filter of their codes with the sizes that match theirs, and are moved.
    least, most = F.ceil(F.col("n") * percent / 100), F.floor(F.col("n") * 100 / max(percent, 1))
    steps = F.explode(F.sequence(_size_step(F.greatest(least, F.lit(1))), _size_step(most))).alias("step")
    asked = asking.select("code", steps).distinct()
    stepped = _entries(marked.withColumn("step", _size_step(F.col("n"))), percent, "step")
    near = stepped.where(_in_filter(asked, "code", "step", packed=PACKED_CODES))
    answers = near.drop("step").alias("a").join(asking.alias("b"), _candidates(percent, "."), "left_semi")
    return settle(asking.unionByName(answers).distinct(), "line-entries")


def _late_by_prefix(texts: DataFrame, entries: DataFrame, percent: int) -> DataFrame:
    """The places of open ``entries`` whose words match those of an earlier one; settled."""
    words = _words(texts, settle(entries.select(*_PLACE).distinct(), "line-places"))
    first = F.min(F.struct(*_PLACE, "n", "low", "high", "open", "most")).alias("first")
    late = []
    for number in range(ROUNDS + 1):
        asked = entries
        if 0 < number < ROUNDS:
            asked = entries.where("open = 1")  # the earliest of all have been asked
        if number < ROUNDS:
            asked = asked.groupBy("code").agg(first).select("code", "first.*")
        pairs = _side(asked, "a").join(_side(entries.where("open = 1"), "b"), _candidates(percent)).select(*_PAIR).distinct()
        late.append(_verified(pairs, words, percent))
        found = late[-1].withColumn("late", F.lit(1))
        if number < ROUNDS:
            left = entries.join(found, _PLACE, "left").withColumn("open", F.when(F.col("late").isNull(), F.col("open")).otherwise(0))
            entries = settle(left.drop("late"), "line-entries")
    return functools.reduce(DataFrame.union, late)


def _in_filter(names: DataFrame, *columns: str, packed: int = PACKED) -> Column:
    """A test of ``columns`` that lets all of ``names`` through, and of others few while the filter is sparse."""
    cell = F.xxhash64(*columns).bitwiseAND(packed * 64 - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), cell.bitwiseAND(63).cast("int"))
    at = F.shiftright(cell, 6).cast("int")
    # One row, written, and a subquery in the plan: no number passes through Python or the plan's text.
    every = names.sparkSession.range(0, packed, 1, 1).select(F.col("id").cast("int").alias("at"), F.lit(0).cast("long").alias("bits"))
    cells = names.select(at.alias("at"), bit.alias("bits")).union(every).groupBy("at").agg(F.bit_or("bits").alias("bits"))
    table = cells.agg(F.sort_array(F.collect_list(F.struct("at", "bits")))["bits"].alias("table"))
    return F.get(settle(table, "line-filter").scalar(), at).bitwiseAND(bit) != 0


def _words(texts: DataFrame, places: DataFrame) -> DataFrame:
    """(doc_id, line, words, n) of the ``places``, which are settled; settled."""
    # The join moves these lines and few others, never whole texts.
    near = texts.where(_in_filter(places, "doc_id"))
    lines = near.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    lines = lines.where(_in_filter(places, "doc_id", "line"))
    words = lines.join(places, _PLACE).distinct().select(*_PLACE, line_words(F.col("text")).alias("words"))
    return settle(words.select(*_PLACE, "words", F.size("words").alias("n")), "line-words")


def _verified(pairs: DataFrame, words: DataFrame, percent: int) -> DataFrame:
    """The later places of the ``pairs`` whose ``words`` match; settled."""
    sets = pairs
    for side in "ab":
        sets = sets.join(_named(words, side, *_PLACE, "words", "n"), [f"{side}_doc_id", f"{side}_line"])
    # common >= percent / 100 * (a + b - common), with what is costly in one place only.
    common = F.size(F.array_intersect("a_words", "b_words"))
    match = (100 + percent) * common >= percent * (F.col("a_n") + F.col("b_n"))
    later = sets.where(match).select(F.col("b_doc_id").alias("doc_id"), F.col("b_line").alias("line"))
    return settle(later.distinct(), "late-lines")


def _matching(texts: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The later places of the ``pairs`` whose words match; settled."""
    sides = [pairs.select(F.col(f"{s}_doc_id").alias("doc_id"), F.col(f"{s}_line").alias("line")) for s in "ab"]
    return _verified(pairs, _words(texts, settle(sides[0].union(sides[1]).distinct(), "line-places")), percent)


def removed_lines(texts: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, line) of the lines that match an earlier one. ``texts`` has (doc_id, text) and no null ids."""
    classes = settle(_classes(texts, min_words, percent), "line-classes")
    gone = _matching(texts, settle(_with_earliest(classes, percent), "line-pairs"), percent)
    more = _late_by_prefix(texts, _sharing_prefix(classes, gone, percent), percent)
    # Of a class that matches an earlier one all lines go, of another all but the first.
    late = gone.union(more).withColumn("gone", F.lit(True))
    firsts = classes.select(*_KEY, *_PLACE).join(late, _PLACE, "left")
    firsts = firsts.select(*_KEY, F.when(F.col("gone").isNull(), F.struct(*_PLACE)).alias("stays"))
    lines = _lines(texts).select(*_PLACE, *_KEY).join(firsts, _KEY)
    goes = F.coalesce((F.col("doc_id") != F.col("stays.doc_id")) | (F.col("line") != F.col("stays.line")), F.lit(True))
    return lines.where(goes).select(*_PLACE).distinct()


def line_report(docs: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed) for every row of ``docs``; ``removed`` are line numbers from 0.

    A null text has no lines, an empty one has one. Lines of fewer than ``min_words``
    distinct words stay. Rows that repeat an id are one document; each is returned, and a
    line of one that stands first stays in all of them. Rows with a null id are not compared
    and keep all lines. Only doc_id and text are read. An empty table stays empty.
    """
    rows = docs.select("doc_id", "text")
    removed = removed_lines(rows.where("doc_id is not null"), min_words, percent)
    listed = removed.groupBy("doc_id").agg(F.array_sort(F.collect_list("line")).alias("removed"))
    listed = listed.select(F.col("doc_id").alias("id"), "removed")
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    sizes = rows.select("doc_id", F.coalesce(breaks + 1, F.lit(0)).alias("n_lines"))
    joined = sizes.join(listed, F.col("doc_id") == F.col("id"), "left")
    own = F.filter(F.coalesce("removed", F.array().cast("array<int>")), lambda line: line < F.col("n_lines"))
    return joined.select("doc_id", "n_lines", own.alias("removed")).select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.size("removed").cast("long").alias("n_removed"), "removed"
    )


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the removed lines, all columns; ``n_chars``, if there, counts what remains.

    A document that loses all its lines goes; one that had no words from the start stays.
    """
    removed = removed_lines(docs.select("doc_id", "text").where("doc_id is not null"), min_words, percent)
    key, gone = free_name(docs, "document"), free_name(docs, "gone")
    listed = removed.groupBy(F.col("doc_id").alias(key)).agg(F.collect_list("line").alias(gone))
    joined = docs.join(listed, F.col("doc_id") == F.col(key), "left")
    kept = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains(gone, i))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    whole = joined.withColumn("text", text).where(F.col(gone).isNull() | F.col("text").rlike(r"\S"))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        whole = whole.withColumn("n_chars", F.when(F.col(gone).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return whole.select(*docs.columns)
