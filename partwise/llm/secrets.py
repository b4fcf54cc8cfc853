"""Secret scan over a trigram inverted index, in DataFrame functions only.

From each rule's regular expression follows a Boolean query over trigrams that every match
must hold: a conjunction of parts, each a choice between sets of trigrams. The index has a
posting (trigram, document) for every trigram that some query names; postings are
intersected per choice, and the documents that satisfy a query are scanned for its rule. A
rule without a mandatory trigram is scanned in every document.

Trigrams are compared without regard to case, so a query may let through too much but never
too little; the regular expression itself decides.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_parser = re._parser
#: Strings that one part of an expression may expand to before it is cut.
CHOICES = 64


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int = 0  # matches whose group is shorter than ``least`` are dropped
    least: int = 0


BASE = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    # A run of 24 or 16 and more is the whole run that one and more would match.
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
]
MORE = [
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
]

Clause = frozenset  # trigrams that occur together


def _strings(items) -> list[set[str] | None]:
    """For each element of a sequence the strings it matches, lower-cased; None if not a small set."""
    out: list[set[str] | None] = []
    for op, arg in items:
        name = str(op)
        if name == "LITERAL":
            out.append({chr(arg).lower()})
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
            out.append({chr(a).lower() for _, a in arg})
        elif name == "SUBPATTERN":
            out += _strings(arg[3])
        elif name == "BRANCH":
            ways = [_product(_strings(way)) for way in arg[1]]
            out.append(None if None in ways else set().union(*ways))
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, inner = arg
            once = _product(_strings(inner))
            if once is not None and low == high and low <= 4:
                out += [once] * low
            elif once is not None and (low, high) == (0, 1):
                out.append(once | {""})
            else:
                if once is not None and low:
                    out.append(once)
                out.append(None)
        elif name in ("AT", "ASSERT", "ASSERT_NOT"):
            out.append({""})
        else:
            out.append(None)
    return out


def _product(parts: list[set[str] | None]) -> set[str] | None:
    whole = {""}
    for part in parts:
        if part is None or len(whole) * len(part) > CHOICES:
            return None
        whole = {a + b for a in whole for b in part}
    return whole


def _clauses(strings: set[str]) -> list[Clause]:
    """One set of trigrams for each string, without sets that hold another; none if a string is too short."""
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    if frozenset() in sets:
        return []
    return sorted((s for s in sets if not any(other < s for other in sets)), key=sorted)


def trigram_query(pattern: str) -> list[list[Clause]]:
    """Parts that must all hold, each a list of choices; empty if nothing is mandatory."""
    query, open_strings = [], {""}
    for part in [*_strings(_parser.parse(pattern)), None]:
        fits = part is not None and len(open_strings) * len(part) <= CHOICES
        if not fits:
            query.append(_clauses(open_strings))
            open_strings = {""}
        if part is not None:
            open_strings = {a + b for a in open_strings for b in part} if len(part) <= CHOICES else {""}
    return [choices for choices in query if choices]


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc_id) for the ``trigrams`` that a text holds in either case."""
    low = docs.select("doc_id", F.lower("text").alias("low"))
    present = F.array_compact(F.array(*[F.when(F.col("low").contains(t), F.lit(t)) for t in trigrams]))
    return low.select(F.explode(present).alias("trigram"), "doc_id").distinct()


def candidates(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """(doc_id, rules): the documents that satisfy a rule's trigram query, with those rules."""
    spark = docs.sparkSession
    wanted, parts = [], []
    for rule in rules:
        query = trigram_query(rule.pattern)
        parts.append((rule.kind, len(query)))
        for part, choices in enumerate(query):
            wanted += [
                (rule.kind, part, choice, trigram, len(clause))
                for choice, clause in enumerate(choices)
                for trigram in sorted(clause)
            ]
    if not wanted:
        return spark.createDataFrame([], f"doc_id {dict(docs.dtypes)['doc_id']}, rules array<string>")
    clauses = spark.createDataFrame(wanted, "kind string, part int, choice int, trigram string, size int")
    needed = spark.createDataFrame(parts, "rule string, parts int")
    index = postings(docs, sorted({row[3] for row in wanted}))
    # The clauses come from the rules, not from the data: a few dozen rows.
    met = (
        index.join(F.broadcast(clauses), "trigram")
        .groupBy("doc_id", "kind", "part", "choice", "size")
        .agg(F.count("*").alias("held"))
        .where("held = size")
    )
    whole = met.groupBy("doc_id", "kind").agg(F.countDistinct("part").alias("met"))
    whole = whole.join(F.broadcast(needed), (F.col("kind") == F.col("rule")) & (F.col("met") == F.col("parts")))
    return whole.groupBy("doc_id").agg(F.collect_set("kind").alias("rules"))


#: Matches that are placed together; an array that grows by one is copied each time.
_BLOCK = 256
_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """All matches of the rule as (start, kind, end) in code points, leftmost and not overlapping.

    Splitting at the matches gives the texts between them; with the matches' own lengths
    these add up to the places.
    """
    pattern = F.lit(rule.pattern)
    between = F.transform(F.split(text, rule.pattern, -1), F.length)
    lengths = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    tested = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    steps = F.arrays_zip(F.slice(between, 1, F.size(lengths)).alias("skip"), lengths.alias("size"), tested.alias("tested"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("found"))

    def step(state: Column, item: Column) -> Column:
        begin = state["at"] + item["skip"]
        end = begin + item["size"]
        span = F.struct(begin.alias("start"), F.lit(number).alias("kind"), end.alias("end"))
        found = F.when(item["tested"] >= rule.least, F.array_append(state["found"], span)).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    def in_blocks(steps: Column) -> Column:
        """Spans by blocks of matches, each from 0, and where each block starts: work in proportion to the matches."""
        firsts = F.sequence(F.lit(1), F.size(steps), F.lit(_BLOCK))
        return F.transform(firsts, lambda first: F.aggregate(F.slice(steps, first, _BLOCK), start, step))

    def placed(blocks: Column) -> Column:
        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))

        def pass_block(state: Column, block: Column) -> Column:
            starts = F.array_append(state["starts"], state["at"])
            return F.struct((state["at"] + block["at"]).alias("at"), starts.alias("starts"))

        starts = F.aggregate(blocks, none, pass_block, lambda state: state["starts"])

        def shifted(block: Column, at: Column) -> Column:
            return F.transform(
                block["found"],
                lambda s: F.struct((s["start"] + at).alias("start"), s["kind"].alias("kind"), (s["end"] + at).alias("end")),
            )

        return F.flatten(F.zip_with(blocks, starts, shifted))

    # A transform over one element binds what is used more than once.
    bound = F.transform(F.array(steps), lambda each: F.when(F.size(each) > 0, in_blocks(each)))
    return F.coalesce(F.transform(bound, placed)[0], F.array().cast(_SPANS))


def find_secrets(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """(doc_id, found) for every row of ``docs``: its spans by start, then by the rules' order.

    ``found`` is an array of (start, kind, end); ``kind`` counts the rules from 0, places
    are code points, the end exclusive. Rules look for matches each by themselves, leftmost
    and not overlapping; a match that is too short by its rule is dropped but still takes
    its place. A null or empty text has no spans; repeated rows and rows with a null id are
    scanned like others; only doc_id and text are read. An empty table stays empty.
    """
    rules = [*BASE, *MORE] if rules is None else rules
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = candidates(texts, rules).withColumnRenamed("doc_id", "candidate")
    marked = texts.join(found, F.col("doc_id").eqNullSafe(F.col("candidate")), "left")
    spans = []
    for number, rule in enumerate(rules):
        scans = F.col("text").rlike(rule.pattern)
        if trigram_query(rule.pattern):
            scans = F.coalesce(F.array_contains("rules", rule.kind), F.lit(False)) & scans
        spans.append(F.when(scans, _spans(F.col("text"), rule, number)).otherwise(F.array().cast(_SPANS)))
    return marked.select("doc_id", F.array_sort(F.concat(*spans)).alias("found"))


def as_text(found: Column, rules: list[Rule]) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )
