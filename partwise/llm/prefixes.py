"""The prefix trie of conversations, with subtree totals by centroid decomposition.

A turn is known by the SHA-256 digest of its role and text, a prefix by a digest over the
digests of its turns; from there on no text is moved. Prefixes are made in blocks of
``BLOCK`` turns: a conversation's blocks are rows of their own, and the digests of whole
blocks are in turn a shorter sequence whose prefixes are made the same way. So no
conversation has to fit one group, however many turns it has, and turns are numbered by a
distributed sort. All that share a prefix are one node, counted with map-side combining.

Totals over subtrees come from the forest of parent edges below the root. A component is
split at its centroid: the deepest node that holds more than half of the component's weight
below it. What hangs on the centroid, added up, is added to every node on the path from the
centroid to the component's top; then the parts go on by themselves. A part weighs at most
half, so the rounds grow with the logarithm of the weight, however deep the trie is. A
node weighs as many conversations as run through it: the weight below a node is known when
the nodes are counted, and a split only changes it on that path. Components above ``LIGHT``
are split in Spark, all of them in one round, by joins; lighter ones by the same rule on
arrays, some thousands at a time in a task.

A hot first turn, or a hot parent, is the repeated key of an equi-join whose other side has
one row for it, which adaptive execution splits. No cap, no broadcast by hand.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partwise.llm.common import settle

#: Turns that are digested in one row.
BLOCK = 64
#: A component of at most this weight is rolled up by one task, with others.
LIGHT = 1 << 16
#: Nodes that a task rolls up together, but for the component they end in.
TOGETHER = 1 << 17
#: The conversations of one node are listed by pieces of 2 to this many neighbouring ids.
PIECE_BITS = 12
_TURN = ("no", "digest", "bytes", "length")


def _root() -> Column:
    """The key of the root, and where the digests of a block start."""
    return F.lit(bytes(16))


def _digest(*parts: Column) -> Column:
    """The first 128 bits of SHA-256."""
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def digest_turns(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv, no, digest, bytes, length): the turns of every conversation, numbered from 1, without their text.

    ``bytes`` are those of the text, ``length`` is the conversation's number of turns.
    Turns go by ``turn_col``, null first; equal ones by their digest, so that the order of
    rows does not matter, and repeated rows count as often as they occur. A null role or
    text counts as empty. Rows without a conversation are left out; other columns are not read.

    The numbers come from a sort over all tasks and an offset per task and conversation:
    a conversation may lie on any number of tasks.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")).cast("binary") for c in (role_col, text_col))
    length = F.octet_length(role).cast("string").cast("binary")
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        _digest(length, F.lit(b":"), role, text).alias("digest"),
        F.octet_length(text).alias("bytes"),
    )
    ordered = turns.repartitionByRange("conv", "turn", "digest").sortWithinPartitions("conv", "turn", "digest")
    # The id holds the task above bit 33 and counts the task's rows below.
    ordered = settle(ordered.select("conv", "digest", "bytes", F.monotonically_increasing_id().alias("at")), "turns")
    task = F.shiftright("at", 33)
    pieces = ordered.groupBy("conv", task.alias("task")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1
    length = F.sum("n").over(Window.partitionBy("conv"))
    offsets = pieces.select("conv", "task", shift.alias("shift"), length.alias("length"))
    placed = ordered.withColumn("task", task).join(offsets, ["conv", "task"])
    return placed.select("conv", (F.col("at") + F.col("shift")).alias("no"), "digest", "bytes", "length")


def splice_heads(turns: DataFrame, base: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Every conversation behind the first turns of another one: its turns, and all conversations.

    ``turns`` are those of :func:`digest_turns`. Conversation ``conv`` becomes the first
    ``head`` turns (0 to ``most``) of conversation ``base``, fewer if that has fewer, none if
    it does not occur, and then its own turns after its first ``head``. Both are expressions
    over ``conv``. The second result lists every conversation, those left without a turn too.
    """
    counts = turns.where("no = 1").select("conv", F.col("length").alias("n"))
    known = counts.select("conv", "n", base.alias("base"), head.alias("head"))
    of_base = counts.select(F.col("conv").alias("base"), F.least("n", F.lit(most)).alias("base_n"))
    taken = F.least("head", F.coalesce("base_n", F.lit(0)))
    length = F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0))
    known = known.join(of_base, "base", "left").withColumn("taken", taken)
    known = settle(known.select("conv", "base", "head", "taken", length.alias("length")), "conversations")
    own = turns.drop("length").join(known.drop("base"), "conv").where("no > head")
    own = own.withColumn("no", F.col("no") - F.col("head") + F.col("taken")).select("conv", *_TURN)
    first = turns.where(F.col("no") <= most).select(F.col("conv").alias("base"), "no", "digest", "bytes")
    heads = first.join(known.where("taken > 0"), "base").where("no <= taken").select("conv", *_TURN)
    return own.unionByName(heads), known.select("conv")


def _prefixes(sequence: DataFrame, longest: int, block: int) -> DataFrame:
    """``sequence`` (conv, no, digest, bytes, length) with the digests of the prefixes: ``key``, ``parent`` and ``top``.

    ``key`` is that of the first ``no`` elements, ``parent`` that of one less, ``top`` that of
    the first. Within a block digests are chained from a fixed start; a later block's ones are
    combined with the key of the blocks before it.
    """

    def chained(state: Column, element: Column) -> Column:
        link = F.struct(
            *(element[name].alias(name) for name in _TURN),
            _digest(state["key"], element["digest"]).alias("key"),
            state["key"].alias("parent"),
        )
        return F.struct(link["key"].alias("key"), F.array_append(state["links"], link).alias("links"))

    elements = F.sort_array(F.collect_list(F.struct(*_TURN)))
    none = F.array().cast("array<struct<no:bigint,digest:binary,bytes:int,length:bigint,key:binary,parent:binary>>")
    number = F.floor((F.col("no") - 1) / block).alias("block")
    blocks = sequence.select("conv", number, *_TURN).groupBy("conv", "block").agg(elements.alias("elements"))
    start = F.struct(_root().alias("key"), none.alias("links"))
    blocks = blocks.select("conv", "block", F.aggregate("elements", start, chained).alias("chain"))
    if longest <= block:
        top = F.get("chain.links", F.lit(0))["key"]
        links = blocks.select("conv", top.alias("top"), F.inline("chain.links"))
        return links.select("conv", *_TURN, "key", "parent", "top")
    blocks = settle(blocks, "blocks")
    whole = F.col("chain.key").alias("digest")
    wholes = blocks.select("conv", (F.col("block") + 1).alias("no"), whole, F.lit(0).alias("bytes"), F.lit(0).cast("long").alias("length"))
    over = _prefixes(wholes, -(-longest // block), block)
    # Block j comes after the j-th element of ``over``: its start, and the key of the turn before it.
    ends = F.when(F.col("no") == 1, F.col("digest")).otherwise(_digest(F.col("parent"), F.col("digest")))
    befores = over.select("conv", F.col("no").alias("block"), F.col("key").alias("begin"), ends.alias("before"))
    tops = blocks.where("block = 0").select("conv", F.get("chain.links", F.lit(0))["key"].alias("top"))
    placed = blocks.join(befores, ["conv", "block"], "left").join(tops, "conv")
    links = placed.select("conv", "block", "begin", "before", "top", F.inline("chain.links"))

    def after_begin(key: str) -> Column:
        return F.when(F.col("block") == 0, F.col(key)).otherwise(_digest(F.col("begin"), F.col(key)))

    first = (F.col("block") > 0) & (F.col("no") == F.col("block") * block + 1)
    parent = F.when(first, F.col("before")).otherwise(after_begin("parent"))
    return links.select("conv", *_TURN, after_begin("key").alias("key"), parent.alias("parent"), "top")


def _hash_lists(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 over each node's conversations, ascending, with commas between them.

    Ids are listed by pieces of neighbours in any task; a node's pieces are then
    hashed one after another as they come from the sort.
    """
    listed = F.array_join(F.sort_array(F.collect_list("conv")), ",").alias("ids")
    pieces = ends.groupBy("key", F.shiftright("conv", PIECE_BITS).alias("piece")).agg(listed)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, hashlib.sha256()
        for batch in batches:
            keys, digests = [], []
            for now, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if now == key:
                    state.update(b",")
                else:
                    if key is not None:
                        keys.append(key)
                        digests.append(state.hexdigest())
                    key, state = now, hashlib.sha256()
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])

    in_order = pieces.repartition("key").sortWithinPartitions("key", "piece").select("key", "ids")
    return in_order.mapInArrow(hashed, "key binary, ends_sha256 string")


class Forest:
    """Trees as arrays: ``parent`` is -1 at a top, ``weight`` is that of the node and all below it.

    ``roll_up`` takes the trees apart at their centroids, all in the same rounds.
    """

    def __init__(self, parent: np.ndarray, depth: np.ndarray, weight: np.ndarray):
        self.parent, self.depth, self.weight = parent, depth, weight.copy()

    def _tops(self, nodes: np.ndarray, top: np.ndarray) -> None:
        """Let ``top`` lead every one of ``nodes`` to its part's top; it holds a step that way."""
        while len(nodes):
            further = top[top[nodes]]
            moved = further != top[nodes]
            top[nodes] = further
            nodes = nodes[moved]

    def roll_up(self, own: np.ndarray) -> np.ndarray:
        """For each column of ``own`` its sums over subtrees."""
        n = len(self.parent)
        sums = np.zeros_like(own)
        here = np.arange(n)
        top = np.where(self.parent < 0, here, self.parent)
        self._tops(here, top)
        while len(here):
            heavy = here[2 * self.weight[here] > self.weight[top[here]]]
            deepest = np.full(n, -1, np.int64)
            np.maximum.at(deepest, top[heavy], self.depth[heavy] * n + heavy)
            tops = here[top[here] == here]
            centroid = deepest[tops] % n
            of = np.full(n, -1, np.int64)  # the centroid of the part with this top
            of[tops] = centroid
            cut = of[top[here]]
            # Parts after the cut: below each child of the centroid, and what is left above.
            child = self.parent[here] == cut
            step = np.where(child | (top[here] == here) | (here == cut), here, self.parent[here])
            after = top.copy()
            after[here] = step
            self._tops(here, after)
            under = (after[here] != top[here]) | (here == cut)
            totals = np.zeros((n, own.shape[1]), own.dtype)
            np.add.at(totals, top[here[under]], own[here[under]])
            self._add_on_paths(sums, totals, tops, centroid)
            top = after
            here = here[here != cut]
        return sums

    def _add_on_paths(self, sums: np.ndarray, totals: np.ndarray, tops: np.ndarray, centroid: np.ndarray) -> None:
        at, lost = centroid, self.weight[centroid]
        while len(at):
            sums[at] += totals[tops]
            above = at != tops
            at, tops, lost = self.parent[at[above]], tops[above], lost[above]
            self.weight[at] -= lost


def _index_of_parents(comp: np.ndarray, conv: np.ndarray, depth: np.ndarray, parent_conv: np.ndarray) -> np.ndarray:
    """The row of each node's parent in the same component, or -1."""
    convs, numbered = np.unique(conv, return_inverse=True)
    at = np.minimum(np.searchsorted(convs, parent_conv), len(convs) - 1)
    code = depth * len(convs) + numbered
    wanted = np.where(convs[at] == parent_conv, (depth - 1) * len(convs) + at, -1)
    order = np.argsort(code)
    place = order[np.minimum(np.searchsorted(code, wanted, sorter=order), len(code) - 1)]
    return np.where((code[place] == wanted) & (comp[place] == comp), place, -1)


_SUMS = ["n_leaves", "saved_tokens"]


def _roll_up_light(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``n_leaves`` and ``saved_tokens`` of their subtrees within their component."""

    def roll(table: pa.Table) -> pa.Table:
        conv, depth, parent_conv, weight, leaf, saved = (
            table[name].to_numpy().astype(np.int64) for name in ("conv", "depth", "parent_conv", "weight", "leaf", "saved")
        )
        comp = table["comp"].combine_chunks().dictionary_encode().indices.to_numpy()
        forest = Forest(_index_of_parents(comp, conv, depth, parent_conv), depth, weight)
        sums = forest.roll_up(np.stack([leaf, saved], axis=1))
        for i, name in enumerate(_SUMS):
            table = table.append_column(name, pa.array(sums[:, i]))
        return table

    def rolled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for batch in batches:
            if len(batch) and rows + len(batch) >= TOGETHER:
                # A component goes on as long as its name does.
                names = batch.column("comp")
                last = names.slice(len(names) - 1, 1).to_pylist()[0]
                cut = next((i for i in range(len(batch), 0, -1) if names[i - 1].as_py() != last), 0)
                if cut or (waiting and waiting[-1].column("comp")[-1].as_py() != last):
                    yield from roll(pa.Table.from_batches([*waiting, batch.slice(0, cut)])).to_batches()
                    waiting, rows, batch = [], 0, batch.slice(cut)
            waiting.append(batch)
            rows += len(batch)
        if rows:
            yield from roll(pa.Table.from_batches(waiting)).to_batches()

    fields = [*nodes.schema.fields, *(T.StructField(name, T.LongType()) for name in _SUMS)]
    return nodes.repartition("comp").sortWithinPartitions("comp").mapInArrow(rolled, T.StructType(fields))


def _split_heavy(nodes: DataFrame, paths: DataFrame, light: int) -> tuple[DataFrame, list[DataFrame]]:
    """Take the components of ``nodes`` apart in Spark until none weighs more than ``light``.

    ``paths`` has a row for every conversation through a node, with the node's own. Gives
    the nodes with new components and weights, and the (key, n_leaves, saved_tokens) that
    the cuts add to single nodes.
    """
    adds: list[DataFrame] = []
    done: list[DataFrame] = []
    open_ = settle(nodes, "heavy")
    while not open_.isEmpty():
        total = open_.groupBy("comp").agg(F.max("weight").alias("total"))
        halves = open_.join(total, "comp").where("2 * weight > total").groupBy("comp")
        cut = halves.agg(F.max_by(F.struct("conv", "depth", "weight"), "depth").alias("cut"))
        below = F.col("depth") > F.col("cut.depth")
        met = open_.join(cut, "comp").withColumns(
            {
                "at_conv": F.when(below, F.col("conv")).otherwise(F.col("cut.conv")),
                "at_depth": F.when(below, F.col("cut.depth") + 1).otherwise(F.col("depth")),
            }
        )
        # Below: the node's own path at the depth under the cut. Above: the cut's path at the node's depth.
        met = met.join(paths, ["at_conv", "at_depth"], "left")
        is_cut = (F.col("depth") == F.col("cut.depth")) & (F.col("conv") == F.col("cut.conv"))
        under = F.coalesce(below & (F.col("at_parent") == F.col("cut.conv")), F.lit(False))
        on_path = F.coalesce(~below & (F.col("at_node") == F.col("conv")), F.lit(False))
        met = settle(
            met.select(
                *nodes.columns, F.col("cut.weight").alias("lost"), is_cut.alias("is_cut"), under.alias("under"),
                on_path.alias("on_path"), F.when(under, F.col("at_key")).otherwise(F.col("comp")).alias("part"),
            ),
            "cut",
        )
        sums = met.where("under or is_cut").groupBy("comp").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
        adds.append(met.where("on_path").join(sums, "comp").select("key", *_SUMS))
        weight = F.when(F.col("on_path"), F.col("weight") - F.col("lost")).otherwise(F.col("weight"))
        # All that a centroid holds below it is among the sums: nothing is left to roll up.
        alone = {"comp": F.col("key"), "leaf": F.lit(0).cast("long"), "saved": F.lit(0).cast("long")}
        done.append(met.where("is_cut").withColumns(alone).select(*nodes.columns))
        parts = met.where("not is_cut").withColumns({"comp": F.col("part"), "weight": weight}).select(*nodes.columns)
        sizes = parts.groupBy("comp").agg((F.max("weight") > light).alias("is_heavy"))
        parts = settle(parts.join(sizes, "comp"), "parts")
        done.append(parts.where("not is_heavy").drop("is_heavy"))
        open_ = parts.where("is_heavy").drop("is_heavy")
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result, adds


def prefix_trie(turns: DataFrame, convs: DataFrame | None = None, light: int = LIGHT, block: int = BLOCK) -> DataFrame:
    """The nodes of the trie of all conversations' turn sequences, with counts and subtree totals.

    ``turns`` has (conv, no, digest, bytes, length), as :func:`digest_turns` gives it; ``convs`` lists
    conversations that may have no turn. Per node, the textless root included: ``conv_id``,
    the smallest conversation that starts with it; ``depth``; ``parent_conv_id``, that of its
    parent (root: null); ``n_convs``; ``n_children``; ``n_leaves``, the childless nodes of its
    subtree; ``saved_tokens``, the sum over its subtree of (n_convs - 1) times the bytes of
    the last text; ``ends_sha256``, over the conversations that end in it. Without any
    conversation there is no node; without any turn the root is the one leaf.
    """
    turns = settle(turns, "sequences")
    longest = turns.agg(F.max("no")).head()[0] or 0
    rows = settle(_prefixes(turns, longest, block).drop("digest"), "prefixes")
    counted = rows.groupBy("key").agg(
        F.min("conv").alias("conv"),
        F.max("no").alias("depth"),
        F.max("parent").alias("parent"),
        F.max("top").alias("comp"),
        F.count("*").alias("n_convs"),
        F.max("bytes").alias("bytes"),
        F.sum(F.col("length") - F.col("no") + 1).alias("weight"),
    )
    counted = settle(counted, "nodes")
    everyone = turns.where("no = 1").select("conv") if convs is None else convs.select("conv").distinct()
    first = everyone.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"))
    children = counted.groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    parents = counted.select("key", "conv").unionByName(first.select(_root().alias("key"), "conv"))
    parents = parents.select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv"))
    nodes = counted.join(children, "key", "left").join(parents, "parent").select(
        "key",
        "conv",
        "depth",
        "parent_conv",
        "comp",
        "n_convs",
        "weight",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    )
    nodes = settle(nodes, "forest")

    heavy = nodes.where((F.col("depth") == 1) & (F.col("weight") > light)).select("comp")
    rolled, adds = nodes, []
    if not heavy.isEmpty():
        inside = nodes.join(heavy, "comp", "left_semi")
        through = rows.select("key", F.col("conv").alias("at_conv"), F.col("no").alias("at_depth"))
        names = inside.select("key", F.col("key").alias("at_key"), F.col("conv").alias("at_node"), F.col("parent_conv").alias("at_parent"))
        paths = settle(through.join(names, "key").drop("key"), "paths")
        parts, adds = _split_heavy(inside, paths, light)
        rolled = nodes.join(heavy, "comp", "left_anti").select(*nodes.columns).unionByName(parts)
    sums = _roll_up_light(rolled)
    if adds:
        more = adds[0]
        for add in adds[1:]:
            more = more.unionByName(add)
        more = more.groupBy("key").agg(*(F.sum(name).alias(f"more_{name}") for name in _SUMS))
        sums = sums.join(more, "key", "left")
        sums = sums.withColumns({name: F.col(name) + F.coalesce(f"more_{name}", F.lit(0)) for name in _SUMS})

    ended = rows.where("no = length").select("key", "conv")
    turnless = everyone.join(ended, "conv", "left_anti").select(_root().alias("key"), "conv")
    hashes = _hash_lists(ended.unionByName(turnless))
    below = nodes.agg(
        F.count(F.when(F.col("depth") == 1, 1)).alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        F.coalesce(F.sum("saved"), F.lit(0)).alias("saved_tokens"),
    )
    root = first.unionByName(below, allowMissingColumns=True).agg(*(F.max(c).alias(c) for c in (*first.columns, *below.columns)))
    root = root.where("n_convs > 0").withColumns(
        {
            "key": _root(),
            "depth": F.lit(0).cast("long"),
            "parent_conv": F.lit(None).cast("long"),
            "n_leaves": F.coalesce("n_leaves", F.lit(1)).cast("long"),
        }
    )
    columns = ["key", "conv", "depth", "parent_conv", "n_convs", "n_children", *_SUMS]
    everything = sums.select(*columns).unionByName(root.select(*columns)).join(hashes, "key", "left")
    return everything.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )
