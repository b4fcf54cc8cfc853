"""Periodic runs of words, by recompression.

The words of a batch of texts, numbered by identity, form one string with a mark of its own
before and after each text. Recompression turns it into a run-length grammar, a level at a
time: blocks of one symbol become a symbol, then, for a split of the symbols into left and
right ones, each left symbol followed by a right one becomes a symbol with it. Equal names
mean equal contents, and whether two neighbours merge depends on the two alone. So equal
stretches are cut alike except at their ends, and a common extension of two places is
found by going up the levels while they agree and down again where they part, with a
bounded number of comparisons on each: logarithmic time, no suffix array.

A run of period p and length n, n >= max(least, times * p), agrees with itself p words on
over n - p words in a row. So among every ``max(least - p, (times - 1) * p)``-th word one
lies in that stretch. These words, over all p a harmonic sum per text, are the candidates;
the extensions of each that agrees, forward and backward, are exactly its run's bounds.

All of it is arithmetic on whole arrays inside a task; texts are taken in batches of about
``BATCH_BYTES``, a longer one alone. Nothing is shuffled, collected or broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from partwise.llm.common import free_name
from partwise.llm.words import chunks, mix

BATCH_BYTES = 1 << 20
#: Candidates that are extended together.
TOGETHER = 1 << 20

RUN = T.StructType(
    [T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())]
)


class _Level:
    """A string of the grammar and how the next level's symbols lie over it.

    ``above[i]`` is the next level's symbol that covers symbol i, ``first[j]`` where its
    symbol j starts; both have an entry for the end. The top level has neither.
    """

    def __init__(self, symbols: np.ndarray, blocks: bool):
        self.symbols = symbols
        self.blocks = blocks  # whether the next level replaces blocks, not pairs
        self.above = self.first = self.starts = np.zeros(0, np.int32)

    def cut(self, starts: np.ndarray) -> None:
        """Symbols of the next level start where ``starts`` says."""
        self.starts = np.append(starts, True)
        self.above = (np.cumsum(self.starts) - 1).astype(np.int32)
        self.first = np.flatnonzero(self.starts).astype(np.int32)


class Grammar:
    """The run-length grammar of a string of numbers.

    ``extend`` needs the string to differ, for any two places, before either end is reached.
    """

    def __init__(self, string: np.ndarray):
        self.levels = [_Level(np.unique(string, return_inverse=True)[1].astype(np.int64), True)]
        while len(self.levels[-1].symbols) > 1:
            at = self.levels[-1]
            named = self._blocks(at) if at.blocks else self._pairs(at)
            self.levels.append(_Level(named, not at.blocks))

    @staticmethod
    def _blocks(at: _Level) -> np.ndarray:
        symbols = at.symbols
        at.cut(np.append(True, symbols[1:] != symbols[:-1]))
        heads, lengths = symbols[at.first[:-1]], np.diff(at.first)
        named = heads.copy()
        long = lengths > 1
        if long.any():  # a block of one keeps its name; longer ones get names above all of these
            keys = heads[long] * (int(lengths.max()) + 1) + lengths[long]
            named[long] = int(symbols.max()) + 1 + np.unique(keys, return_inverse=True)[1]
        return named

    def _pairs(self, at: _Level) -> np.ndarray:
        symbols = at.symbols
        salt = np.uint64((len(self.levels) + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        left = (mix(symbols.astype(np.uint64) + salt) & np.uint64(1)).astype(bool)
        joins, other = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
        if other.sum() > joins.sum():  # the better of the two orientations
            joins = other
        at.cut(np.append(True, ~joins))
        named = symbols[at.first[:-1]]
        where = np.flatnonzero(joins)
        if len(where):
            pairs = symbols[where] * (int(symbols.max()) + 1) + symbols[where + 1]
            names, numbers = np.unique(np.concatenate([named, symbols]), return_inverse=True)
            named = numbers[: len(named)].astype(np.int64)
            named[at.above[where]] = len(names) + np.unique(pairs, return_inverse=True)[1]
        return named

    def extend(self, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
        """Where ``a`` first differs from ``b``, going on from the two places symbol by symbol.

        The result is the place of a's differing symbol; with ``back``, the place after the
        last symbol before ``a`` that differs.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        stopped = np.zeros(len(a), np.int32)  # the level at which a pair of places stopped going up
        going = np.arange(len(a))
        for height, level in enumerate(self.levels):
            if not len(going):
                break
            if not len(level.first):
                stopped[going] = height
                break
            waiting, rising = going, []
            while len(waiting):
                both = level.starts[a[waiting]] & level.starts[b[waiting]]
                rising.append(waiting[both])
                waiting = waiting[~both]
                same, onward = self._step(level, a, b, waiting, back)
                stopped[waiting[~onward]] = height
                waiting = waiting[onward]
            going = np.concatenate(rising)
            a[going], b[going] = level.above[a[going]], level.above[b[going]]
        for height in range(len(self.levels) - 1, 0, -1):
            down = np.flatnonzero(stopped == height)
            if len(down):
                below = self.levels[height - 1]
                a[down], b[down] = below.first[a[down]], below.first[b[down]]
                self._step(below, a, b, down, back)
                stopped[down] = height - 1
        return a

    @staticmethod
    def _step(level: _Level, a: np.ndarray, b: np.ndarray, which: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray]:
        """Move on where the next symbols are the same; a block is passed as far as both have it.

        Gives where they were the same, and where the two may still agree after that.
        """
        x, y = a[which] - back, b[which] - back
        same = level.symbols[x] == level.symbols[y]
        moved = which[same]
        if not level.blocks:
            step = np.ones(len(moved), np.int64)
            onward = same
        else:
            x, y = x[same], y[same]
            if back:
                left, right = x + 1 - level.first[level.above[x]], y + 1 - level.first[level.above[y]]
            else:
                left, right = level.first[level.above[x] + 1] - x, level.first[level.above[y] + 1] - y
            step = np.minimum(left, right).astype(np.int64)
            onward = same.copy()
            onward[same] = left == right
        a[moved] += -step if back else step
        b[moved] += -step if back else step
        return same, onward


def _candidates(sizes: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place in it, period) of the harmonic grid, about ``TOGETHER`` at a time."""
    most = np.where(sizes >= least, sizes // times, 0)
    texts = np.repeat(np.arange(len(sizes)), most)
    periods = np.arange(len(texts)) - np.repeat(np.cumsum(most) - most, most) + 1
    width = np.maximum(least - periods, (times - 1) * periods)
    counts = (sizes[texts] - periods) // width
    total = np.cumsum(counts)
    at = 0
    while at < len(counts):
        past = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, past + TOGETHER, "right")))
        part = counts[at:end]
        steps = np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part) + 1
        yield np.repeat(texts[at:end], part), steps * np.repeat(width[at:end], part) - 1, np.repeat(periods[at:end], part)
        at = end


def _smallest_periods(rows: np.ndarray) -> np.ndarray:
    """Each (text, start, length) once: one with several periods is the run of the smallest."""
    rows = np.unique(rows, axis=0)
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    return rows[first]


def find_runs(words: np.ndarray, sizes: np.ndarray, least: int, times: int) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of all runs, in this order, for the words of texts in a row.

    ``words`` are numbers, equal for equal words, and ``sizes`` the texts' numbers of words.
    A run has at least ``least`` words and ``times`` (2 or more) times its smallest period.
    """
    n = len(sizes)
    starts = np.cumsum(sizes) - sizes + np.arange(n) + 1  # each text follows a mark
    string = np.zeros(len(words) + n + 1, np.int64)
    marks = np.append(starts - 1, len(string) - 1)
    inside = np.ones(len(string), bool)
    inside[marks] = False
    string[inside] = words
    string[marks] = (int(words.max()) + 1 if len(words) else 0) + np.arange(n + 1)
    grammar = None
    found = [np.zeros((0, 4), np.int64)]
    # A run found already holds its places for all multiples of its period: they lead to it again.
    known_end, known_period = np.zeros(len(string), np.int64), np.ones(len(string), np.int64)
    for text, place, period in _candidates(sizes, least, times):
        a = starts[text] + place
        agree = (string[a] == string[a + period]) & ((known_end[a] <= a + period) | (period % known_period[a] > 0))
        if not agree.any():
            continue
        grammar = grammar or Grammar(string)
        text, a, period = text[agree], a[agree], period[agree]
        start = grammar.extend(a, a + period, back=True)
        length = grammar.extend(a, a + period) + period - start
        long = length >= np.maximum(least, times * period)
        rows = _smallest_periods(np.stack([text, start - starts[text], length, period], axis=1)[long])
        found.append(rows)
        for i, s, n, p in rows.tolist():
            s += int(starts[i])
            known_end[s : s + n], known_period[s : s + n] = s + n, p
    rows = _smallest_periods(np.concatenate(found))
    return tuple(rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))].T)


def _number_words(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of every text, numbers for all of them in a row, and how many each text has."""
    numbers: dict[bytes, int] = {}
    split = [text.split() for text in texts]  # bytes split at 0x20 and 0x09-0x0D
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    named = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)) for words in split]
    return split, np.concatenate(named) if named else np.zeros(0, np.int64), sizes


def _kept(words: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which words no run contains after its first period."""
    change = np.zeros(words + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change[:-1]) == 0


def collapse_runs(
    df: DataFrame, least: int = 24, times: int = 3, text_col: str = "text", runs_col: str = "runs", to: str = "collapsed"
) -> DataFrame:
    """``df`` with the periodic runs of words in ``text_col``, the number of words, and the text without repeats.

    A run is a stretch of words in which words ``period`` apart are the same, the smallest
    such period, that no neighbouring word goes on with, of at least ``least`` words and
    ``times`` periods (2 or more). Words are what spaces and 0x09-0x0D part, compared byte
    by byte. New columns: ``n_words``; ``runs``, an array of (start, length, period) by
    start and period, numbered from word 0; ``collapsed``, the words that no run holds
    after its first period, with one space between them. Taken names get underscores.

    A null or empty text has no words and no runs. Rows are looked at one by one: null ids,
    repeated rows and other columns do not matter. A text of any length is one unit, in
    arrays of some 100 bytes a word. An empty table stays empty.
    """
    if times < 2 or least < 2:
        raise ValueError("a run has at least two periods and two words")
    at = df.columns.index(text_col)
    fields = [
        T.StructField(free_name(df, "n_words"), T.LongType()),
        T.StructField(free_name(df, runs_col), T.ArrayType(RUN)),
        T.StructField(free_name(df, to), T.StringType()),
    ]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in chunks(batch.column(at), BATCH_BYTES):
                split, words, sizes = _number_words([(text or "").encode() for text in texts.to_pylist()])
                text, start, length, period = find_runs(words, sizes, least, times)
                bounds = np.searchsorted(text, np.arange(len(sizes) + 1))
                collapsed = []
                for i, found in enumerate(split):
                    a, b = bounds[i], bounds[i + 1]
                    if a < b:
                        kept = _kept(len(found), start[a:b], length[a:b], period[a:b])
                        found = [found[k] for k in np.flatnonzero(kept)]
                    collapsed.append(b" ".join(found))
                spans = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], RUN.fieldNames())
                new = [
                    pa.array(sizes),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), spans),
                    pa.array(collapsed, pa.binary()).cast(pa.string()),
                ]
                part = batch.slice(row, len(texts))
                names = [*part.schema.names, *(field.name for field in fields)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names)

    return df.mapInArrow(add, T.StructType([*df.schema.fields, *fields]))
