"""BPE over a trie of words: the encoding of a shared prefix is computed once, and decoding.

The encoding of a prefix determines that of a longer one but for the last token: among the
tokens that end where the prefix ends there is exactly one that may follow the encoding of
what lies before it. So a node of a trie needs one state, its last token, and finds it from
the states on its path. The distinct words of a batch are put into a trie in sorted order,
which is its depth-first order: only the path to the current node is held, a word starts at
the node where it leaves the one before it, and its tokens are read off by going back from
its node, a token's length at a time. Every byte of the trie is a step of an automaton over
the vocabulary, whose state names the longest token that ends there; shorter ones follow by
suffix links. Time is linear in the trie's bytes but for suffix links, for long words too.

The tokenizer is a JSON file of the tokenizers library, given by its path: byte-level words,
a list of merges and added tokens, which are cut out of a text first. The driver reads it
once (at most ``FILE_BYTES``) and broadcasts it; nothing else is broadcast or shuffled.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from partwise.llm.common import free_name
from partwise.llm.words import Numbers, chunks, gather

FILE_BYTES = 64 << 20
#: Text whose distinct words share a trie; a longer text has one of its own.
BATCH_BYTES = 4 << 20
#: Pairs of tokens whose compatibility a task remembers; it starts anew when full.
REMEMBERED_PAIRS = 200_000
#: Fixed value: how byte-level tokenizers of this format cut a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: itself if printable, else one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (byte for byte in range(256) if byte not in printable)
    return {chr(byte): byte for byte in printable} | {chr(256 + i): byte for i, byte in enumerate(others)}


class Tokenizer:
    """The tables of a tokenizer file. A setting this operator does not know is an error."""

    def __init__(self, content: bytes):
        file = json.loads(content)
        model, splitter = file["model"], file["pre_tokenizer"] or {}
        if model["type"] != "BPE" or splitter.get("type") != "ByteLevel" or not splitter.get("use_regex", True):
            raise ValueError("not a byte-level BPE tokenizer")
        odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        if file["normalizer"] or splitter.get("add_prefix_space") or any(model.get(key) for key in odd):
            raise ValueError("the tokenizer has settings that are not supported")
        if any(added[key] for added in file["added_tokens"] for key in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that take in their surroundings are not supported")
        letters = byte_letters()
        self.added = {added["content"]: added["id"] for added in file["added_tokens"]}
        spelled = {token: bytes(letters[c] for c in token) for token in model["vocab"] if token not in self.added}
        # Tokens are numbered in the order of their merges, bytes first; ids are the file's.
        merges = [merge.split(" ") if isinstance(merge, str) else merge for merge in model["merges"]]
        made = [left + right for left, right in merges]
        if len(set(made)) < len(made):
            raise ValueError("two merges make the same token")
        letter_of = {byte: letter for letter, byte in letters.items()}
        names = [letter_of[byte] for byte in range(256)] + made
        number = {name: i for i, name in enumerate(names)}
        self.ids = [model["vocab"][name] for name in names]
        self.tokens = [spelled[name] for name in names]
        self.lengths = [len(token) for token in self.tokens]
        self.halves: list[tuple[int, int] | None] = [None] * 256
        self.halves += [(number[left], number[right]) for left, right in merges]
        self.joined = {pair: i for i, pair in enumerate(self.halves) if pair}
        self._build_automaton()
        self.follows: dict[int, bool] = {}

    def _build_automaton(self) -> None:
        """States are prefixes of tokens; ``longest`` is the longest token that ends a state.

        ``shorter`` is the longest token that is a proper suffix of a token.
        """
        edges: dict[int, int] = {}
        token_at = [-1]
        for number, token in enumerate(self.tokens):
            state = 0
            for byte in token:
                key = state << 8 | byte
                state = edges.get(key, -1)
                if state < 0:
                    state = edges[key] = len(token_at)
                    token_at.append(-1)
            token_at[state] = number
        below: list[list[tuple[int, int]]] = [[] for _ in token_at]
        for key, state in edges.items():
            below[key >> 8].append((key & 255, state))
        fail, longest = [0] * len(token_at), list(token_at)
        shorter = [-1] * len(self.tokens)
        queue = deque(state for _, state in below[0])
        while queue:
            at = queue.popleft()
            suffix = longest[fail[at]]
            if token_at[at] >= 0:
                shorter[token_at[at]] = suffix
            else:
                longest[at] = suffix
            for byte, state in below[at]:
                link = fail[at]
                while (there := edges.get(link << 8 | byte)) is None and link:
                    link = fail[link]
                fail[state] = there or 0
                queue.append(state)
        self.edges, self.fail, self.longest, self.shorter = edges, fail, longest, shorter

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left`` and ``right`` as they are when they meet.

        The merges are undone from the last one back, on whichever side it was. What then
        touches at the border must not be a pair that was merged before the one undone; of
        equal merges the left one ran first.
        """
        halves, joined = self.halves, self.joined
        before = len(self.tokens)
        while joined.get((left, right), before) >= before:
            if left < 256 and right < 256:
                return True
            if left > right:
                before, left = left, halves[left][1]
            else:
                before, right = right + 1, halves[right][0]
        return False

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in one array, and where each word's ids start in it.

        The words' trie is walked depth first; see the top of this file.
        """
        edges, fail, longest, shorter, lengths = self.edges, self.fail, self.longest, self.shorter, self.lengths
        follows, may_follow, ids_of = self.follows, self.may_follow, self.ids
        order = sorted(range(len(words)), key=words.__getitem__)
        states, last = [0], [-1]  # along the path: the automaton's state, and the last token up to there
        ids: list[int] = []
        starts = np.zeros(len(words) + 1, np.int64)
        sizes = np.zeros(len(words), np.int64)
        before = b""
        for k in order:
            word = words[k]
            depth = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                depth += 1
            del states[depth + 1 :], last[depth + 1 :]
            state = states[depth]
            for byte in word[depth:]:
                depth += 1
                while (there := edges.get(state << 8 | byte)) is None:
                    state = fail[state]
                state = there
                token = longest[state]
                while depth > lengths[token]:
                    left = last[depth - lengths[token]]
                    fits = follows.get(left << 32 | token)
                    if fits is None:
                        if len(follows) >= REMEMBERED_PAIRS:
                            follows.clear()
                        fits = follows[left << 32 | token] = may_follow(left, token)
                    if fits:
                        break
                    token = shorter[token]
                states.append(state)
                last.append(token)
            at = len(word)
            mark = len(ids)
            while at:
                ids.append(ids_of[last[at]])
                at -= lengths[last[at]]
            ids[mark:] = ids[mark:][::-1]
            starts[k], sizes[k] = mark, len(ids) - mark
            before = word
        return np.array(ids, np.int32), np.stack([starts[:-1], sizes])


class Encoder:
    """Cuts texts into words and encodes the distinct words of a batch together."""

    def __init__(self, content: bytes):
        self.tokenizer = Tokenizer(content)
        # In a word pattern \\s means Unicode's White_Space; this module's \\s has four more.
        pattern = WORDS.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.words = regex.compile(pattern).findall
        longest_first = sorted(self.tokenizer.added, key=len, reverse=True)
        self.added = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None

    def _pieces(self, text: str) -> list[str]:
        """The words of a text, and its added tokens with a NUL and a blank before them, which no word has."""
        if self.added is None or self.added.search(text) is None:
            return self.words(text)
        out: list[str] = []
        for i, part in enumerate(self.added.split(text)):
            out += ["\0 " + part] if i % 2 else self.words(part)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and ``len(texts)`` + 1 offsets into it."""
        numbers = Numbers()
        first = np.zeros(len(texts) + 1, np.int64)
        found = []
        for i, text in enumerate(texts):
            pieces = self._pieces(text)
            first[i + 1] = first[i] + len(pieces)
            found.append(np.fromiter(map(numbers.__getitem__, pieces), np.int32, len(pieces)))
        which = np.concatenate(found) if found else np.zeros(0, np.int32)
        added = {number: self.tokenizer.added[piece[2:]] for piece, number in numbers.items() if piece.startswith("\0 ")}
        words = [b"" if number in added else piece.encode() for piece, number in numbers.items()]
        ids, (starts, sizes) = self.tokenizer.encode_words(words)
        if added:
            starts[list(added)] = len(ids) + np.arange(len(added))
            sizes[list(added)] = 1
            ids = np.concatenate([ids, np.array(list(added.values()), np.int32)])
        out, ends = gather(ids, starts[which], sizes[which])
        return out, ends[first]


class Decoder:
    """The bytes of every id, added tokens included."""

    def __init__(self, content: bytes):
        file, letters = json.loads(content), byte_letters()
        names = file["model"]["vocab"] | {added["content"]: added["id"] for added in file["added_tokens"]}
        spelled = [b""] * (max(names.values()) + 1)
        self.known = np.zeros(len(spelled), bool)
        for name, i in names.items():
            plain = all(c in letters for c in name)
            spelled[i] = bytes(letters[c] for c in name) if plain else name.encode()
            self.known[i] = True
        self.data = np.frombuffer(b"".join(spelled), np.uint8)
        self.sizes = np.array([len(s) for s in spelled], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode(self, lists: pa.Array) -> pa.Array:
        """The text of every list of ids; bytes that are no UTF-8 become U+FFFD."""
        lists = lists.fill_null([]) if lists.null_count else lists
        bounds = lists.offsets.to_numpy()
        ids = lists.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]]
        inside = (ids >= 0) & (ids < len(self.known))
        if not (inside.all() and self.known[ids].all()):
            raise ValueError("an id that the tokenizer does not have")
        data, ends = gather(self.data, self.starts[ids], self.sizes[ids])
        bounds = ends[bounds - bounds[0]]
        raw = data.tobytes()
        try:
            raw.decode()
            whole = all(raw[b] & 0xC0 != 0x80 for b in bounds if b < len(raw))
        except UnicodeDecodeError:
            whole = False
        if not whole:
            texts = [raw[a:b].decode(errors="replace") for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            return pa.array(texts, pa.large_string())
        return pa.LargeStringArray.from_buffers(len(lists), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(raw))


_made: dict[tuple[type, int], Encoder | Decoder] = {}


def _once(kind: type, content: bytes) -> Encoder | Decoder:
    """One encoder and one decoder for each file in a worker."""
    key = kind, hash(content)
    if key not in _made:
        _made[key] = kind(content)
    return _made[key]


def load_file(path: str) -> bytes:
    """The file's bytes; refuses one that is too large to hand to every executor."""
    with open(path, "rb") as file:
        content = file.read(FILE_BYTES + 1)
    if len(content) > FILE_BYTES:
        raise ValueError(f"{path} has more than {FILE_BYTES} bytes")
    return content


def _with_column(
    df: DataFrame, field: T.StructField, source: str, slices: Callable, fill: Callable[[pa.Array], pa.Array]
) -> DataFrame:
    """``df`` with one more column, which ``fill`` makes of ``slices`` of column ``source``."""
    at = df.columns.index(source)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, values in slices(batch.column(at)):
                part = batch.slice(row, len(values))
                yield pa.RecordBatch.from_arrays([*part.columns, fill(values)], [*part.schema.names, field.name])

    return df.mapInArrow(add, T.StructType([*df.schema.fields, field]))


def encode(df: DataFrame, tokenizer: str, text_col: str = "text", to: str = "token_ids") -> DataFrame:
    """``df`` with the token ids of ``text_col`` in a new column of 32-bit integers.

    Added tokens in a text are found as such; none are put around it. A null or empty text
    has no ids (an empty list). Every row is encoded by itself, so repeated rows, null ids
    and other columns do not matter; if ``to`` is taken, underscores are put before it. A
    text of any length is one unit. An empty table stays empty.
    """
    content = df.sparkSession.sparkContext.broadcast(load_file(tokenizer))

    def fill(texts: pa.Array) -> pa.Array:
        ids, bounds = _once(Encoder, content.value).encode([text or "" for text in texts.to_pylist()])
        return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))

    field = T.StructField(free_name(df, to), T.ArrayType(T.IntegerType()))
    return _with_column(df, field, text_col, lambda texts: chunks(texts, BATCH_BYTES), fill)


def decode(df: DataFrame, tokenizer: str, ids_col: str = "token_ids", to: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids of ``ids_col`` stand for, in a new column.

    A null or empty list gives an empty text, bytes that are no UTF-8 become U+FFFD; an id
    that the tokenizer lacks is an error. If ``to`` is taken, underscores are put before it.
    """
    content = df.sparkSession.sparkContext.broadcast(load_file(tokenizer))

    def fill(lists: pa.Array) -> pa.Array:
        return _once(Decoder, content.value).decode(lists).cast(pa.string())

    def slices(lists: pa.Array) -> Iterator[tuple[int, pa.Array]]:
        bounds = lists.offsets.to_numpy()
        row = 0
        while row < len(lists):
            end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + (BATCH_BYTES >> 2), "right")) - 1)
            yield row, lists.slice(row, end - row)
            row = end

    return _with_column(df, T.StructField(free_name(df, to), T.StringType()), ids_col, slices, fill)
