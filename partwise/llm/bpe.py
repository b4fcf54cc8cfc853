"""Byte-level BPE: exact merges by backtracking over longest matches, and decoding.

Bytes are read as Latin-1 characters, so one pyahocorasick automaton finds all vocabulary
entries in a piece of text in a single pass; the longest one at each byte is the first
choice there. Two neighbouring tokens are compatible if the merges, undone step by step at
their border, would never have preferred a pair across it. The encoder takes the longest
compatible token, shortens it where it does not fit, and steps back over ends it has
proved dead, each at most once; so the time is linear in the piece. A sequence in which
all neighbours are compatible is unique, and is the one the merges produce.

The vocabulary is a file of ``base64 rank`` lines, given by its path. The driver reads it
once (at most ``VOCABULARY_BYTES``) and broadcasts it; nothing else is broadcast.
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from partwise.llm.common import free_name
from partwise.llm.words import Numbers, chunks, gather

VOCABULARY_BYTES = 64 << 20
#: Pieces whose tokens a task remembers, and compatible pairs; both start anew when full.
REMEMBERED_PIECES, REMEMBERED_PAIRS = 150_000, 150_000
#: Rows that are handed on together, and the text whose distinct pieces are encoded together.
ROWS, BATCH_BYTES = 512, 12 << 20


class Vocabulary:
    """Ranks with the tables that encoding needs. Every single byte must have a rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()
        self.lengths = {rank: len(token) for token, rank in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self.shorter: dict[int, int] = {}
        self._fits: dict[tuple[int, int], bool] = {}
        for rank in sorted(self.tokens):
            self._add(rank, self.tokens[rank])
        self._fits.clear()

    def _add(self, rank: int, token: bytes) -> None:
        """Find the two parts that the merges make ``token`` of, all of lower rank."""
        cut = next((i for i in range(len(token) - 1, 0, -1) if token[:i] in self.ranks), 0)
        if cut:
            self.shorter[rank] = self.ranks[token[:cut]]
        for i in range(1, len(token)):
            left, right = self.ranks.get(token[:i], rank), self.ranks.get(token[i:], rank)
            if left < rank and right < rank and self._undo(left, right):
                self.halves[rank] = left, right
                self.joined[left, right] = rank
                return

    def _undo(self, left: int, right: int) -> bool:
        """Undo the later merge on either side until a pair across the border comes first.

        ``bound`` is the rank of the merge just undone: a pair across the border that has a
        lower rank would have been merged before it. On a tie the left merge ran first.
        """
        bound = 1 << 60
        while True:
            if self.joined.get((left, right), bound) < bound:
                return False
            left_parts, right_parts = self.halves.get(left), self.halves.get(right)
            if left_parts is None and right_parts is None:
                return True
            if right_parts is None or (left_parts is not None and left > right):
                bound, left = left, left_parts[1]
            else:
                bound, right = right + 1, right_parts[0]

    def fits(self, left: int, right: int) -> bool:
        """Whether the merges can leave ``left`` and ``right`` as neighbours."""
        known = self._fits.get((left, right))
        if known is None:
            if len(self._fits) >= REMEMBERED_PAIRS:
                self._fits.clear()
            known = self._fits[left, right] = self._undo(left, right)
        return known

    def forget(self) -> None:
        self._fits.clear()

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ranks of one piece, as the merges leave them."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        longest = [0] * len(piece)
        for end, (rank, size) in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - size] = rank  # ends come in order: the last is the longest
        lengths, shorter, fits = self.lengths, self.shorter, self.fits
        open_end = bytearray(b"\x01") * (len(piece) + 1)
        out: list[int] = []
        at = 0
        token: int | None = longest[0] if piece else None
        while at < len(piece):
            while token is not None:
                end = at + lengths[token]
                if open_end[end] and (not out or fits(out[-1], token)):
                    break
                token = shorter.get(token)
            if token is not None:
                out.append(token)
                at = end
                token = longest[at] if at < len(piece) else None
            else:  # nothing goes on from here: shorten the token that ends here
                open_end[at] = 0
                token = out.pop()
                at -= lengths[token]
        return out


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if rank}


def load_vocabulary(path: str) -> bytes:
    """The file's bytes; refuses one that is too large to hand to every executor."""
    with open(path, "rb") as file:
        content = file.read(VOCABULARY_BYTES + 1)
    if len(content) > VOCABULARY_BYTES:
        raise ValueError(f"{path} has more than {VOCABULARY_BYTES} bytes")
    return content


class Encoder:
    """Splits texts by a pattern and encodes every match separately."""

    def __init__(self, content: bytes, pattern: str):
        # In a text pattern \\s means Unicode's White_Space; this module's \\s has four more.
        pattern = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.pieces = regex.compile(pattern).findall
        self.vocabulary = Vocabulary(read_ranks(content))
        self.known: dict[str, list[int]] = {}

    def encode_known(self, piece: str) -> list[int]:
        ids = self.known.get(piece)
        if ids is None:
            ids = self.vocabulary.encode_piece(piece.encode())
            if len(piece) <= 64:
                if len(self.known) >= REMEMBERED_PIECES:
                    self.known.clear()
                self.known[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and ``len(texts)`` + 1 offsets into it.

        Every distinct piece is encoded once; texts are numbers of pieces until the end.
        """
        numbers = Numbers()
        first = np.zeros(len(texts) + 1, np.int64)
        which = []
        for i, text in enumerate(texts):
            pieces = self.pieces(text)
            first[i + 1] = first[i] + len(pieces)
            which.append(np.fromiter(map(numbers.__getitem__, pieces), np.int32, len(pieces)))
        encoded = [self.encode_known(piece) for piece in numbers]
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        flat = np.fromiter(itertools.chain.from_iterable(encoded), np.int32, int(sizes.sum()))
        order = np.concatenate(which) if which else np.zeros(0, np.int32)
        ids, ends = gather(flat, (np.cumsum(sizes) - sizes)[order], sizes[order])
        return ids, ends[first]

    def forget(self) -> None:
        """Free what was remembered; the worker goes on to other work."""
        self.known.clear()
        self.vocabulary.forget()


class Decoder:
    """The bytes of every rank, side by side."""

    def __init__(self, content: bytes):
        ranks = read_ranks(content)
        spelled = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            spelled[rank] = token
        self.data = np.frombuffer(b"".join(spelled), np.uint8)
        self.sizes = np.array([len(token) for token in spelled], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode(self, lists: pa.Array) -> pa.Array:
        """The bytes of every list of ids."""
        lists = lists.fill_null([]) if lists.null_count else lists
        bounds = lists.offsets.to_numpy()
        ids = lists.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]]
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.sizes) or not self.sizes[ids].all()):
            raise KeyError("an id that the vocabulary does not have")
        data, ends = gather(self.data, self.starts[ids], self.sizes[ids])
        bounds = ends[bounds - bounds[0]]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(bounds), pa.py_buffer(data)])


_encoders: dict[tuple[int, str], Encoder] = {}
_decoders: dict[int, Decoder] = {}


def _encoder(content: bytes, pattern: str) -> Encoder:
    """One encoder for each vocabulary and pattern in a worker."""
    key = hash(content), pattern
    if key not in _encoders:
        _encoders[key] = Encoder(content, pattern)
    return _encoders[key]


def _rows(values: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    for row in range(0, len(values), ROWS):
        yield row, values.slice(row, ROWS)


def _add_column(
    df: DataFrame, field: T.StructField, source: str, slices: Callable, fill: Callable, after: Callable = lambda: None
) -> DataFrame:
    """``df`` with one more column, made of ``slices`` of column ``source``; ``after`` ends a task."""
    at = df.columns.index(source)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, values in slices(batch.column(at)):
                filled = fill(values)
                for row, new in _rows(filled):
                    part = batch.slice(begin + row, len(new))
                    yield pa.RecordBatch.from_arrays([*part.columns, new], [*part.schema.names, field.name])
        after()

    return df.mapInArrow(add, T.StructType([*df.schema.fields, field]))


def encode(df: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", to: str = "token_ids") -> DataFrame:
    """``df`` with the token ids of ``text_col`` in a new column of 32-bit integers.

    No special tokens. A null or empty text has no ids (an empty list). Every row is
    encoded by itself, so repeated rows, null ids and other columns do not matter; if ``to``
    is taken, underscores are put before it. An empty table stays empty.
    """
    content = df.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary))

    def fill(texts: pa.Array) -> pa.Array:
        encoder = _encoder(content.value, pattern)
        ids, bounds = encoder.encode_all([text or "" for text in texts.to_pylist()])
        return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))

    def after() -> None:
        _encoder(content.value, pattern).forget()

    field = T.StructField(free_name(df, to), T.ArrayType(T.IntegerType()))
    return _add_column(df, field, text_col, lambda texts: chunks(texts, BATCH_BYTES), fill, after)


def decode(df: DataFrame, vocabulary: str, ids_col: str = "token_ids", to: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the ids of ``ids_col`` stand for, in a new binary column.

    A null or empty list gives no bytes; an id that the vocabulary lacks is an error.
    """
    content = df.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary))

    def fill(lists: pa.Array) -> pa.Array:
        key = hash(content.value)
        if key not in _decoders:
            _decoders[key] = Decoder(content.value)
        return _decoders[key].decode(lists).cast(pa.binary())

    return _add_column(df, T.StructField(free_name(df, to), T.BinaryType()), ids_col, _rows, fill)
