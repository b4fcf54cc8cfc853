"""Words of whole texts as arrays: byte spans, 64-bit hashes and shingles.

The texts of an Arrow batch lie in one buffer, so words are found and hashed for many
texts at once with numpy. A word is a run of bytes other than space and 0x09-0x0D (or, on
request, other than ASCII marks too), with A-Z taken as a-z; other letters are compared as
they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MARK = _SPACE.copy()
_MARK[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
#: Longer words are hashed one by one.
_LONG = 1024


class Words(NamedTuple):
    data: np.ndarray  # lower-cased bytes of all texts
    text_starts: np.ndarray  # len(texts) + 1 offsets into data
    starts: np.ndarray  # of words, offsets into data
    ends: np.ndarray
    first: np.ndarray  # len(texts) + 1: a text's words are first[i]:first[i + 1]
    hashes: np.ndarray


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of the texts (null: empty) and each text's offset in them."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8)
    if data is None or starts[-1] == starts[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's length and bytes, eight bytes mixed in at a time.

    No two words of one length up to eight bytes share a hash; longer ones do by chance only.
    """
    eights = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    for shift in (1, 2, 4):  # eights[i] becomes the number that the bytes from i on spell
        eights = eights[:-shift] | eights[shift:] << np.uint64(8 * shift)
    lengths = ends - starts
    hashes = mix(lengths.astype(np.uint64) * np.uint64(_BASE))
    left = np.flatnonzero(lengths <= _LONG)
    at = 0
    while len(left):
        rest = np.minimum(lengths[left] - at, 8)
        block = eights[starts[left] + at] & np.uint64(0xFFFFFFFFFFFFFFFF) >> (64 - 8 * rest).astype(np.uint64)
        hashes[left] = mix((hashes[left] ^ block) * np.uint64(_BASE))
        at += 8
        left = left[lengths[left] > at]
    for i in np.flatnonzero(lengths > _LONG):
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        hashes[i] = int.from_bytes(digest, "little")
    return hashes


def split_words(texts: pa.Array, at_marks: bool = False) -> Words:
    """The words of every text, with their hashes; ``at_marks`` splits at ASCII marks as well."""
    raw, text_starts = text_bytes(texts)
    n = len(raw)
    data = _LOWER[raw]
    solid = ~(_MARK if at_marks else _SPACE)[raw]
    inner = text_starts[(text_starts > 0) & (text_starts < n)]
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0] = after[-1] = False
        before[1:] = solid[:-1]
        after[:-1] = solid[1:]
        before[inner] = False
        after[inner - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    hashes = _word_hashes(data, starts, ends)
    return Words(data, text_starts, starts, ends, np.searchsorted(starts, text_starts), hashes)


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Slices of about ``most`` bytes (a longer text alone), with the row each starts at."""
    _, starts = text_bytes(texts)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + most, "right")) - 1)
        yield at, texts.slice(at, end - at)
        at = end


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` neighbouring words; a run may cross texts."""
    count = max(0, len(hashes) - n + 1)
    grams = np.zeros(count, np.uint64)
    for i in range(n):
        grams = mix(grams * np.uint64(_BASE) + hashes[i : i + count])
    return grams


def shingle_sets(words: Words, n: int) -> list[np.ndarray]:
    """Each text's distinct ``n``-word shingles, sorted, as hashes.

    A text of 1 to ``n`` - 1 words has its whole sequence as the one shingle.
    """
    grams = gram_hashes(words.hashes, n)
    sets = []
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= n:
            sets.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            sets.append(gram_hashes(words.hashes[a:b], int(b - a)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


class Numbers(dict):
    """Numbers for keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices of ``values`` one after another, and the offsets at which they start and end."""
    ends = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    return values[np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])], ends
