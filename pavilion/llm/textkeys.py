"""Words, rolling keys and window minima of whole text columns, as numpy arrays inside Spark tasks.

A string column arrives as one run of UTF-8 bytes with offsets. Words, their 64-bit keys and
the keys of word or byte windows are computed for all texts of a slice at once, with no
Python loop over words. Null texts count as empty. Keys only decide which rows meet; where a
result must not rest on them, the operator compares the text itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text makes a slice of its own.
SLICE_BYTES = 1 << 18
#: Most texts in a slice, so that a text's number fits into the spare bits of a key.
SLICE_TEXTS = 1 << 12

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Word bytes of ``[^\x20\x09-\x0D]+``.
NON_SPACE = ~_SPACE
#: Word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
ALNUM = np.array([(0x30 <= b <= 0x39) or (0x41 <= b <= 0x5A) or (0x61 <= b <= 0x7A) or b >= 0x80 for b in range(256)])

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xD6E8FEB86659FD93 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit key depends on all bits of ``x``."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE_KEYS = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xA24BAED4963EE407))
_LOWER = np.arange(256)
_LOWER[0x41:0x5B] += 32


def window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least value of each ``w`` consecutive ones."""
    if len(x) < w:
        return x[:0]
    size = 1
    while size * 2 <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (w - size)], x[w - size :]) if w > size else x


class Slice(NamedTuple):
    """Some texts as bytes: those of text ``i`` lie in ``data[offsets[i]:offsets[i + 1]]``."""

    first: int
    offsets: np.ndarray
    data: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def slices(texts: pa.Array, limit: int = SLICE_BYTES, most: int = SLICE_TEXTS) -> Iterator[Slice]:
    """The column in slices of about ``limit`` bytes and ``most`` texts at most; every text is whole in one slice."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    if not len(texts):
        return
    _, where, content = texts.buffers()
    offsets = np.frombuffer(where, np.int64 if large else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(content, np.uint8) if content is not None and content.size else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        to = min(to, at + most)
        yield Slice(at, offsets[at : to + 1] - offsets[at], data[offsets[at] : offsets[to]])
        at = to


class Words(NamedTuple):
    """Words of a slice, in order: byte range, key, and the range of words of each text."""

    start: np.ndarray
    end: np.ndarray
    key: np.ndarray
    bounds: np.ndarray

    @property
    def text(self) -> np.ndarray:
        """Number of the text that each word lies in."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


class Keyer:
    """Keys of words and windows; made once in a task, because it keeps tables of powers."""

    def __init__(self) -> None:
        self._tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _table(self, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """At least ``n`` powers of ``base``, and of its inverse, modulo 2**64."""
        have = self._tables.get(base)
        if have is None or len(have[0]) < n:
            size, both = max(n, SLICE_BYTES + 8192), []
            for b in (base, pow(base, -1, 1 << 64)):
                p = np.full(size, b, np.uint64)
                p[0] = 1
                both.append(np.cumprod(p))
            have = both[0], both[1]
            if size <= 4 * SLICE_BYTES:
                self._tables[base] = have
        return have

    def _prefix(self, values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
        """Prefix sums of ``values[i] * base**i``, and the inverse powers."""
        power, inverse = self._table(base, len(values) + 1)
        sums = np.empty(len(values) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values * power[: len(values)], out=sums[1:])
        return sums, inverse

    def rolling(self, values: np.ndarray, k: int) -> np.ndarray:
        """Key of each run of ``k`` consecutive values; ``len(values) - k + 1`` of them."""
        if len(values) < k:
            return np.empty(0, np.uint64)
        sums, inverse = self._prefix(values, _WORD_BASE)
        n = len(values) - k + 1
        return mix((sums[k:] - sums[:n]) * inverse[:n] + _U(k))

    def runs(self, values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Key of each run ``values[start:end]``; equals ``rolling`` for equal values."""
        sums, inverse = self._prefix(values, _WORD_BASE)
        return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))

    def words(self, part: Slice, letters: np.ndarray = NON_SPACE, lower: bool = False) -> Words:
        """Maximal runs of word bytes; no word crosses texts."""
        data, offsets = part.data, part.offsets
        inside = letters[data]
        cuts = offsets[:-1][offsets[:-1] < len(data)]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        begins[cuts] = inside[cuts]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        before = cuts[cuts > 0] - 1
        ends[before] = inside[before]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        key = np.empty(0, np.uint64)
        if len(start):
            sums, inverse = self._prefix((_BYTE_KEYS[_LOWER] if lower else _BYTE_KEYS)[data], _BASE)
            key = mix((sums[end] - sums[start]) * inverse[start])
        return Words(start, end, key, np.searchsorted(start, offsets))


def byte_keys(part: Slice) -> np.ndarray:
    """A 64-bit value for each byte, for ``rolling``."""
    return _BYTE_KEYS[part.data]


def inside_one(bounds: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of the ``n`` windows of ``k`` items lie in one text whole, given the texts' bounds."""
    ok = np.ones(max(n, 0), bool)
    for j in np.unique(bounds[1:-1]):
        ok[max(0, j - k + 1) : j] = False
    return ok


def shingle_sets(keyer: Keyer, part: Slice, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``k``-word shingles of each text, lower-cased: keys in order of text, and bounds.

    A text of fewer words than ``k`` has its whole sequence as its one shingle, a text
    without words none. Keys have 52 bits; those of a text are in ascending order.
    """
    found = keyer.words(part, lower=True)
    n = len(found.key) - k + 1
    keys, text = keyer.rolling(found.key, k), found.text
    whole = inside_one(found.bounds, k, n)
    counts = np.diff(found.bounds)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        few = keyer.runs(found.key, found.bounds[short], found.bounds[short + 1])
        keys = np.concatenate([keys[whole], few])
        text = np.concatenate([text[: max(n, 0)][whole], short])
    else:
        keys, text = keys[whole], text[: max(n, 0)][whole]
    both = np.sort((text.astype(np.uint64) << _U(52)) | (keys >> _U(12)))
    both = both[np.concatenate([[True], both[1:] != both[:-1]])] if len(both) else both
    bounds = np.searchsorted(both >> _U(52), np.arange(part.n + 1, dtype=np.uint64))
    return both & _U((1 << 52) - 1), bounds
