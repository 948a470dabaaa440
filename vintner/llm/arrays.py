"""Texts of an Arrow batch as numpy arrays: words and their hashes for many documents at once.

Every function works on slices of at most about ``SLICE_BYTES`` of text (a longer single text is a
slice of its own), so memory follows the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = True
_ALNUM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PLACES = 1024
_FACTORS = np.random.default_rng(20240607).integers(1, 2**63, _PLACES, dtype=np.uint64) | np.uint64(1)


def text_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, one past the last row, bytes, offsets into the bytes); a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    row = 0
    while row < len(column):
        last = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, row + 1), len(column))
        yield row, last, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


class Words:
    """The words of several texts: runs of bytes that are not white space, or runs of letters and digits."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, letters: bool = False, fold: bool = True):
        """``letters``: runs of ASCII letters and digits and of bytes over 127; ``fold``: A-Z as a-z."""
        self.data = _LOWER[data] if fold else data
        self.n_texts = len(offsets) - 1
        inside = _ALNUM[data] if letters else ~_SPACE[data]
        before = np.zeros(len(data), dtype=bool)
        before[1:] = inside[:-1]
        firsts = offsets[:-1]
        before[firsts[firsts < len(data)]] = False
        after = np.zeros(len(data), dtype=bool)
        after[:-1] = inside[1:]
        lasts = offsets[1:] - 1
        after[lasts[lasts >= 0]] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.text = np.searchsorted(offsets, self.start, side="right") - 1
        self._inside = inside

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.bincount(self.text, minlength=self.n_texts)

    def _products(self) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.end - self.start
        spans = np.repeat(self.start, lengths)
        at = np.flatnonzero(self._inside)
        place = at - spans
        return place, (self.data[at].astype(np.uint64) + np.uint64(1)) * _FACTORS[place & (_PLACES - 1)]

    def hashes(self, prefixes: tuple[int, ...] = ()) -> list[np.ndarray]:
        """A hash of every word, then of its first k bytes for each k (of the whole word if shorter)."""
        if not len(self):
            return [np.zeros(0, dtype=np.uint64) for _ in range(1 + len(prefixes))]
        place, products = self._products()
        first = np.zeros(len(self), dtype=np.int64)
        np.cumsum((self.end - self.start)[:-1], out=first[1:])
        out = [mixed(np.add.reduceat(products, first))]
        for k in prefixes:
            out.append(mixed(np.add.reduceat(np.where(place < k, products, np.uint64(0)), first)))
        return out


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all others (the finishing step of SplitMix64)."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(30)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(31)
    return v


def folds(n: int, parts: int) -> np.ndarray:
    """A part for each of n rows, the same every time and without a pattern."""
    return (mixed(np.arange(n, dtype=np.uint64)) % np.uint64(parts)).astype(np.int64)


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, first word) of every run of ``size`` words; a shorter text is one run of all its words.

    ``counts`` has the number of words of every text, ``words`` their hashes one text after the other.
    """
    n, ends = len(words), np.cumsum(counts)
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.zeros(0, np.int64)
    out = np.zeros(0, np.uint64)
    if n >= size:
        at = np.flatnonzero(np.arange(n - size + 1) + size <= ends[text[: n - size + 1]])
        out = _runs(words, at, size)
    for k in range(1, size):
        short = ends[counts == k] - k
        at, out = np.concatenate([at, short]), np.concatenate([out, _runs(words, short, k)])
    return out, text[at], at


def _runs(words: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    out = words[at]
    for k in range(1, size):
        out = (out ^ (out >> np.uint64(29))) * _FACTORS[k] + words[at + k]
    return mixed(out)


def distinct_pairs(text: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (text, feature) once, by text; features are below 2**40 and texts below 2**23."""
    keys = np.unique((text.astype(np.uint64) << np.uint64(40)) | feature.astype(np.uint64))
    return (keys >> np.uint64(40)).astype(np.int64), keys & np.uint64((1 << 40) - 1)
