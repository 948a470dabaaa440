"""Benchmark passages in documents, by SimHash of item-sized windows.

A document is read through windows as long as a benchmark item, at every place. A window gets a weighted SimHash,
all of them by running sums over the shingles. Fingerprints within the Hamming radius agree to within a quarter of
it on one of four 16-bit blocks: looking up every near value of each block of a window finds all
items within the radius. Each such item is then compared exactly: the weighted Jaccard similarity of the two
multisets of shingles, a shingle weighing as much as its characters.

Places are left out only where no window can be similar: an item's rarest shingles that together weigh more than
a similar window may lack are a proof, as a similar window has one of them. So only windows that hold
such a shingle are fingerprinted, and passages that many items share cost little.

Items are taken in blocks of a bounded number of words, so what the tasks hold does not grow with the
benchmark; documents are read once per block and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintner.llm.arrays import Words, shingle_hashes, text_slices
from vintner.llm.shared import stored

SHINGLE = 5
SIMILARITY = 0.8
#: Of 64 bits. At a similarity of 0.8 fingerprints differ in about 10 bits, with a spread of 3.
RADIUS = 19
BLOCKS = 4
#: Characters of benchmark text whose index a task holds at a time.
BLOCK_CHARS = 20_000_000
#: Windows fingerprinted at once.
STRETCH = 2048
MATCHES = "doc_id long, item_id long, window_start long, window_words int, similarity double, hamming int"
_WIDTH = 64 // BLOCKS


def _near_masks(radius: int) -> np.ndarray:
    """All values of a block with up to ``radius`` bits set."""
    out = [0]
    for k in range(1, radius + 1):
        out += [sum(1 << b for b in bits) for bits in combinations(range(_WIDTH), k)]
    return np.array(out, dtype=np.int64)


def weighted_simhash(hashes: np.ndarray, weights: np.ndarray) -> int:
    """Bit b is set if the hashes with bit b weigh over half."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(weights @ bits * 2 > weights.sum(), bitorder="little").view("<u8")[0])


def _multiset(hashes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values, first, counts = np.unique(hashes, return_index=True, return_counts=True)
    return values, counts, weights[first]


def weighted_jaccard(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> float:
    """Sum of the weights of common over that of all shingles, repeats counted."""
    _, at, to = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = float((np.minimum(a[1][at], b[1][to]) * a[2][at]).sum())
    total = float((a[1] * a[2]).sum() + (b[1] * b[2]).sum()) - common
    return common / total if total else 0.0


class _Texts:
    """Words of several texts, and their shingles by size."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = Words(data, offsets, letters=True)
        (self.hashes,) = words.hashes()
        self.counts = words.counts()
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self._lengths = np.concatenate([[0], np.cumsum(words.end - words.start)])

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, weight, text, first word) of every run of exactly ``size`` words."""
        hashes, text, at = shingle_hashes(self.hashes, self.counts, size)
        whole = self.counts[text] >= size
        hashes, text, at = hashes[whole], text[whole], at[whole]
        return hashes, self._lengths[at + size] - self._lengths[at], text, at


class _Postings:
    """Where shingles occur in items; a small bit table turns most others away first."""

    def __init__(self, hashes: np.ndarray, item: np.ndarray):
        rank = np.argsort(hashes, kind="stable")
        self.known, self.item = hashes[rank], item[rank]
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[(hashes & np.uint64(len(self.seen) - 1)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``hashes``, posting) for every shingle that occurs in an item."""
        hit = np.flatnonzero(self.seen[(hashes & np.uint64(len(self.seen) - 1)).astype(np.int64)])
        low = np.searchsorted(self.known, hashes[hit], side="left")
        many = np.searchsorted(self.known, hashes[hit], side="right") - low
        post = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(hit, many), post


class ItemIndex:
    """Benchmark items: their shingles, fingerprints and the lookup of fingerprints by near blocks."""

    def __init__(self, item_ids: list[int], texts: list[str], radius: int = RADIUS, similarity: float = SIMILARITY):
        self.radius, self.similarity = radius, similarity
        self.item_ids, self.words, self.sets = [], [], []
        prints, grams, gram_item = [], {}, {}
        for _, _, data, offsets in (x for t in [pa.array(texts, pa.string())] for x in text_slices(t)):
            held = _Texts(data, offsets)
            base = len(self.words)
            self.words += held.counts.tolist()
            for size in range(1, SHINGLE + 1):
                hashes, weights, text, _ = held.shingles(size)
                # Items of at least five words have runs of five, shorter ones are a single run.
                mine = (held.counts[text] == size) | ((held.counts[text] > size) & (size == SHINGLE))
                hashes, weights, text = hashes[mine], weights[mine], text[mine]
                for k in np.unique(text):
                    own = text == k
                    self.sets.append((base + int(k), _multiset(hashes[own], weights[own].astype(float))))
                    prints.append((base + int(k), weighted_simhash(hashes[own], weights[own].astype(float))))
                grams.setdefault(size, []).append(hashes)
                gram_item.setdefault(size, []).append(base + text)
        self.item_ids = list(item_ids)
        self.sets = dict(self.sets)
        order = dict(prints)
        self.known = np.array(sorted(order), dtype=np.int64)
        self.prints = np.array([order[i] for i in self.known.tolist()], dtype=np.uint64)
        self.tables = []
        for block in range(BLOCKS):
            values = ((self.prints >> np.uint64(block * _WIDTH)) & np.uint64(2**_WIDTH - 1)).astype(np.int64)
            rank = np.argsort(values, kind="stable")
            starts = np.searchsorted(values[rank], np.arange(2**_WIDTH + 1))
            self.tables.append((rank, starts))
        self.masks = _near_masks(radius // BLOCKS)
        self.grams = {}
        for size, parts in grams.items():
            hashes = np.concatenate(parts)
            if len(hashes):
                item = np.concatenate(gram_item[size])
                rare = self._rare(hashes, item, similarity)
                self.grams[size] = _Postings(hashes[rare], item[rare])

    def _rare(self, hashes: np.ndarray, item: np.ndarray, similarity: float) -> np.ndarray:
        """Postings of each item's rarest shingles, as many as weigh over what a similar window may lack."""
        values, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        keep = np.zeros(len(hashes), dtype=bool)
        order = np.lexsort((hashes, counts[inverse], item))
        bounds = np.flatnonzero(np.diff(item[order], prepend=-1, append=-1))
        for a, z in zip(bounds, bounds[1:], strict=False):
            own = order[a:z]
            known, many, weight = self.sets[int(item[own[0]])]
            mass = (many * weight)[np.searchsorted(known, hashes[own])]
            first = np.concatenate([[True], hashes[own][1:] != hashes[own][:-1]])
            sofar = np.cumsum(np.where(first, mass, 0.0))
            slack = (1 - similarity) * float((many * weight).sum()) * (1 + 1e-9)
            keep[own] = sofar - mass <= slack
        return keep

    def within(self, prints: np.ndarray, among: np.ndarray) -> np.ndarray:
        """Distance of every fingerprint (row) to every item among these (column), -1 beyond the radius.

        ``among`` has positions in ``known``. The tables find the items: a fingerprint within the radius is near on one block at least.
        """
        column = np.full(len(self.known), -1, dtype=np.int64)
        column[among] = np.arange(len(among))
        met = np.zeros((len(prints), len(among)), dtype=bool)
        for block, (rank, starts) in enumerate(self.tables):
            values = ((prints >> np.uint64(block * _WIDTH)) & np.uint64(2**_WIDTH - 1)).astype(np.int64)
            values, row = np.unique(values, return_inverse=True)
            near = values[:, None] ^ self.masks
            many = starts[near + 1] - starts[near]
            value, mask = np.nonzero(many)
            low, many = starts[near[value, mask]], many[value, mask]
            post = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            found = column[rank[post]]
            of_value = np.zeros((len(values), len(among)), dtype=bool)
            of_value[np.repeat(value, many)[found >= 0], found[found >= 0]] = True
            met |= of_value[row]
        away = np.bitwise_count(prints[:, None] ^ self.prints[among]).astype(np.int64)
        return np.where(met & (away <= self.radius), away, -1)

    def search(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
        """(text, item, first word, words, similarity, distance): the best window of each text and item.

        Of equally similar windows the first one. A result for an item does not depend on which others share its block.
        """
        texts = _Texts(data, offsets)
        lengths = np.array(self.words, dtype=np.int64)
        for size, rare in self.grams.items():
            hashes, weights, text, at = texts.shingles(size)
            hit, post = rare.hits(hashes)
            if not len(hit):
                continue
            item, doc = rare.item[post], text[hit]
            first, n = texts.first[doc], lengths[item]
            # Every window that holds this shingle; a text shorter than the item is a single window.
            low = np.maximum(at[hit] + size - n, first)
            high = np.minimum(at[hit], np.maximum(texts.first[doc + 1] - n, first))
            order = np.lexsort((low, n, doc))
            bounds = np.flatnonzero(np.diff(doc[order], prepend=-1, append=-1) | np.diff(n[order], prepend=-1, append=-1))
            for a, z in zip(bounds, bounds[1:], strict=False):
                own = order[a:z]
                k, words = int(doc[own[0]]), int(n[own[0]])
                among = np.searchsorted(self.known, np.unique(item[own]))
                best: dict[int, tuple] = {}
                end = int(texts.first[k + 1])
                for starts in _merged(low[own], high[own]):
                    ends = np.minimum(starts + words, end)
                    begin, stop = np.searchsorted(at, starts), np.searchsorted(at, ends - size, side="right")
                    away = self.within(rolling_simhash(hashes, weights, begin, stop), among)
                    for row in np.flatnonzero((away >= 0).any(axis=1)).tolist():
                        x = slice(int(begin[row]), int(stop[row]))
                        window = _multiset(hashes[x], weights[x].astype(float))
                        for column in np.flatnonzero(away[row] >= 0).tolist():
                            i = int(self.known[among[column]])
                            score = weighted_jaccard(window, self.sets[i])
                            if score >= self.similarity and score > best.get(i, (0, 0, -1.0))[2]:
                                start = int(starts[row])
                                best[i] = (start - int(texts.first[k]), int(ends[row]) - start, score, int(away[row, column]))
                yield from ((k, i, *found) for i, found in best.items())


def _merged(low: np.ndarray, high: np.ndarray) -> Iterator[np.ndarray]:
    """All numbers in the ranges low to high, each once, in stretches of at most ``STRETCH``; low is sorted."""
    until = np.maximum.accumulate(high)
    low = np.concatenate([low[:1], np.maximum(low[1:], until[:-1] + 1)])
    for a, z in zip(low.tolist(), until.tolist(), strict=True):
        for start in range(a, z + 1, STRETCH):
            yield np.arange(start, min(start + STRETCH, z + 1))


def rolling_simhash(hashes: np.ndarray, weights: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """``weighted_simhash`` of every run begin to stop, from running sums of the weights of each bit."""
    base = int(begin[0])
    part, weight = hashes[base : int(stop[-1])], weights[base : int(stop[-1])].astype(np.int64)
    bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(part) + 1, 65), dtype=np.int64)
    np.cumsum(np.concatenate([bits * weight[:, None], weight[:, None]], axis=1), axis=0, out=sums[1:])
    inside = sums[stop - base] - sums[begin - base]
    over = inside[:, :64] * 2 > inside[:, 64:]
    return np.packbits(over, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """doc_id, item_id and the best window for every document and item at least this similar.

    Words are runs of letters and digits, A-Z as a-z. An item of fewer than five words is one shingle; an
    item without words and a null text match nothing. Repeated rows are searched one by one; no match gives no rows.
    """
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).filter("text IS NOT NULL")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = -(-total // block_chars) or 1
    out = None
    for block in range(n_blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).collect()
        index = ItemIndex([r["item_id"] for r in part], [r["text"] for r in part], radius, similarity)
        found = _search(docs, index)
        out = found if out is None else out.unionByName(found)
    return out


def _search(docs: DataFrame, index: ItemIndex) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, data, offsets in text_slices(batch.column(1)):
                found = list(index.search(data, offsets))
                if not found:
                    continue
                text, item, start, words, score, away = (list(c) for c in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([row + t for t in text])),
                        pa.array([index.item_ids[i] for i in item], pa.int64()),
                        pa.array(start, pa.int64()),
                        pa.array(words, pa.int32()),
                        pa.array([round(s, 6) for s in score], pa.float64()),
                        pa.array(away, pa.int32()),
                    ],
                    names=["doc_id", "item_id", "window_start", "window_words", "similarity", "hamming"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, MATCHES)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of documents that hold no benchmark item; all columns as they are. A null doc_id stays."""
    gone = stored(contaminated(docs, benchmark, similarity).select("doc_id").distinct(), "contaminated")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
