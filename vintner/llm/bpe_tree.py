"""Byte-level BPE encoding and decoding as a tree of joins.

Texts under concatenation are a monoid, and so are their encodings once it is known how to join two of
them. A text is halved until its parts are short; the parts are encoded by themselves, and neighbours
are joined on the way up. A join looks at a window around the border only and widens it until nothing
outside can change:

* *Cuts into pieces.* The pattern never looks back, so a piece of the left part stands if all that its match
  looked at lies in the left part; from the first other piece on the text is matched anew until a cut
  meets a cut of the right part, and from there on the right part's pieces stand.
* *Tokens of a piece.* Merges go by rank, leftmost first. If every two neighbouring tokens are what their own
  bytes alone encode to, no merge crosses any border between them: the order of merges inside two
  neighbours does not depend on the rest, so the first merge across a border would also happen in the pair
  alone. A window is thus wide enough once its outermost tokens fit their neighbours outside.

An encoding is kept as one tuple of ids per piece; a piece's text is had back by decoding its ids.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts of a text that are matched at once, and parts of a piece that are merged at once.
LEAF_CHARS, LEAF_BYTES = 4096, 32
#: Ids decoded at once.
LEAF_IDS = 4096
#: Pieces up to this length are remembered, so many at most, and as many pairs of tokens.
SHORT, REMEMBERED = 48, 1 << 19
#: No match looks at more characters than this from its start, but for those it takes and the one after them.
AHEAD = 3


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _half(n: int, unit: int) -> int:
    """Where to cut n: the largest unit times a power of two below n, so that runs of one character keep step."""
    at = unit
    while 2 * at < n:
        at *= 2
    return at


class Codec:
    """Encoder and decoder for a file of ranks (a base64 token and its rank per line) and a pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self._longest = max(map(len, self.ranks))  # no longer piece is a token
        self._pattern = regex.compile(pattern)
        self._fits: dict[tuple[int, int], bool] = {}
        self._whole: dict[int, bool] = {}
        self._pieces: dict[str, tuple[int, ...]] = {}

    # Tokens of a piece

    def merged(self, data: bytes) -> list[int]:
        """Ids of a run of bytes by merges alone: the pair of lowest rank first, the leftmost of equals."""
        if len(data) > LEAF_BYTES:
            return self._merged_by_heap(data)
        get, never = self.ranks.get, 1 << 62
        cuts = list(range(len(data) + 1))
        ranks = [get(data[i : i + 2], never) for i in range(len(data) - 1)]  # of parts i and i + 1 as one
        while ranks and (least := min(ranks)) != never:
            i = ranks.index(least)
            del cuts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(data[cuts[i - 1] : cuts[i + 1]], never)
            if i < len(ranks):
                ranks[i] = get(data[cuts[i] : cuts[i + 2]], never)
        return [self.ranks[data[a:b]] for a, b in zip(cuts, cuts[1:])]  # noqa: B905

    def _merged_by_heap(self, data: bytes) -> list[int]:
        n, ranks = len(data), self.ranks
        ends = list(range(1, n + 1))  # of the part that starts here; 0 once it is merged away
        before = list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            middle = ends[i]
            if not middle or middle == n or ranks.get(data[i : ends[middle]]) != rank:
                continue  # a part of it has been merged meanwhile
            end = ends[i] = ends[middle]
            ends[middle] = 0
            if end < n:
                before[end] = i
                if (r := ranks.get(data[i : ends[end]])) is not None:
                    heappush(heap, (r, i))
            if (left := before[i]) >= 0 and (r := ranks.get(data[left:end])) is not None:
                heappush(heap, (r, left))
        out, at = [], 0
        while at < n:
            out.append(ranks[data[at : ends[at]]])
            at = ends[at]
        return out

    def fit(self, left: int, right: int) -> bool:
        """Whether the two tokens are what their bytes alone encode to."""
        found = self._fits.get((left, right))
        if found is None:
            if len(self._fits) >= REMEMBERED:
                self._fits.clear()
            found = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
            self._fits[left, right] = found
        return found

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of two neighbouring runs of bytes, from the ids of each."""
        if not left or not right:
            return left or right
        if self.fit(left[-1], right[0]):
            return left + right
        i, j = len(left) - 1, 1
        while True:
            window = self.merged(self.decoded(left[i:]) + self.decoded(right[:j]))
            wider_left = i > 0 and not self.fit(left[i - 1], window[0])
            wider_right = j < len(right) and not self.fit(window[-1], right[j])
            if not wider_left and not wider_right:
                return left[:i] + window + right[j:]
            if wider_left:
                i = max(0, 2 * i - len(left))
            if wider_right:
                j = min(len(right), 2 * j)

    def _tree(self, data: bytes) -> list[int]:
        if len(data) <= LEAF_BYTES:
            return self.merged(data)
        half = _half(len(data), LEAF_BYTES)
        return self.joined(self._tree(data[:half]), self._tree(data[half:]))

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of one match of the pattern. A piece that is a token is that token, however its merges go."""
        found = self._pieces.get(text)
        if found is None:
            data = text.encode("utf-8")
            found = (self.ranks[data],) if data in self.ranks else tuple(self._tree(data))
            if len(text) <= SHORT:
                if len(self._pieces) >= REMEMBERED:
                    self._pieces.clear()
                self._pieces[text] = found
        return found

    def _reached(self, ids: tuple[int, ...]) -> list[int]:
        """Ids of a piece as merges alone make them."""
        if len(ids) > 1:
            return list(ids)
        whole = self._whole.get(ids[0])
        if whole is None:
            whole = self._whole[ids[0]] = self.merged(self.bytes_of[ids[0]]) == list(ids)
        return list(ids) if whole else self.merged(self.bytes_of[ids[0]])

    # Pieces of a text

    def _chars(self, ids: tuple[int, ...]) -> int:
        return len(self.decoded(ids).decode("utf-8"))

    def _across(self, text: str, left: list[tuple[int, ...]], middle: int, right: list[tuple[int, ...]], end: int):
        """Pieces of a part of a text from those of its two halves, which meet at ``middle``."""
        start, last = middle, None
        while left and (last is None or start + AHEAD > middle):
            last = (start - self._chars(left[-1]), start, left.pop())
            start = last[0]
        at, k, cut, window = start, 0, middle, []
        while at < end and not (at == cut and at > middle):
            stop = self._pattern.match(text, at, end).end()
            first = k
            while cut < stop:
                cut += self._chars(right[k])
                k += 1
            one_each = last is not None and last[:2] == (at, middle) and k == first + 1 and stop == cut
            if one_each and stop - at > self._longest:
                window.append(tuple(self.joined(self._reached(last[2]), self._reached(right[first]))))
            else:
                window.append(self.piece(text[at:stop]))
            at = stop
        left += window
        left += right[k:]
        return left

    def _part(self, text: str, start: int, end: int) -> list[tuple[int, ...]]:
        if end - start <= LEAF_CHARS:
            known, piece = self._pieces, self.piece
            found = self._pattern.findall(text, start, end)
            return [known.get(x) or piece(x) for x in found]
        half = start + _half(end - start, LEAF_CHARS)
        return self._across(text, self._part(text, start, half), half, self._part(text, half, end), end)

    def encoded(self, text: str) -> array:
        """Ids of a text as 32-bit unsigned integers."""
        return array("I", chain.from_iterable(self._part(text, 0, len(text))))

    def decoded(self, ids) -> bytes:
        """The bytes of ids: those of each half, one after the other."""
        if len(ids) <= LEAF_IDS:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = _half(len(ids), LEAF_IDS)
        return self.decoded(ids[:half]) + self.decoded(ids[half:])


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _little_endian(ids: array) -> array:
    import sys

    if sys.byteorder == "big":
        ids = ids[:]
        ids.byteswap()
    return ids


def with_ids(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and ``ids``, the ids of the whole text as little-endian unsigned 32-bit integers in binary.

    A null or empty text has no ids; bytes that are not UTF-8 are read as U+FFFD. Rows that repeat a
    doc_id are encoded one by one; other columns are not read. Special tokens are not matched. The pattern
    must match every text without a gap, not look back and not look further ahead than ``AHEAD`` characters
    from its start or one character after its end; the default one does so.
    """
    path, pattern = path or default_path(), pattern or default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            texts = (t.as_py() or b"" for t in batch.column(1))
            ids = [_little_endian(own.encoded(t.decode("utf-8", "replace"))).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, f"doc_id {kind}, ids binary")


def with_bytes(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """The rows of ``with_ids`` with ``decoded``, the bytes their ids stand for; without ids there are none."""
    path, pattern = path or default_path(), pattern or default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            out = []
            for data in batch.column(1):
                ids = array("I", data.as_py() or b"")
                out.append(own.decoded(_little_endian(ids)))
            names = ["doc_id", "ids", "decoded"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=names)

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary")
