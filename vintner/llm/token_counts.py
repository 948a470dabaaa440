"""Token counts that follow edits: only the touched regions of a document are encoded again.

A document is held as a segment tree. Its leaves are stretches of text cut where the vocabulary always
cuts (before a single space between two other characters), so the ids of the document are those of its
leaves one after the other, and a node's count is the sum of its children's. An edit rewrites the leaves
it touches. Where the new text would let a piece run over a leaf's border (the border is no longer a
single space between two other characters), the neighbour is encoded with it.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintner.llm import tokens

LEAF_CHARS = 256
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Runs that look like a number of a card, a telephone or an address in a network.
NUMBERS = r"[0-9](?:[0-9. ()-]{5,}[0-9])"
MASK = "0"
RESULT = "doc_id long, n_tokens long, n_edits long, n_tokens_edited long, n_chars_encoded_again long"


def _joins_cleanly(left: str, right: str) -> bool:
    """Whether the vocabulary cuts between these two texts, whatever else they hold."""
    return bool(left) and len(right) > 1 and not left[-1].isspace() and right[0] == " " and not right[1].isspace()


class CountTree:
    """The token count of one text, kept up to date under edits."""

    def __init__(self, text: str, encode: Callable[[str], list[int]], leaf_chars: int = LEAF_CHARS):
        self._encode = encode
        starts = [0]
        while (found := _CUT.search(text, starts[-1] + leaf_chars)) is not None:
            starts.append(found.start())
        self.leaves = [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)], strict=True)]
        self._size = 1
        while self._size < len(self.leaves):
            self._size *= 2
        self._sums = [0] * (2 * self._size)
        for i, leaf in enumerate(self.leaves):
            self._sums[self._size + i] = len(encode(leaf))
        for node in range(self._size - 1, 0, -1):
            self._sums[node] = self._sums[2 * node] + self._sums[2 * node + 1]
        self.chars_encoded_again = 0

    @property
    def total(self) -> int:
        return self._sums[1]

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    def _set(self, leaf: int, text: str) -> None:
        self.leaves[leaf] = text
        node = self._size + leaf
        change = (len(self._encode(text)) if text else 0) - self._sums[node]
        self.chars_encoded_again += len(text)
        while node and change:
            self._sums[node] += change
            node //= 2

    def _starts(self) -> list[int]:
        return [0, *accumulate(map(len, self.leaves))][:-1]

    def apply(self, edits: Iterable[tuple[int, int, str]]) -> None:
        """Replace [start, end) of the present text by a new text, for edits that do not overlap."""
        todo = sorted(edits, key=lambda e: e[:2])
        starts, before = self._starts(), list(self.leaves)
        leaf_of = lambda at: bisect_right(starts, at) - 1
        k = 0
        while k < len(todo):
            first = last = leaf_of(todo[k][0])
            mine: list[tuple[int, int, str]] = []
            while True:
                while k < len(todo) and leaf_of(todo[k][0]) <= last:
                    last = max(last, leaf_of(max(todo[k][1] - 1, todo[k][0])))
                    mine.append(todo[k])
                    k += 1
                text = _edited("".join(before[first : last + 1]), starts[first], mine)
                if last + 1 == len(before) or _joins_cleanly(text, before[last + 1]):
                    break
                last += 1
            changed = range(first, last + 1)
            left = first - 1
            while left >= 0 and not _joins_cleanly(self.leaves[left], text):
                text = self.leaves[left] + text
                left -= 1
            for i in range(left + 2, changed.stop):
                self._set(i, "")
            self._set(left + 1, text)


def _edited(text: str, offset: int, edits: list[tuple[int, int, str]]) -> str:
    parts, at = [], 0
    for start, end, new in edits:
        parts += [text[at : start - offset], new]
        at = end - offset
    return "".join([*parts, text[at:]])


def mask_numbers(text: str, pattern: str = NUMBERS) -> list[tuple[int, int, str]]:
    """Edits that replace every match of the pattern."""
    return [(m.start(), m.end(), MASK) for m in re.finditer(pattern, text)]


def drop_repeated_lines(text: str) -> list[tuple[int, int, str]]:
    """Edits that delete every line that is equal to an earlier one, with the line break before it."""
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return []
    seen: set[str] = set()
    edits, at = [], 0
    for line in lines:
        if line in seen:
            edits.append((at - 1, at + len(line), ""))
        seen.add(line)
        at += len(line) + 1
    return edits


def counts_after_edits(
    docs: DataFrame,
    path: str | None = None,
    rounds: tuple[Callable[[str], list[tuple[int, int, str]]], ...] = (mask_numbers, drop_repeated_lines),
) -> DataFrame:
    """Per document: ids of the text, number of edits, ids after all rounds of edits, characters encoded again.

    Each round is a function from the present text to edits that do not overlap. A null or empty text has
    no ids; rows that repeat a doc_id are counted one by one; other columns are not read.
    """
    path = path or tokens.default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                tree = CountTree(text.as_py() or "", encode)
                n_tokens, n_edits = tree.total, 0
                for edits_of in rounds:
                    if edits := edits_of(tree.text):
                        tree.apply(edits)
                        n_edits += len(edits)
                rows.append((n_tokens, n_edits, tree.total, tree.chars_encoded_again))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            names = ["doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_chars_encoded_again"]
            arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, RESULT)
