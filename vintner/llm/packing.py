"""Best-fit packing of tokenised documents into sequences of a fixed capacity, exact fits first.

Lengths go up to the capacity, so the whole packing can be planned on the number of pieces of each
length: at most ``capacity`` numbers, however many documents there are. The plan is a list of patterns
(a set of lengths that share a sequence) and how often each is used. Every document's piece then finds
its place by its length and its rank among the pieces of that length.

Exact complements come first. For the longest length left, the gap to the capacity is looked up among
single lengths, sums of two and sums of three lengths; a combination that fills the gap exactly is used
as often as the pieces at hand allow. What no combination completes is placed by best fit, longest
first: into the open sequence with the smallest gap that is large enough, or into a new one. Exact fits
that spend the short pieces leave long ones without company, so several ways to spend them are planned
(they cost milliseconds each, whatever the number of documents) and the one with the fewest sequences is used.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintner.llm import tokens
from vintner.llm.shared import stored

CAPACITY = 1024
END_ID = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all full but the first, which takes what is left over."""
    first = n % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document; a null text counts as empty.

    An empty text is one piece that holds the end id alone. Other columns are not read. Rows that repeat
    a doc_id are packed one by one.
    """
    path = path or tokens.default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), end_id], dtype="<u4")
                for k, (at, length) in enumerate(cut_points(len(ids), capacity)):
                    rows.append((doc_id, k, at, length, zlib.crc32(ids[at : at + length].tobytes())))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


class Complements:
    """Lengths at hand with their counts, and the combinations of up to three that add up to a gap."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in counts.items():
            self.left[length] = n

    def _usable(self, lengths: tuple[int, ...]) -> int:
        """How often all these lengths can be taken together."""
        return min(int(self.left[x]) // lengths.count(x) for x in set(lengths))

    def _pair(self, total: int, taken: int) -> tuple[int, int] | None:
        """Two lengths of this sum, the larger one as large as can be; ``taken`` needs one piece itself."""
        high = np.arange(total - 1, (total + 1) // 2 - 1, -1)
        need_high = 1 + (high == taken) + (high * 2 == total)
        need_low = 1 + (total - high == taken) + (high * 2 == total)
        found = np.flatnonzero((self.left[high] >= need_high) & (self.left[total - high] >= need_low))
        return None if not len(found) else (int(high[found[0]]), int(total - high[found[0]]))

    def fill(self, length: int, gap: int, most: int, least: int) -> tuple[int, ...] | None:
        """Up to ``most`` (1 to 3) lengths that fill the gap beside a piece of ``length``, or None.

        Sums of two and three lengths use none below ``least``.
        """
        if self.left[gap] >= 1 + (gap == length):
            return (gap,)
        held, self.left[:least] = self.left[:least].copy(), 0
        try:
            if most >= 2 and gap >= 2 and (pair := self._pair(gap, length)):
                return pair
            for first in np.flatnonzero(self.left[: max(gap - 1, 0)])[::-1] if most >= 3 else ():
                first = int(first)
                if first * 3 < gap:
                    break
                if (pair := self._pair(gap - first, length)) and self._usable((length, first, *pair)):
                    return (first, *pair)
            return None
        finally:
            self.left[:least] = held


#: Ways to plan, of which the one with the fewest sequences is taken: how many lengths may fill a gap, and
#: the shortest length that sums use (shorter ones stay for the best fit, which needs them at the end).
WAYS = [(1, 1), *((most, least) for most in (2, 3) for least in (1, 16, 128, 200, 256, 320))]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how often each is used; all pieces counted are placed, no pattern is over the capacity."""
    plans = [_plan(counts, capacity, most, least * capacity // CAPACITY) for most, least in WAYS]
    return min(plans, key=lambda p: sum(uses for _, uses in p))


def _plan(counts: dict[int, int], capacity: int, most: int, least: int) -> list[tuple[tuple[int, ...], int]]:
    at_hand = Complements(counts, capacity)
    patterns: list[tuple[tuple[int, ...], int]] = []
    if at_hand.left[capacity]:
        patterns.append(((capacity,), int(at_hand.left[capacity])))
        at_hand.left[capacity] = 0
    for up_to in range(1, most + 1):
        for length in range(capacity - 1, 0, -1):
            while at_hand.left[length] and (
                others := at_hand.fill(length, capacity - length, up_to, min(least, length))
            ):
                pattern = (length, *others)
                uses = at_hand._usable(pattern)
                for x in pattern:
                    at_hand.left[x] -= uses
                patterns.append((pattern, uses))
    open_: list[tuple[int, tuple[int, ...], int]] = []  # gap, lengths, how many; by gap
    for length in range(capacity - 1, 0, -1):
        n = int(at_hand.left[length])
        while n:
            k = bisect_left(open_, (length,))
            if k == len(open_):
                each = min(capacity // length, n)
                insort(open_, (capacity - each * length, (length,) * each, n // each))
                n -= each * (n // each)
                continue
            gap, lengths, bins = open_.pop(k)
            uses = min(n, bins)
            if bins > uses:
                insort(open_, (gap, lengths, bins - uses))
            insort(open_, (gap - length, (*lengths, length), uses))
            n -= uses
    return patterns + [(lengths, bins) for _, lengths, bins in open_]


def places(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of each length go, by rank.

    (length, first rank, one past the last rank, sequence of the first rank, offset, how many a sequence
    takes side by side) for every length of every pattern.
    """
    used: dict[int, int] = {}
    out, sequence = [], 0
    for lengths, uses in patterns:
        offset = 0
        for x, each in Counter(lengths).items():
            rank = used.get(x, 0)
            used[x] = rank + each * uses
            out.append((x, rank, used[x], sequence, offset, each))
            offset += x * each
        sequence += uses
    return out


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of all documents, each with its sequence_id and its offset there (gapless from 0).

    Equal lengths are interchangeable; ranks among them follow a hash of doc_id and piece. A length that
    very many pieces share is ranked in buckets, never in one task. An empty table gives no rows.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, path, capacity, end_id), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # Each pattern uses up the pieces of a length or the sequences with one gap: a few times the capacity.
    chosen = places(plan(counts, capacity))
    table = spark.createDataFrame(
        chosen, "length long, first_rank long, end_rank long, first_sequence long, first_offset long, each long"
    )
    n_buckets = max(64, sum(counts.values()) // 20_000)
    order = F.xxhash64("doc_id", "piece", "ids_crc32")
    placed = cut.withColumn("bucket", F.pmod(order, F.lit(n_buckets)).cast("int"))
    sizes = placed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = sizes.select(
        "length",
        "bucket",
        (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"),
    )
    within = Window.partitionBy("length", "bucket").orderBy(order, "doc_id", "piece")
    ranked = (
        placed.withColumn("number", F.row_number().over(within) - 1)
        .join(before, ["length", "bucket"])
        .withColumn("rank", F.col("before") + F.col("number"))
    )
    in_place = (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank"))
    step = F.col("rank") - F.col("first_rank")
    return (
        ranked.join(F.broadcast(table), "length")
        .filter(in_place)
        .select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("first_sequence") + F.floor(step / F.col("each"))).alias("sequence_id"),
            (F.col("first_offset") + step % F.col("each") * F.col("length")).alias("offset"),
        )
    )
