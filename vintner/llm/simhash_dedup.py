"""Near-duplicates by SimHash fingerprints, compared in bit-sliced blocks.

Fingerprints within the radius agree on some combination of blocks of their bits, so each is dealt to a
bucket per combination. A bucket holds its fingerprints as bit planes: plane p has bit p of 64 of them in
one machine word. A fingerprint is compared with a whole bucket by adding, plane by plane, the words of
differing bits to carry-save counters that start so high that the (radius + 1)-th difference overflows;
a word of 64 distances leaves the comparison once all of them have overflowed.

Equal fingerprints are one row before anything is compared, and a bucket with too many different ones is
dealt again by combinations of its other bits, which loses no pair; after two such steps so few
bits are left free that no bucket can hold more than 2**15. A bucket returns a spanning forest of its links,
never all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintner.llm.components import components
from vintner.llm.shared import stored

RADIUS = 2
SHINGLE = 3
SEED = 42
BUCKET = 4096
_FULL = np.uint64(2**64 - 1)
_QUERIES = 64

# Bit k of a byte in byte k of a word: up to 255 such words can be added without a carry between bits.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view(np.uint64)[:, 0]


def fingerprint(text: bytes) -> int:
    """The 64-bit SimHash of the shingles of a text: bits set in over half of their hashes."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    runs = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)), strict=False))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), dtype="<u8", count=len(words) - SHINGLE + 1)
    n = len(hashes)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 255 * 64):
        part = hashes[at : at + 255 * 64].view(np.uint8).reshape(-1, 8)
        part = np.concatenate([part, np.zeros((-len(part) % 255, 8), dtype=np.uint8)]).reshape(-1, 255, 8)
        counts += _SPREAD[part].sum(axis=1).view(np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (its 64 bits as a long) of every row; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            prints = np.fromiter((fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in texts), "<u8", len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fingerprint"]
            )

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return slim.mapInArrow(run, "doc_id long, fingerprint long")


def _split_bits(bits: list[int], parts: int) -> list[int]:
    """Masks of ``parts`` runs of about equal length of these bits."""
    cut = [len(bits) * i // parts for i in range(parts + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(cut, cut[1:], strict=False)]


def first_masks(radius: int) -> list[int]:
    """Bits that must be equal, one mask per bucket table: two of radius + 2 blocks."""
    blocks = _split_bits(list(range(64)), radius + 2)
    return [a | b for a, b in combinations(blocks, 2)]


def finer_masks(masks: list[int], radius: int) -> list[int]:
    """For every mask, radius + 1 masks that add a part of the bits that it leaves free."""
    free = [[b for b in range(64) if not mask >> b & 1] for mask in masks]
    return [mask | part for mask, bits in zip(masks, free, strict=True) for part in _split_bits(bits, radius + 1)]


def near_pairs(members: np.ndarray, mask: int, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """(i, all j > i within the radius of member i) by bit-sliced comparison; members agree on the mask."""
    n = len(members)
    width = -(-n // 64)
    free = [b for b in range(64) if not mask >> b & 1]
    bits = (members[None, :] >> np.array(free, dtype=np.uint64)[:, None]) & np.uint64(1)
    padded = np.zeros((len(free), width * 64), dtype=np.uint8)
    padded[:, :n] = bits
    planes = np.packbits(padded, axis=1, bitorder="little").view("<u8")
    depth = (radius + 1).bit_length()
    start = (1 << depth) - (radius + 1)
    for first in range(0, n, _QUERIES):
        queries = np.arange(first, min(first + _QUERIES, n))
        words = np.arange(first // 64, width)
        flips = np.where(padded[:, queries], _FULL, np.uint64(0))
        shape = (len(queries), len(words))
        counters = [np.full(shape, _FULL if start >> k & 1 else 0, dtype=np.uint64) for k in range(depth)]
        over = np.zeros(shape, dtype=np.uint64)
        for p in range(len(free)):
            carry = planes[p][words][None, :] ^ flips[p][:, None]
            for k in range(depth):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            over |= carry
            if p % 8 == 7:
                alive = (over != _FULL).any(axis=0)
                if not alive.all():
                    words, over = words[alive], over[:, alive]
                    counters = [c[:, alive] for c in counters]
                    if not len(words):
                        break
        if not len(words):
            continue
        near = np.unpackbits(np.ascontiguousarray(~over).view(np.uint8), axis=1, bitorder="little").astype(bool)
        index = (words[:, None] * 64 + np.arange(64)).ravel()
        near &= (index < n)[None, :] & (index[None, :] > queries[:, None])
        for row in np.flatnonzero(near.any(axis=1)):
            yield int(queries[row]), index[near[row]]


def forest(members: np.ndarray, mask: int, radius: int) -> list[tuple[int, int]]:
    """Links that connect all members that links within the radius connect: one less than members, at most."""
    label = np.arange(len(members))
    for i, others in near_pairs(members, mask, radius):
        joined = np.unique(label[np.append(others, i)])
        if len(joined) > 1:
            label[np.isin(label, joined)] = joined[0]
    linked = np.flatnonzero(label != np.arange(len(members)))
    return list(zip(members[linked].tolist(), members[label[linked]].tolist(), strict=True))


def _links_in_buckets(masks: list[int], radius: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((3, 0), dtype=np.int64)
        for last, batch in _with_end(batches):
            if batch is not None and batch.num_rows:
                rest = np.concatenate([rest, np.stack([c.to_numpy().astype(np.int64) for c in batch.columns])], axis=1)
            if not rest.shape[1]:
                continue
            change = np.flatnonzero((np.diff(rest[0]) != 0) | (np.diff(rest[1]) != 0)) + 1
            bounds = [0, *change.tolist(), *([rest.shape[1]] if last else [])]
            pairs: list[tuple[int, int]] = []
            for a, b in zip(bounds, bounds[1:], strict=False):
                if b - a > 1:
                    members = rest[2, a:b].view(np.uint64)
                    pairs += forest(members, masks[int(rest[0, a])], radius)
            rest = rest[:, bounds[-1] :]
            if pairs:
                both = np.array(pairs, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    return run


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch | None]]:
    for batch in batches:
        yield False, batch
    yield True, None


def links(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links among the distinct fingerprints of column ``fingerprint`` that connect all within the radius."""
    masks = first_masks(radius)
    dealt = prints.select(
        "fingerprint",
        F.explode(
            F.array(*(F.struct(F.lit(t).alias("t"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks)))
        ).alias("at"),
    ).select("at.t", "at.key", "fingerprint")
    found = None
    for level in range(3):
        cold, hot = dealt, None
        if level < 2:
            hot = stored(dealt.groupBy("t", "key").count().filter(F.col("count") > bucket).drop("count"), "hot-buckets")
            if hot.isEmpty():
                hot = None
            else:
                cold = dealt.join(hot, ["t", "key"], "left_anti")
        here = (
            cold.repartition("t", "key")
            .sortWithinPartitions("t", "key")
            .mapInArrow(_links_in_buckets(masks, radius), "a long, b long")
        )
        found = here if found is None else found.unionByName(here)
        if hot is None:
            break
        masks = finer_masks(masks, radius)
        parts = radius + 1
        choices = F.array(*(F.lit(_signed(m)) for m in masks))
        finer = F.explode(F.array(*(F.col("t") * parts + k for k in range(parts))))
        dealt = (
            dealt.join(hot, ["t", "key"], "left_semi")
            .select("fingerprint", finer.alias("t"))
            .withColumn("key", F.col("fingerprint").bitwiseAND(F.element_at(choices, F.col("t") + 1)))
            .select("t", "key", "fingerprint")
        )
    return found


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def classes(docs: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    ``component_id`` is the smallest doc_id that can be reached over links, a document's own included.
    A null doc_id takes part but is never a smallest one (a class of nulls alone has a null id). Texts
    without words share the fingerprint zero. Repeated rows stay, each with the same result.
    """
    prints = stored(fingerprints(docs), "fingerprints")
    distinct = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(links(distinct.select("fingerprint"), radius, bucket))
    rooted = stored(
        distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
            "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
        ),
        "rooted",
    )
    least = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    # Joined from stored tables throughout, so that a class or fingerprint of many rows can be split.
    named = stored(rooted.join(least, "root").select("fingerprint", "component_id"), "class-ids")
    return prints.join(named, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """The rows of one document of each class, that with the smallest doc_id; all columns as they are.

    Rows that repeat a doc_id count as one document, of which one row stays. Rows without a doc_id
    cannot be told apart and stay.
    """
    found = classes(docs, radius, bucket)
    gone = stored(found.filter("doc_id <> component_id").select("doc_id").distinct(), "copies")
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    again = stored(
        docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated-ids"
    )
    if again.isEmpty():
        return kept
    once = kept.join(again, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    return kept.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(once)
