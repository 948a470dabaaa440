"""Token sequences written in training order: a keyed permutation gives every sequence its slot.

A sequence is a piece of at most ``stride`` ids of one document. (document, piece) is a number below
``n_ids * MAX_PIECES`` (ids may be any 64-bit numbers), and a keyed Feistel network over the next power of four, walked along its cycle
until the value is below that bound, permutes these numbers. The slot of a sequence is the rank of its
permuted number among those that exist: it depends on the key and the documents alone, not on the
number of partitions or shards. Equal parts of the permuted range are the shards, so one shuffle brings
every sequence to its shard, where it is written in order with a fixed stride: record r of a shard
begins at byte r * stride * 2, whatever the reader did before. The table of first slots tells the shard of any slot.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintner.llm import tokens
from vintner.llm.arrays import mixed
from vintner.llm.shared import appended, new_folder, stored

STRIDE = 256
KEY = 42
ROUNDS = 6
#: A text has at most 2**31 bytes, an id covers at least one, and the end id is one more.
MAX_PIECES = 2**31 // STRIDE + 1
END_ID = 2
#: A permuted number is two columns, as it has more than 63 bits where doc_ids are far apart.
LOW_BITS = 62


def feistel(values: np.ndarray, domain: int, key: int = KEY) -> np.ndarray:
    """A permutation of [0, domain) that the key selects, applied to many numbers at once."""
    half = half_bits(domain)
    values = values.astype(np.uint64)
    left, right = permuted(values >> np.uint64(half), values & np.uint64((1 << half) - 1), domain, key)
    return (left << np.uint64(half)) | right


def half_bits(domain: int) -> int:
    """Bits of each half of a number below the next power of four."""
    return max(1, (max(domain - 1, 1).bit_length() + 1) // 2)


def permuted(left: np.ndarray, right: np.ndarray, domain: int, key: int = KEY) -> tuple[np.ndarray, np.ndarray]:
    """The same permutation for numbers of any width, given and returned as halves of ``half_bits(domain)`` bits."""
    half = half_bits(domain)
    low = np.uint64((1 << half) - 1)
    last_left, last_right = np.uint64((domain - 1) >> half), np.uint64((domain - 1) & int(low))
    seeds = mixed(mixed(np.full(ROUNDS, key % 2**64, dtype=np.uint64)) + np.arange(ROUNDS, dtype=np.uint64))
    left, right = left.copy(), right.copy()
    todo = np.arange(len(left))
    while len(todo):
        a, b = left[todo], right[todo]
        for seed in seeds:
            a, b = b, a ^ (mixed(b ^ seed) & low)
        left[todo], right[todo] = a, b
        todo = todo[(a > last_left) | ((a == last_left) & (b > last_right))]
    return left, right


def numbered(known: np.ndarray, piece: np.ndarray, domain: int) -> tuple[np.ndarray, np.ndarray]:
    """Halves of ``known * MAX_PIECES + piece``, exact although it may need more than 64 bits."""
    half, word = half_bits(domain), np.uint64(32)
    pieces, mask = np.uint64(MAX_PIECES), np.uint64(2**32 - 1)
    low = (known & mask) * pieces + piece
    high = (known >> word) * pieces + (low >> word)
    low &= mask
    if half <= 32:
        return (high << np.uint64(32 - half)) | (low >> np.uint64(half)), low & np.uint64((1 << half) - 1)
    beyond = np.uint64(half - 32)
    return high >> beyond, ((high & np.uint64((1 << (half - 32)) - 1)) << word) | low


def _sequences(path: str, stride: int, first_id: int, domain: int, n_shards: int, key: int):
    half = half_bits(domain)
    lefts = np.uint64(((domain - 1) >> half) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = tokens.encoder(path), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                doc_ids, piece, crcs, packed = [], [], [], []
                part = batch.slice(at, 256)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    ids = np.array([*encode(text.as_py() or ""), END_ID], dtype="<u2")
                    for k in range(0, len(ids), stride):
                        body = ids[k : k + stride].tobytes()
                        doc_ids.append(doc_id)
                        piece.append(k // stride)
                        crcs.append(zlib.crc32(body))
                        packed.append(packer.compress(body))
                # Differences of 64-bit ids are exact as unsigned numbers, also where the signed ones wrap.
                known = np.array([first_id if d is None else d for d in doc_ids], dtype=np.int64).view(np.uint64)
                known = known - np.array([first_id], dtype=np.int64).view(np.uint64)
                number = numbered(known, np.array(piece, dtype=np.uint64), domain)
                left, right = permuted(*number, domain, key)
                place = ((left << np.uint64(half)) | right) & np.uint64(2**LOW_BITS - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((left * np.uint64(n_shards) // lefts).astype(np.int32)),
                        pa.array((left >> np.uint64(LOW_BITS - half)).astype(np.int64)),
                        pa.array(place.astype(np.int64)),
                        pa.array(doc_ids, pa.int64()),
                        pa.array(piece, pa.int32()),
                        pa.array(crcs, pa.int64()),
                        pa.array(packed, pa.binary()),
                    ],
                    names=["shard", "place_high", "place", "doc_id", "piece", "ids_crc32", "ids"],
                )

    return run


SEQUENCES = "shard int, place_high long, place long, doc_id long, piece int, ids_crc32 long, ids binary"
WRITTEN = "shard int, record long, doc_id long, piece int, length int, ids_crc32 long, path string"


def _writer(folder: str, stride: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        store, root = fs.FileSystem.from_uri(folder)
        attempt, out, shard, record = f"{root}/.{uuid.uuid4().hex}", None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                shard = batch.column("shard")[0].as_py()
                out = store.open_output_stream(attempt)
            lengths = []
            for ids in batch.column("ids"):
                body = unpack.decompress(ids.as_py())
                lengths.append(len(body) // 2)
                out.write(body.ljust(stride * 2, b"\0"))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("shard"),
                    pa.array(np.arange(record, record + n)),
                    batch.column("doc_id"),
                    batch.column("piece"),
                    pa.array(lengths, pa.int32()),
                    batch.column("ids_crc32"),
                    pa.array([f"{folder}/shard-{shard:06d}.bin"] * n),
                ],
                names=["shard", "record", "doc_id", "piece", "length", "ids_crc32", "path"],
            )
            record += n
        if out is not None:
            out.close()
            # A repeated attempt writes the same bytes; the last one to end replaces the file as a whole.
            store.move(attempt, f"{root}/shard-{shard:06d}.bin")

    return run


def materialise(
    docs: DataFrame,
    path: str | None = None,
    stride: int = STRIDE,
    key: int = KEY,
    n_shards: int | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Write the shards; one row per sequence: slot, shard, record, byte_offset, doc_id, piece, length, ids_crc32, path.

    ``record`` counts within the shard and ``slot`` from 0 over all of them. ``ids_crc32`` is that of the
    sequence's ids as little-endian 16-bit numbers without padding (zeros up to the stride). A null or
    empty text is one sequence that holds the end id alone. A null doc_id shares the place of the smallest
    one, and repeated ids share theirs: ties are put in the order of doc_id, piece and ids. The number
    of shards is that of the shuffle partitions unless given. The vocabulary must have at most 2**16 ids.
    """
    spark = docs.sparkSession
    path, folder = path or tokens.default_path(), folder or new_folder(spark, "shards")
    n_shards = n_shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ends = docs.select(F.col("doc_id").cast("long").alias("i")).agg(F.min("i").alias("a"), F.max("i").alias("b")).first()
    first_id = 0 if ends["a"] is None else ends["a"]
    domain = ((first_id if ends["b"] is None else ends["b"]) - first_id + 1) * MAX_PIECES
    run = _sequences(path, stride, first_id, domain, n_shards, key)
    sequences = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SEQUENCES)
    shards = sequences.repartitionById(n_shards, F.col("shard")).sortWithinPartitions(
        "place_high", "place", "doc_id", "piece", "ids_crc32", "ids"
    )
    index = stored(shards.mapInArrow(_writer(folder, stride), WRITTEN), "shard-index")
    # One number per shard.
    sizes = index.groupBy("shard").agg(F.count("*").alias("n")).orderBy("shard").collect()
    first_slots, at = [], 0
    for row in sizes:
        first_slots.append((row["shard"], at))
        at += row["n"]
    table = spark.createDataFrame(first_slots, "shard int, first_slot long")
    return index.join(F.broadcast(table), "shard").select(
        (F.col("first_slot") + F.col("record")).alias("slot"),
        "shard",
        "record",
        (F.col("record") * stride * 2).alias("byte_offset"),
        "doc_id",
        "piece",
        "length",
        "ids_crc32",
        "path",
    )


def read_shards(written: DataFrame) -> DataFrame:
    """The rows of a written table with their ids (16-bit little-endian), read from the shard files.

    Rows are read where they are asked for: filter the table by slot to resume in the middle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, source = None, None
        for batch in batches:
            ids = []
            columns = (batch.column(c).to_pylist() for c in ("path", "byte_offset", "length"))
            for path, at, length in zip(*columns, strict=True):
                if path != open_:
                    store, inner = fs.FileSystem.from_uri(path)
                    open_, source = path, store.open_input_file(inner)
                ids.append(source.read_at(length * 2, at))
            yield appended(batch, ids=pa.array(ids, pa.binary()))

    return written.mapInArrow(run, T.StructType([*written.schema.fields, T.StructField("ids", T.BinaryType())]))
