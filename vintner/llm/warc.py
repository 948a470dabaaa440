"""WARC archives of pages: written as whole-file gzip streams, normalised to one member per record, read back.

The writer is Spark's own text sink: a record is a row, the two line breaks that end it are the line
separator, and the sink compresses a file as one gzip stream. Such files can only be read from the
start. The normaliser inflates each once, writes every record as a gzip member of its own and notes where it
begins in an index beside the archive, after which any record can be read alone. A task holds one record
at a time.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintner.llm.shared import new_folder, stored

#: Shortest payload in bytes of which a copy is written as a revisit.
LEAST_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
INDEX = "archive string, offset long, length long, record_type string, record_id string"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_CHUNK = 1 << 20


def with_types(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type and refers_to of every row.

    Of rows with equal payloads of at least ``least_bytes`` bytes, that with the largest page_id is the
    response and the others revisit it. A null html is an empty payload. Rows that repeat that largest
    page_id are responses all; a null page_id is never the largest, and copies that all have none are responses.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    held = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    held = held.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    long_ = held.filter(F.col("payload_bytes") >= least_bytes)
    # Digests of one row need no answer, so this table is small unless copies are many.
    copied = long_.groupBy("payload_digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    copied = stored(copied.filter("n > 1 AND first IS NOT NULL").drop("n"), "copied-payloads")
    copy = (F.col("payload_bytes") >= least_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return held.join(copied, "payload_digest", "left").select(
        "page_id",
        "url",
        "payload",
        "payload_bytes",
        "payload_digest",
        F.when(copy, "revisit").otherwise("response").alias("record_type"),
        F.when(copy, F.col("first")).alias("refers_to"),
    )


def _record_id(page_id) -> F.Column:
    digest = F.sha1(F.concat(F.lit("page "), F.coalesce(page_id.cast("string"), F.lit("none"))))
    parts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_archives(typed: DataFrame, folder: str) -> None:
    """One gzip stream of WARC records per task in ``folder``; a revisit has no payload."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(END),
    )
    block = F.concat(http, F.when(F.col("record_type") == "response", F.col("payload")).otherwise(""))
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    refers = F.when(F.col("refers_to").isNotNull(), _record_id(F.col("refers_to")))
    profile = F.when(F.col("record_type") == "revisit", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.regexp_replace("url", r"\s", "%20")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Profile", profile),
        line("WARC-Refers-To", refers),
        line("WARC-Page", F.col("page_id").cast("string")),
        line("WARC-Refers-To-Page", F.col("refers_to").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
    )
    rows = typed.withColumn("block", block).select(F.concat(header, F.col("block")).alias("value"))
    rows.write.option("compression", "gzip").option("lineSep", END).text(folder)


class RecordError(ValueError):
    """The stream is not a sequence of WARC records."""


def records(chunks: Iterator[bytes]) -> Iterator[tuple[bytes, dict[str, str]]]:
    """(the record with its end, its header fields in lower case) from compressed chunks of one or more gzip members."""
    buffer = bytearray()
    plain = _inflated(chunks)

    def filled(n: int) -> bool:
        while len(buffer) < n:
            more = next(plain, None)
            if more is None:
                return False
            buffer.extend(more)
        return True

    while filled(1):
        at, seen = -1, 0
        while (at := buffer.find(b"\r\n\r\n", seen)) < 0:
            seen = max(0, len(buffer) - 3)
            if not filled(len(buffer) + 1):
                raise RecordError("a header does not end")
        fields = header_fields(bytes(buffer[:at]))
        total = at + 4 + int(fields["content-length"]) + 4
        if not filled(total) or buffer[total - 4 : total] != b"\r\n\r\n":
            raise RecordError("a record does not end where its length says")
        yield bytes(buffer[:total]), fields
        del buffer[:total]


def _inflated(chunks: Iterator[bytes]) -> Iterator[bytes]:
    stream = zlib.decompressobj(wbits=31)
    for chunk in chunks:
        while chunk:
            out = stream.decompress(chunk, _CHUNK)
            if out:
                yield out
            if stream.eof:
                chunk, stream = stream.unused_data, zlib.decompressobj(wbits=31)
            else:
                chunk = stream.unconsumed_tail
    rest = stream.flush()
    if rest:
        yield rest


def header_fields(header: bytes) -> dict[str, str]:
    first, *lines = header.decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise RecordError(f"not a WARC record: {first[:40]!r}")
    pairs = (line.partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _uri(path: str) -> str:
    return re.sub("^file:/+", "file:///", path)


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite every archive of ``source`` into ``target``, a member per record; the offset index of all records.

    Beside each archive lies its index (offset, length, type and id of each record, a line each). A repeated
    attempt writes the same bytes and replaces both files as a whole. No archives give an empty index.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                yield _normalised(_uri(path), target)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")
    return stored(files.mapInArrow(run, INDEX), "offset-index")


def _normalised(path: str, target: str) -> pa.RecordBatch:
    store, inner = fs.FileSystem.from_uri(path)
    out_store, root = fs.FileSystem.from_uri(target)
    name = re.sub(r"(\.txt)?\.gz$", "", path.rsplit("/", 1)[1]) + ".warc.gz"
    attempt, offset, rows = f"{root}/.{uuid.uuid4().hex}", 0, []
    with store.open_input_stream(inner, compression=None) as source, out_store.open_output_stream(attempt, compression=None) as out:
        for record, fields in records(iter(lambda: source.read(_CHUNK), b"")):
            packer = zlib.compressobj(6, wbits=31)
            member = packer.compress(record) + packer.flush()
            out.write(member)
            rows.append((f"{target}/{name}", offset, len(member), fields.get("warc-type"), fields.get("warc-record-id")))
            offset += len(member)
    with out_store.open_output_stream(attempt + ".idx") as index:
        index.write("".join(f"{a} {n} {kind} {rid}\n" for _, a, n, kind, rid in rows).encode())
    out_store.move(attempt, f"{root}/{name}")
    out_store.move(attempt + ".idx", f"{root}/{name}.idx")
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["archive", "offset", "length", "record_type", "record_id"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def read_records(index: DataFrame) -> DataFrame:
    """page_id, payload size and digest, type and refers_to of the records that the index names.

    Size and digest of a response are taken from its payload, those of a revisit from its header; a
    response whose payload has another digest than its header says is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, source = None, None
        for batch in batches:
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("archive", "offset", "length"))
            for archive, offset, length in zip(*columns, strict=True):
                if archive != open_:
                    store, inner = fs.FileSystem.from_uri(archive)
                    open_, source = archive, store.open_input_file(inner)
                rows.append(_described(zlib.decompress(source.read_at(length, offset), wbits=31)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return index.mapInArrow(run, RECORDS)


def _described(record: bytes) -> tuple[int | None, int, str, str, int | None]:
    header, _, block = record.partition(b"\r\n\r\n")
    fields = header_fields(header)
    http, _, payload = block[:-4].partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)content-length: *(\d+)", http)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response":
        found = hashlib.sha1(payload).hexdigest()
        if found != digest or len(payload) != size:
            raise RecordError(f"payload of {fields['warc-record-id']} is not what its header says")
    number = lambda name: int(fields[name]) if name in fields else None
    return number("warc-page"), size, digest, kind, number("warc-refers-to-page")


def archive_and_read(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write all pages, normalise the archives and read every record back, in new folders of the shared one."""
    spark = pages.sparkSession
    whole = new_folder(spark, "warc-streams") + "/all"
    write_archives(with_types(pages, least_bytes), whole)
    return read_records(normalise(spark, whole, new_folder(spark, "warc")))
