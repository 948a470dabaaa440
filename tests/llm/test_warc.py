"""Archives: an exact round trip, members, sidecar indexes, revisits."""

import gzip
import hashlib
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from vintner.llm import warc
from vintner.llm.shared import new_folder

LONG, OTHER = "ä<p>long</p>\r\n\r\n" * 200, "other\x00text " * 100
PAGES = [
    (1, "http://a/ b\nc", LONG), (2, None, LONG), (7, "u", LONG), (7, "u", LONG), (3, "u", "short"), (4, "u", "short"),
    (5, "u", None), (6, "u", ""), (None, "u", LONG), (None, "u", OTHER), (None, "v", OTHER), (9, "u", "z" * 3_000_000),
]


def expected(pages, least=1000):
    out = []
    for page_id, _, html in pages:
        payload = (html or "").encode()
        same = [i for i, _, h in pages if (h or "").encode() == payload and i is not None]
        copy = len(payload) >= least and same and page_id != max(same)
        out.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if copy else "response", max(same) if copy else None))
    return sorted(out, key=str)


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string")


def test_what_is_read_is_what_was_written(pages):
    assert sorted(map(tuple, warc.archive_and_read(pages).collect()), key=str) == expected(PAGES)


def test_every_record_is_a_member_that_the_sidecar_finds(spark, pages):
    whole, target = new_folder(spark, "whole") + "/all", new_folder(spark, "members")
    warc.write_archives(warc.with_types(pages), whole)
    index = warc.normalise(spark, whole, target).collect()
    streams = sorted(Path(whole.removeprefix("file://")).glob("*.gz"))
    plain = b"".join(gzip.decompress(p.read_bytes()) for p in streams)
    archives = sorted(Path(target.removeprefix("file://")).glob("*.warc.gz"))
    assert sorted(gzip.decompress(p.read_bytes()) for p in archives) == sorted(gzip.decompress(p.read_bytes()) for p in streams)
    assert plain.count(b"WARC/1.1\r\n") == len(PAGES) == len(index)
    for archive in archives:
        data = archive.read_bytes()
        rows = [line.split(" ") for line in Path(f"{archive}.idx").read_text().splitlines()]
        assert rows == [
            [str(r["offset"]), str(r["length"]), r["record_type"], r["record_id"]]
            for r in sorted((r for r in index if r["archive"].endswith(archive.name)), key=lambda r: r["offset"])
        ]
        assert sum(int(n) for _, n, *_ in rows) == len(data)
        for at, n, kind, _ in rows:
            record = zlib.decompress(data[int(at) : int(at) + int(n)], wbits=31)
            assert record.startswith(b"WARC/1.1\r\nWARC-Type: " + kind.encode()) and record.endswith(b"\r\n\r\n")


def test_streams_of_several_members_are_read_alike():
    record = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    data = gzip.compress(record + record[:10]) + gzip.compress(record[10:] + record)
    for size in (1, 7, 1000):
        chunks = (data[i : i + size] for i in range(0, len(data), size))
        assert [r for r, _ in warc.records(chunks)] == [record] * 3


@pytest.mark.parametrize("data", [b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n", b"WARC/1.1\r\nContent", b"HTTP/1.1 200\r\n\r\n"])
def test_a_broken_stream_is_an_error(data):
    with pytest.raises(warc.RecordError):
        list(warc.records(iter([gzip.compress(data)])))


def test_no_pages(pages):
    assert warc.archive_and_read(pages.filter(F.lit(False))).collect() == []
