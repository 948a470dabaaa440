"""Encoding by joins against the tiktoken library, texts back from their ids, and the two claims a join rests on."""

import hashlib
import random
import struct

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vintner.llm import bpe_tree
from vintner.llm.queries import op13_byte_bpe


@pytest.fixture(scope="module")
def codec():
    return bpe_tree.codec(bpe_tree.default_path(), bpe_tree.default_pattern())


@pytest.fixture(scope="module")
def plain(codec):
    pattern = bpe_tree.default_pattern()
    return tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=codec.ranks, special_tokens={})


LETTERS = st.sampled_from(list("ab  '\nlvres.1é中tdm\t s  😀x="))


@settings(max_examples=150, deadline=None)
@given(st.text(LETTERS, max_size=120), st.sampled_from([1, 2, 3, 7, 64]), st.sampled_from([1, 2, 5, 32]))
def test_any_cuts_give_the_same_ids(text, chars, size):
    codec = bpe_tree.codec(bpe_tree.default_path(), bpe_tree.default_pattern())
    plain = tiktoken.Encoding("p", pat_str=bpe_tree.default_pattern(), mergeable_ranks=codec.ranks, special_tokens={})
    before = bpe_tree.LEAF_CHARS, bpe_tree.LEAF_BYTES
    bpe_tree.LEAF_CHARS, bpe_tree.LEAF_BYTES = chars, size
    codec._pieces.clear()
    try:
        ids = codec.encoded(text)
    finally:
        bpe_tree.LEAF_CHARS, bpe_tree.LEAF_BYTES = before
    assert list(ids) == plain.encode_ordinary(text) and codec.decoded(ids) == text.encode()


@pytest.mark.parametrize("unit", ["x", "ha", "abc", "é", "=", "12", "aaaab", "中", "don't", " \n", "\t", "x.", "'l"])
def test_long_runs(codec, plain, unit):
    for text in (unit * 9000, "a " + unit * 4321 + " b", unit * 4096 + "ll"):
        assert list(codec.encoded(text)) == plain.encode_ordinary(text)


@pytest.mark.parametrize("unit", [" ", "\n", "\t ", "x", "abcde"])
def test_a_million_characters_without_a_cut(codec, unit):
    text = unit * (1_000_000 // len(unit))
    ids = codec.encoded(text)
    assert codec.decoded(ids) == text.encode()
    assert all(map(codec.fit, ids[:-1], ids[1:]))


def test_every_code_point(codec, plain):
    points = [chr(p) for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    for at in range(0, len(points), 4096):
        text = "".join(f"a{p}a 1{p}1 {p}{p}  {p}" for p in points[at : at + 4096])
        assert list(codec.encoded(text)) == plain.encode_ordinary(text)


def test_windows_grow_no_further_than_they_must(codec):
    """Neighbouring tokens that fit in pairs are the encoding of the whole, and a join of fitting ends changes nothing."""
    rng = random.Random(1)
    for _ in range(2000):
        data = bytes(rng.choice(b"abcthein ") for _ in range(rng.randrange(2, 40)))
        ids = codec.merged(data)
        assert all(map(codec.fit, ids[:-1], ids[1:]))
        cut = rng.randrange(len(data) + 1)
        assert codec.joined(codec.merged(data[:cut]), codec.merged(data[cut:])) == ids
        walk = [rng.choice(ids)]
        while len(walk) < 6 and (following := [t for t in ids if codec.fit(walk[-1], t)]):
            walk.append(rng.choice(following))
        assert codec.merged(codec.decoded(walk)) == walk


def test_a_token_that_merges_never_make(tmp_path):
    """A piece that is a token is that token; as a part of a longer piece it is what its merges give."""
    import base64

    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"abc" * 20: 257}
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items()))
    own = bpe_tree.Codec(str(path), bpe_tree.default_pattern())
    plain = tiktoken.Encoding("own", pat_str=bpe_tree.default_pattern(), mergeable_ranks=ranks, special_tokens={})
    before, bpe_tree.LEAF_CHARS = bpe_tree.LEAF_CHARS, 30
    try:
        for text in ("abc" * 20, "abc" * 20 + "a", "abc" * 40, "abc " * 40, "x" + "abc" * 20):
            assert list(own.encoded(text)) == plain.encode_ordinary(text)
    finally:
        bpe_tree.LEAF_CHARS = before


def test_query_on_given_documents(spark, codec, plain):
    rows = op13_byte_bpe(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs}
    assert len(rows) == len(docs)
    for r in rows:
        ids = plain.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_edges(spark, plain):
    texts = [(1, None), (2, ""), (3, "twice"), (3, "twice"), (None, "<|endoftext|>"), (4, " " * 1_000_000), (5, "\n" * 700_000 + "x")]
    docs = spark.createDataFrame(texts, "doc_id int, text string").withColumns({c: F.lit(1) for c in ("ids", "decoded", "n_tokens")})
    encoded = bpe_tree.with_ids(docs)
    assert encoded.columns == ["doc_id", "ids"]
    rows = bpe_tree.with_bytes(encoded).collect()
    assert sorted((str(r["doc_id"]), bytes(r["decoded"]).decode()) for r in rows) == sorted((str(i), t or "") for i, t in texts)
    special = next(r for r in rows if r["doc_id"] is None)
    assert list(struct.unpack("<7I", special["ids"])) == plain.encode_ordinary("<|endoftext|>")
    assert bpe_tree.with_bytes(bpe_tree.with_ids(docs.limit(0))).collect() == []
    broken = docs.limit(1).select(F.lit(9).alias("doc_id"), F.expr("x'61ff62'").alias("text"))
    assert bytes(bpe_tree.with_bytes(bpe_tree.with_ids(broken)).first()["decoded"]).decode() == "a�b"
