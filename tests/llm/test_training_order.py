"""The permutation, slots that do not depend on the layout, and shards read back."""

import numpy as np
from pyspark.sql import functions as F

from vintner.llm import tokens
from vintner.llm.training_order import END_ID, MAX_PIECES, STRIDE, feistel, half_bits, materialise, numbered, permuted, read_shards

SF = "/root/testdata/sf0.001"


def test_feistel_is_a_permutation_that_depends_on_the_key():
    for domain in (1, 2, 3, 10, 1000, 4097):
        assert sorted(feistel(np.arange(domain), domain).tolist()) == list(range(domain))
    assert feistel(np.arange(1000), 1000, 1).tolist() != feistel(np.arange(1000), 1000, 2).tolist()
    large = 10**15
    values = np.random.default_rng(1).integers(0, large, 1000)
    assert (feistel(values, large) < large).all() and len(set(feistel(values, large).tolist())) == len(set(values.tolist()))


def test_slots_are_gapless_and_do_not_depend_on_the_number_of_shards(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    few = materialise(docs, n_shards=3).select("slot", "doc_id", "piece").orderBy("slot").collect()
    many = materialise(docs.repartition(7), n_shards=11).select("slot", "doc_id", "piece").orderBy("slot").collect()
    assert few == many
    assert [r["slot"] for r in few] == list(range(len(few)))
    other = materialise(docs, key=7, n_shards=3).select("slot", "doc_id", "piece").orderBy("slot").collect()
    assert [r[1:] for r in other] != [r[1:] for r in few]


def test_shards_hold_the_ids_at_a_fixed_stride(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    encode = tokens.encoder(tokens.default_path())
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    written = materialise(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), n_shards=4)
    for row in read_shards(written).collect():
        ids = encode(texts[row["doc_id"]]) + [END_ID]
        part = ids[row["piece"] * STRIDE : (row["piece"] + 1) * STRIDE]
        assert np.frombuffer(row["ids"], dtype="<u2").tolist() == part
        assert row["byte_offset"] == row["record"] * STRIDE * 2 and row["length"] == len(part)
    middle = read_shards(written.filter("slot >= 20 AND slot < 30")).orderBy("slot").select("slot", F.crc32("ids"), "ids_crc32").collect()
    assert [r[0] for r in middle] == list(range(20, 30)) and all(r[1] == r[2] for r in middle)


def test_repeated_and_missing_ids_have_slots_of_their_own(spark):
    docs = spark.createDataFrame([(None, "a"), (5, "b"), (5, "b"), (5, None), (None, "a")], "doc_id long, text string")
    rows = materialise(docs, n_shards=2).collect()
    assert sorted(r["slot"] for r in rows) == [0, 1, 2, 3, 4]
    assert materialise(docs.limit(0), n_shards=2).count() == 0


def test_numbers_of_any_width_are_exact():
    rng = np.random.default_rng(5)
    for span in (1, 1000, 2**20, 2**41, 2**52, 2**63, 2**64 - 1):
        domain = (span + 1) * MAX_PIECES
        known = np.array([0, span, *(int(x) % (span + 1) for x in rng.integers(0, 2**63, 50))], dtype=np.uint64)
        piece = np.array([MAX_PIECES - 1, MAX_PIECES - 1, *rng.integers(0, MAX_PIECES, 50)], dtype=np.uint64)
        half = half_bits(domain)
        left, right = numbered(known, piece, domain)
        want = [int(k) * MAX_PIECES + int(p) for k, p in zip(known, piece)]
        assert [(int(a) << half) | int(b) for a, b in zip(left, right)] == want
        left, right = permuted(left, right, domain)
        got = [(int(a) << half) | int(b) for a, b in zip(left, right)]
        assert max(got) < domain and len(set(got)) == len(set(want))


def test_ids_from_end_to_end_of_the_range(spark):
    ids = [-(2**63), 2**63 - 1, 0, -1, 2**52 + 1, -(2**40)]
    docs = spark.createDataFrame([(i, "some words of a text " * 400) for i in ids], "doc_id long, text string")
    few = materialise(docs, n_shards=3).select("slot", "doc_id", "piece").orderBy("slot").collect()
    assert [r["slot"] for r in few] == list(range(len(few))) and {r["doc_id"] for r in few} == set(ids)
    many = materialise(docs.repartition(4), n_shards=7).select("slot", "doc_id", "piece").orderBy("slot").collect()
    assert few == many
