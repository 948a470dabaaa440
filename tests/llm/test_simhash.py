"""Fingerprints, bit-sliced links, components and classes against brute force."""

import random

import numpy as np
import xxhash

from vintner.llm import simhash_dedup as s
from vintner.llm.components import components
from vintner.llm.queries import op2_simhash


def plain_fingerprint(text):
    words = text.lower().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, seed=42) for r in runs]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_classes(rows, radius=2):
    """Smallest doc_id reachable, from (doc_id, fingerprint) rows."""
    label = list(range(len(rows)))
    for _ in rows:
        before = list(label)
        for i, (_, a) in enumerate(rows):
            for j, (_, b) in enumerate(rows):
                if (a ^ b).bit_count() <= radius:
                    label[i] = label[j] = min(label[i], label[j])
        if before == label:
            break
    out = {}
    for i, (doc_id, _) in enumerate(rows):
        out.setdefault(label[i], []).append(doc_id)
    return [min(out[label[i]]) for i in range(len(rows))]


def near(rng, base, bits, spread=64):
    return base ^ sum(1 << b for b in rng.sample(range(spread), bits))


def test_fingerprint_is_that_of_the_contract():
    rng = random.Random(1)
    assert s.fingerprint(b"") == 0 == s.fingerprint(b" \t\n\x0b\f\r")
    for n in (1, 2, 3, 4, 50, 800, 40_000):
        text = b" ".join(rng.choice([b"a", b"Bc", "É".encode(), b"d\n", b"e\x85f", b"\xc2\xa0"]) for _ in range(n))
        assert s.fingerprint(text) == plain_fingerprint(text)


def test_bit_sliced_comparison_finds_all_pairs_within_the_radius():
    rng = random.Random(2)
    for radius in (0, 1, 2, 3, 6):
        for n in (2, 63, 64, 65, 200):
            base = rng.getrandbits(64)
            members = np.unique(np.array([near(rng, base, rng.randint(0, radius + 1)) for _ in range(n)], dtype=np.uint64))
            got = {(i, int(j)) for i, others in s.near_pairs(members, 0, radius) for j in others}
            values = members.tolist()
            want = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if (values[i] ^ values[j]).bit_count() <= radius}
            assert got == want


def test_masks_leave_no_pair_out():
    rng = random.Random(3)
    masks = s.first_masks(2)
    finer = s.finer_masks(masks, 2)
    finest = s.finer_masks(finer, 2)
    assert len(masks) == 6 and len(finer) == 18 and max(64 - m.bit_count() for m in finest) <= 15
    for _ in range(500):
        away = near(rng, 0, rng.randint(0, 2))
        for level, parents in ((finer, masks), (finest, finer)):
            for k, mask in enumerate(parents):
                if not away & mask:
                    assert any(not away & m for m in level[3 * k : 3 * k + 3])


def test_links_with_buckets_dealt_again(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(3)]
    # Chains of near values, and one large group that differs in few bits only.
    values = {near(rng, base[0], rng.randint(0, 3), 12) for _ in range(250)} | {rng.getrandbits(64) for _ in range(150)}
    for b in base[1:]:
        for _ in range(40):
            b = near(rng, b, 2)
            values.add(b)
    rows = [(i, v) for i, v in enumerate(sorted(values))]
    frame = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for _, v in rows], "fingerprint long")
    want = plain_classes(rows)
    for bucket in (4096, 5):
        links = [(r["a"] % 2**64, r["b"] % 2**64) for r in s.links(frame, bucket=bucket).collect()]
        assert all((a ^ b).bit_count() <= 64 for a, b in links)
        place = {v: i for i, v in rows}
        label = list(range(len(rows)))
        for _ in range(len(rows)):
            changed = False
            for a, b in links:
                least = min(label[place[a]], label[place[b]])
                changed |= label[place[a]] != least or label[place[b]] != least
                label[place[a]] = label[place[b]] = least
            if not changed:
                break
        assert label == want


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1200)] + [(3, 3), (-5, 9), (9, -5), (-5, 9)]
    edges += [(rng.randint(2000, 2100), rng.randint(2000, 2100)) for _ in range(60)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert {n: found.get(n, n) for n in label} == label
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_on_a_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"].encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = sorted((i, plain_fingerprint(t)) for i, t in texts.items())
    want = dict(zip((i for i, _ in rows), plain_classes(rows), strict=True))
    got = op2_simhash(spark, sf).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {i: f"{f:016x}" for i, f in rows}


def test_one_document_of_each_class_stays(spark):
    docs = spark.createDataFrame(
        [(4, "one two three four", 1), (2, "One two THREE four", 2), (9, None, 3), (8, " ", 4), (2, "One two THREE four", 5), (None, "x y z", 6)],
        "doc_id long, text string, fingerprint int",
    )
    kept = s.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect()) == [(False, 2), (False, 8), (True, None)]
