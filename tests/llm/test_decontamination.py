"""Matches against comparing every window of every document with every item."""

import re

import numpy as np
import pyarrow as pa
import pytest

from vintner.llm import decontamination as d
from vintner.llm.arrays import text_slices

SF = "/root/testdata/sf0.001"


def words_of(text):
    # Runs of ASCII letters and digits and of all bytes beyond ASCII, A-Z folded.
    return [w for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode())]


def multiset(words, size):
    out = {}
    for i in range(len(words) - size + 1):
        run = tuple(w.lower() for w in words[i : i + size])
        out[run] = out.get(run, 0) + 1
    return out


def similarity(a, b):
    weight = lambda run: sum(map(len, run))
    common = sum(min(n, b.get(run, 0)) * weight(run) for run, n in a.items())
    total = sum(n * weight(run) for run, n in a.items()) + sum(n * weight(run) for run, n in b.items()) - common
    return common / total if total else 0.0


def plain(docs, items, least=0.8):
    out = {}
    for doc_id, text in docs:
        words = words_of(text)
        for item_id, item in items:
            own = words_of(item)
            size = min(5, len(own))
            if not size or len(words) < size:
                continue
            target = multiset(own, size)
            windows = range(max(1, len(words) - len(own) + 1))
            best = max((similarity(multiset(words[i : i + len(own)], size), target) for i in windows), default=0)
            if best >= least:
                out[doc_id, item_id] = round(best, 6)
    return out


def frames(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )


@pytest.fixture(scope="module")
def edited():
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary, size=n))) for i, n in enumerate([3, 5, 6, 20, 30, 40, 60, 60])]
    items += [(20, items[4][1] + " tail"), (21, ""), (22, None), (23, "w1 w2")]
    docs = [(1, ""), (2, None), (3, "w1"), (4, "w1 w2")]
    for k, (_, item) in enumerate(items[:9]):
        words = item.split()
        around = lambda: " ".join(rng.choice(vocabulary, size=50))
        docs.append((100 + k, f"{around()} {item.upper()}. {around()}"))
        changed = list(words)
        if len(words) >= 30:
            changed[len(words) // 2] = "changed"
        docs.append((200 + k, f"{around()} {' '.join(changed)} {around()}"))
        half = " ".join(words[: len(words) // 2])
        docs.append((300 + k, f"{around()} {half} {around()}"))
        inserted = [*words[:8], "more", *words[8:]]
        docs.append((400 + k, " ".join(inserted)))
        docs.append((500 + k, f"{item} {around()} {item}"))
    return docs, items


def test_every_similar_window_is_found(spark, edited):
    docs, items = edited
    found = d.contaminated(*frames(spark, docs, items)).collect()
    want = plain(docs, items)
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in found}
    assert set(got) == set(want) and len(found) == len(got)
    assert all(got[k] <= want[k] + 1e-6 for k in want)
    assert sum(got[k] == want[k] for k in want) >= 0.9 * len(want)


def moved(rng, vocabulary):
    """Items in random text: halves swapped, words changed near both ends, a word dropped or put in."""
    pick = lambda n: rng.choice(vocabulary, size=n).tolist()
    docs, items = [], []
    for k in range(240):
        words = pick(int(rng.integers(60, 140) if k % 4 == 0 else rng.integers(25, 41)))
        new = list(words)
        if k % 4 == 0:
            half = len(words) // 2
            new = words[half:] + words[:half]
        elif k % 4 == 1:
            new[int(rng.integers(0, 3))] = "incomprehensibilities"
        elif k % 4 == 2:
            new[-1 - int(rng.integers(0, 3))] = "incomprehensibilities"
        else:
            at = int(rng.integers(1, len(words) - 1))
            new = words[:at] + words[at + 1 :] if k % 8 == 3 else [*words[:at], "x", *words[at:]]
        items.append((k, " ".join(words)))
        docs.append((k, " ".join(pick(int(rng.integers(0, 60))) + new + pick(int(rng.integers(0, 60))))))
    return docs, items


def test_every_window_within_the_radius_is_found(spark):
    """All windows of all documents by their own fingerprints: none that is similar and near is missed, at its best similarity."""
    rng = np.random.default_rng(11)
    docs, items = moved(rng, [f"v{i}" for i in range(3000)])
    index = d.ItemIndex([i for i, _ in items], [t for _, t in items])
    near, similar = {}, 0
    for k, text in docs:
        ((_, _, data, offsets),) = text_slices(pa.array([text]))
        hashes, weights, _, _ = d._Texts(data, offsets).shingles(5)
        words, n = words_of(text), index.words[k]
        target, best = multiset(words_of(items[k][1]), 5), -1.0
        at = int(np.flatnonzero(index.known == k)[0])
        found = False
        for start in range(max(1, len(words) - n + 1)):
            score = similarity(multiset(words[start : start + n], 5), target)
            found |= score >= 0.8
            own = slice(start, max(start, min(start + n, len(words)) - 4))
            away = (d.weighted_simhash(hashes[own], weights[own].astype(float)) ^ int(index.prints[at])).bit_count()
            if score >= 0.8 and away <= d.RADIUS:
                best = max(best, score)
        similar += found
        if best >= 0:
            near[k, k] = round(best, 6)
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in d.contaminated(*frames(spark, docs, items)).collect()}
    assert got == near
    assert len(near) >= 0.98 * similar > 150


def test_running_sums_give_the_fingerprints_of_windows(monkeypatch):
    rng = np.random.default_rng(5)
    hashes, weights = rng.integers(0, 2**63, 500, dtype=np.uint64), rng.integers(1, 60, 500)
    begin = np.sort(rng.integers(0, 400, 80))
    stop = begin + 37
    want = [d.weighted_simhash(hashes[a:z], weights[a:z].astype(float)) for a, z in zip(begin, stop, strict=True)]
    assert d.rolling_simhash(hashes, weights, begin, stop).tolist() == want
    monkeypatch.setattr(d, "STRETCH", 4)
    low, high = np.array([0, 2, 2, 20, 21]), np.array([5, 3, 9, 20, 30])
    assert np.concatenate(list(d._merged(low, high))).tolist() == [*range(10), *range(20, 31)]


def test_items_in_many_blocks_give_the_same(spark, edited):
    docs, items = frames(spark, *edited)
    assert sorted(d.contaminated(docs, items, block_chars=200).collect()) == sorted(d.contaminated(docs, items).collect())


def test_a_passage_that_all_items_share_is_not_enough(spark):
    shared = "this very passage opens every single item of the benchmark in the same words"
    items = [(i, f"{shared} {' '.join(f'q{i}x{k}' for k in range(9))}") for i in range(300)]
    docs = [(1, f"before {shared} after"), (2, f"a {items[7][1]} b {shared} {items[9][1][:90]}"), (3, shared * 50)]
    found = d.contaminated(*frames(spark, docs, items)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == set(plain(docs, items)) == {(2, 7)}
    index = d.ItemIndex([i for i, _ in items], [t for _, t in items])
    assert len(index.grams[5].item) < 0.5 * sum(n - 4 for n in index.words)


def test_lookup_finds_all_fingerprints_within_the_radius():
    rng = np.random.default_rng(4)
    index = d.ItemIndex([0], ["a b c d e f"], radius=19)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    flips = [sum(1 << int(b) for b in rng.choice(64, size=rng.integers(0, 30), replace=False)) for _ in range(300)]
    prints = np.array([int(b) ^ f for b, f in zip(base, flips, strict=True)], dtype=np.uint64)
    index.known, index.prints, index.tables = np.arange(300), prints, []
    for block in range(4):
        values = ((prints >> np.uint64(block * 16)) & np.uint64(65535)).astype(np.int64)
        rank = np.argsort(values, kind="stable")
        index.tables.append((rank, np.searchsorted(values[rank], np.arange(65537))))
    away = np.bitwise_count(base[:100, None] ^ prints[None, :]).astype(int)
    want = np.where(away <= 19, away, -1)
    assert (index.within(base[:100], np.arange(300)) == want).all()
    some = np.arange(5, 300, 7)
    assert (index.within(base[:100], some) == want[:, some]).all() and (want >= 0).sum() > 50


def test_given_tables_against_plain_search(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    targets = [(r["item_id"], r["text"]) for r in items.collect()]
    runs = {i: set(multiset(words_of(t), 5)) for i, t in targets}
    near = [(i, t) for i, t in texts if any(set(multiset(words_of(t), 5)) & r for r in runs.values())]
    want = {}
    for i, t in near:
        held = set(multiset(words_of(t), 5))
        want |= plain([(i, t)], [(k, x) for k, x in targets if runs[k] & held])
    got = {(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, items).collect()}
    assert got == set(want) and got
    clean = d.without_contaminated(docs, items)
    assert {r["doc_id"] for r in clean.collect()} == {i for i, _ in texts} - {i for i, _ in got}


def test_slices_cover_all_rows_whatever_their_length():
    texts = ["x" * 700_000, None, "", "y" * 2_000_000, "z", "w" * 600_000]
    parts = [(a, b, offsets[-1]) for a, b, _, offsets in text_slices(pa.array(texts))]
    assert [(a, b) for a, b, _ in parts][0][0] == 0 and parts[-1][1] == 6
    assert all(parts[i][1] == parts[i + 1][0] for i in range(len(parts) - 1))
    assert sum(n for *_, n in parts) == sum(len(t or "") for t in texts)
