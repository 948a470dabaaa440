"""The lattice of combinations against counting each of them, and how many rows enter each level."""

import random
from collections import Counter
from itertools import combinations

import pytest

from vintner.operators import iceberg

DIMS = ["a", "b", "c", "d", "e"]
SCHEMA = ", ".join(f"{d} string" for d in DIMS) + ", bad bigint, good bigint"


def sample(seed, n=400):
    """A few common values, NULL among them, and many rare ones."""
    rng = random.Random(seed)
    pick = lambda i: rng.choice([None, "0", "", *[f"v{rng.randrange(400 * (i + 1))}" for _ in range(5)]])
    return [(*(pick(i) for i in range(len(DIMS))), rng.choice([0, 0, 0, 1, 3]), rng.randrange(9)) for _ in range(n)]


def brute(rows, masks, least):
    out = {}
    for mask in masks:
        bad, good = Counter(), Counter()
        for r in rows:
            key = tuple(v if mask >> i & 1 else None for i, v in enumerate(r[: len(DIMS)]))
            bad[key] += r[-2]
            good[key] += r[-1]
        out |= {(mask, *k): (n, good[k]) for k, n in bad.items() if n > least}
    return out


@pytest.mark.parametrize("least", [-1, 0, 4, 30, 10**6])
def test_groups_match_counting(spark, least):
    rows = sample(least)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    masks = [sum(1 << i for i in c) for k in range(1, 6) for c in combinations(range(5), k)]
    for wanted in (masks, [m for m in masks if m.bit_count() == 2], [0b11111], [0b101, 0b11100]):
        found = iceberg.frequent_groups(df, DIMS, wanted, "bad", "good", least).collect()
        assert {tuple(r[:-2]): tuple(r[-2:]) for r in found} == brute(rows, wanted, least)
        assert len(found) == len({tuple(r[:-2]) for r in found})


def test_rows_enter_a_level_only_from_the_smallest_parent_above_the_threshold(spark):
    rows, least = sample(7, 4000), 6
    df = spark.createDataFrame(rows, SCHEMA)
    masks = [sum(1 << i for i in c) for k in range(1, 6) for c in combinations(range(5), k)]
    values = iceberg.frequent_values(df, DIMS, "bad", least)
    start = iceberg.encoded(df, DIMS, values, "bad", "good")
    n_start = start.count()
    distinct = len({r[:-2] for r in rows})
    assert n_start < distinct / 2, (n_start, distinct)  # rare values are alike
    passing = brute(rows, masks, least)
    seen = 0
    for level in iceberg.levels(start, len(DIMS), masks, least):
        entered = level.entered.count()
        of_size = [m for m in masks if m.bit_count() == level.size]
        # Each row may enter a combination only if its groups of all single dimensions are above the threshold; from
        # the third level on only out of a group of the parent that is.
        codes = [c for c in start.columns if c.startswith("_c")]
        by_mask = Counter()
        for r in start.collect():
            for m in of_size:
                by_mask[m] += all(r[codes[i]] for i in range(5) if m >> i & 1)
        assert entered <= sum(by_mask.values()) < distinct * len(of_size)
        if level.size > 2:
            assert entered < 0.9 * sum(by_mask.values())
        assert level.groups.count() == sum(m in of_size for m, *_ in passing)
        seen = max(seen, level.size)
    assert seen >= max(m.bit_count() for m, *_ in passing) > 2


def test_smallest_parents():
    sizes = {0b011: 5, 0b101: 3, 0b110: 4}
    assert iceberg.smallest_parents([0b111], sizes) == {0b101: [0b111]}
    assert iceberg.smallest_parents([0b111], sizes | {0b110: 0}) == {}
    assert iceberg.smallest_parents([0b111, 0b1011], sizes) == {0b101: [0b111]}


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert iceberg.frequent_groups(df, DIMS, [3, 31], "bad", "good", 0).collect() == []


def test_rows_are_merged_before_they_enter_combinations(spark):
    rng = random.Random(3)
    rows = [(*(rng.choice("abcdef") for _ in DIMS), 1, 1) for _ in range(4000)]
    df = spark.createDataFrame(rows, SCHEMA)
    masks = [sum(1 << i for i in c) for k in range(1, 6) for c in combinations(range(5), k)]
    start = iceberg.encoded(df, DIMS, iceberg.frequent_values(df, DIMS, "bad", 0), "bad", "good")
    walked = list(iceberg.levels(start, len(DIMS), masks, 0))
    entered = sum(x.entered.count() for x in walked)
    distinct = len({r[:-2] for r in rows})
    assert entered < 0.4 * distinct * len(masks)
    assert sum(x.groups.count() for x in walked) == len(brute(rows, masks, 0)) > 10000
