"""Distances and words of sources against sums over dense vectors; copies, edges."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from vintner.llm import source_divergence as sd
from vintner.llm.queries import ORACLE, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string"


def dense(rows, least, top):
    """The contract word by word."""
    docs, counts = defaultdict(set), defaultdict(Counter)
    groups = set()
    for at, (_, text, lang, source) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = [t.decode() for t in sd.terms((text or "").encode())]
        for t in found:
            docs[lang, t].add(at)
        counts[lang, source].update(found)
    out = []
    for lang, source in groups:
        kept = [t for (x, t), d in docs.items() if x == lang and len(d) >= least]
        v = len(kept)

        def p(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * v) for t in kept}

        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update(counts[g])
        mine, q = p(counts[lang, source]), p(whole)
        pairs = []
        for g in groups - {(lang, source)}:
            if g[0] == lang:
                other = p(counts[g])
                pairs.append((g[1], sum(abs(mine[t] - other[t]) for t in kept)))
        words = [(t, mine[t] - q[t]) for t in kept if counts[lang, source][t] and mine[t] > q[t]]
        for part, items, most in (("pair", pairs, None), ("term", words, top)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(items[:most])]
    return sorted(out)


def found(df, least, top):
    return sorted(tuple(r) for r in sd.audit(df, least, top).select("lang", "source", "part", "item", "value", "rank").collect())


def test_terms():
    assert sd.terms("Ab-cd É1É x\x00y@Z[a`b{c".encode()) == [t.encode() for t in ["ab", "cd", "É", "É", "x", "y", "z", "a", "b", "c"]]


@pytest.mark.parametrize("seed", range(3))
def test_against_dense_vectors(spark, seed):
    rng = random.Random(seed)
    words = ["a", "B", "b", "ça", "Ça", "中", "d", "e", "f", "gg"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 9))) for _ in range(40)] + [None, ""]
    rows = [(i, rng.choice(texts), rng.choice(["en", "en", "de", None]), rng.choice(["s", "t", "u", "v", None])) for i in range(300)]
    rows += [(1, "ça gg gg", "en", "s")] * 40 + [(None, None, "xx", "only"), (5, "none of these", "yy", "s"), (6, "", "yy", "t")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for least, top in ((3, 50), (30, 2)):
        assert found(df, least, top) == dense(rows, least, top)


def test_each_text_is_split_once(spark):
    rows = [(i, "same text", "en", f"s{i % 3}") for i in range(90)] + [(90, "same text", "de", "s0")]
    texts = sd.collapsed(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()
    assert sorted((r["lang"], sorted(tuple(c) for c in r["copies"])) for r in texts) == [
        ("de", [("s0", 1)]), ("en", [("s0", 30), ("s1", 30), ("s2", 30)])]


def test_counts_beyond_a_long_times_the_scale(spark):
    df = spark.createDataFrame([("en", "s", "a", 30, 10**15), ("en", "t", "a", 30, 1)], "lang string, source string, term string, docs long, count long")
    kept = sd.kept_terms(df)
    groups = sd.groups_of(df, kept)
    rows = {r["source"]: (r["p"], r["q"]) for r in sd.with_p(kept, groups).collect()}
    p = lambda c, n: 1 + 10**9 * (c + 5) // (n + 5)
    assert rows == {"s": (p(10**15, 10**15), p(10**15 + 1, 10**15 + 1)), "t": (p(1, 1), p(10**15 + 1, 10**15 + 1))}


def test_edges(spark):
    long = "Word " * 300_000
    df = spark.createDataFrame([(1, long, "en", "a"), (2, long, "en", "b"), (3, None, None, None)], SCHEMA)
    df = df.withColumns({c: F.lit(1) for c in ("n", "digest", "copies", "term", "docs", "count", "p", "q", "absent", "item", "value", "rank", "part", "n_terms", "total")})
    assert found(df, 1, 50) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert sd.audit(df.limit(0)).collect() == []


def test_query_matches_sql(spark):
    from checks.compare import connect, spark_result, sql_result

    sf_dir = "/root/testdata/sf0.01"
    name = "op12_source_divergence"
    assert spark_result(QUERIES[name](spark, sf_dir)) == sql_result(connect(sf_dir), ORACLE[name])
