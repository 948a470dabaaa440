"""How far the sources of a language differ in their words: exact distances of sources, and words that set one apart.

Documents of a language with the same text are collapsed to one row with the number of copies in each
source, and each text is split into terms once. Copies then count as weights of document frequencies and counts.
Distances of two sources are taken over terms that at least one of them has; terms that both lack all
have the same difference, so their number is enough.

All sums are of integers. ``p`` of a term in a group is 1 + floor(SCALE * (count + ADD) / (N + ADD * V)).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintner.llm.shared import stored

LEAST_DOCS = 30
SCALE, ADD = 1_000_000_000, 5
TOP = 50
#: Sums that a task holds before it hands them on (those of one more text at most beyond them).
HELD = 500_000
_UNIT = 64
_REST = (1 << _UNIT) - 1

#: Bytes of UTF-8: A-Z as a-z, other ASCII but letters to a blank, all else as it is.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and characters beyond ASCII, A-Z as a-z."""
    return text.translate(_FOLD).split()


def collapsed(docs: DataFrame) -> DataFrame:
    """(lang, text, copies): each text of a language once, with [(source, number of its documents)].

    Texts are told apart by SHA-256. Only digests meet to count copies; a text is sent once by each task that has it.
    """
    names = ["lang", "source", "text"]
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in names))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    per_source = rows.groupBy("lang", "digest", "source").agg(F.count("*").alias("n"))
    copies = per_source.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    texts = rows.groupBy("lang", "digest").agg(F.max("text").alias("text"))
    return texts.join(copies, ["lang", "digest"]).select("lang", "text", "copies")


def counted(texts: DataFrame) -> DataFrame:
    """(lang, source, term, docs, count) of collapsed texts: documents with the term, and its occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Documents and occurrences of a term in a group are one number, so that one addition adds both.
        sums: dict[tuple[str, str], dict[bytes, int]] = {}

        def held() -> pa.RecordBatch:
            sizes = [len(own) for own in sums.values()]
            langs, sources = ([g[i] for g, n in zip(sums, sizes, strict=True) for _ in range(n)] for i in (0, 1))
            words = [t.decode("utf-8", "replace") for own in sums.values() for t in own]
            both = [v for own in sums.values() for v in own.values()]
            columns = [pa.array(x, pa.string()) for x in (langs, sources, words)]
            columns += [pa.array([v >> _UNIT for v in both], pa.int64()), pa.array([v & _REST for v in both], pa.int64())]
            sums.clear()
            return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "docs", "count"])

        new = 0
        for batch in batches:
            for lang, text, copies in zip(*(batch.column(i) for i in range(3)), strict=True):
                found = Counter(terms(text.as_py()))
                for copy in copies.as_py():
                    own = sums.setdefault((lang.as_py(), copy["source"]), {})
                    new -= len(own)
                    one, n = copy["n"] << _UNIT, copy["n"]
                    get = own.get
                    for term, times in found.items():
                        own[term] = get(term, 0) + one + n * times
                    new += len(own)
                    if new >= HELD:
                        yield held()
                        new = 0
        yield held()

    binary = texts.select("lang", F.col("text").cast("binary").alias("text"), "copies")
    sums = binary.mapInArrow(run, "lang string, source string, term string, docs long, count long")
    return sums.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("count"))


def kept_terms(counts: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, term, count, lang_count, first): counts of terms in enough documents of their language.

    ``first`` is true in one row of each term of a language. A window holds one row per source.
    """
    term = Window.partitionBy("lang", "term")
    whole = counts.withColumns(
        {
            "lang_docs": F.sum("docs").over(term),
            "lang_count": F.sum("count").over(term),
            "first": F.row_number().over(term.orderBy("source")) == 1,
        }
    )
    return whole.filter(F.col("lang_docs") >= least).drop("docs", "lang_docs")


def _p(count: Column, total: Column, n_terms: Column) -> Column:
    """Decimals hold the product exactly: counts times the scale exceed a long on large corpora."""
    wide = lambda c: c.cast("decimal(20,0)")
    above = (wide(count) + ADD) * F.lit(SCALE).cast("decimal(10,0)")
    below = wide(total) + wide(n_terms) * ADD
    return F.call_function("div", above, below) + 1


def groups_of(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, n_terms, total, lang_total, absent): every group, with ``absent`` the p of a term it lacks.

    ``n_terms`` is V of the language. Without kept terms ``absent`` is null.
    """
    every = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")))
    of_group = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    of_lang = kept.groupBy("lang").agg(F.sum(F.col("first").cast("long")).alias("n_terms"), F.sum("count").alias("lang_total"))
    groups = every.distinct().join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = groups.fillna(0, ["total", "lang_total", "n_terms"])
    absent = F.when(F.col("n_terms") > 0, _p(F.lit(0), F.col("total"), F.col("n_terms")))
    return groups.withColumn("absent", absent)


def with_p(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Kept counts with ``p``, that of the group, and ``q``, that of the language."""
    of_group = groups.select("lang", "source", "n_terms", "total", "lang_total", "absent")
    rows = kept.join(of_group, ["lang", "source"])
    p = _p(F.col("count"), F.col("total"), F.col("n_terms"))
    q = _p(F.col("lang_count"), F.col("lang_total"), F.col("n_terms"))
    return rows.select("lang", "source", "term", p.alias("p"), q.alias("q"), "absent")


def distances(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the sum of |p - q| over all kept terms for every two sources of a language.

    With a and b the p of an absent term, a pair's sum is V|a - b| for terms that both lack, plus a
    correction for every term of one group alone (taken from how often each p occurs in it), plus one for every term
    that both have.
    """
    mine = groups.select("lang", "source", "n_terms", "absent")
    other = mine.select("lang", F.col("source").alias("item"), F.col("absent").alias("absent_b"))
    # One row per group and value of p, not per term, meets the other groups of the language.
    often = rows.groupBy("lang", "source", "absent", "p").agg(F.count("*").alias("n"))
    alone = often.join(other, "lang").filter(F.col("source") != F.col("item"))
    shift = F.col("n") * (F.abs(F.col("p") - F.col("absent_b")) - F.abs(F.col("absent") - F.col("absent_b")))
    alone = alone.select("lang", "source", "item", shift.alias("value"))
    alone = alone.groupBy("lang", F.least("source", "item").alias("source"), F.greatest("source", "item").alias("item"))
    alone = alone.agg(F.sum("value").alias("value"))

    left = rows.select("lang", "term", "source", "p", "absent")
    right = rows.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("absent").alias("absent_b"))
    p, q, a, b = map(F.col, ("p", "q", "absent", "absent_b"))
    both = F.abs(p - q) - F.abs(p - b) - F.abs(q - a) + F.abs(a - b)
    shared = left.join(right, ["lang", "term"]).filter(F.col("source") < F.col("item"))
    shared = shared.groupBy("lang", "source", "item").agg(F.sum(both).alias("value"))

    none = mine.join(other, "lang").filter(F.col("source") < F.col("item"))
    lacking = F.coalesce(F.col("n_terms") * F.abs(a - b), F.lit(0))
    none = none.select("lang", "source", "item", lacking.alias("value"))
    total = none.unionByName(alone).unionByName(shared).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    ends = F.array(*(F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in (("source", "item"), ("item", "source"))))
    return total.select("lang", F.explode(ends).alias("end"), "value").select("lang", "end.source", "end.item", "value")


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to the other sources, and the terms above the language's share.

    Null texts, languages and sources count as ''. A group without kept terms has distances (0 if its language has
    none) and no terms; a language with one source has no distances. Rows repeated in full are documents of their own.
    Other columns are not read; an empty table gives an empty result. Ties are ordered by item in UTF-8.
    """
    kept = stored(kept_terms(counted(collapsed(docs)), least), "kept-terms")
    groups = stored(groups_of(docs, kept), "source-groups")
    rows = with_p(kept, groups)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = distances(rows, groups).withColumn("rank", F.row_number().over(order))
    above = rows.filter(F.col("p") > F.col("q"))
    above = above.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    above = above.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    columns = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return columns(pairs, "pair").unionByName(columns(above, "term"))
