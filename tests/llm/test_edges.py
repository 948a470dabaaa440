"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns, for all operators and stages."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vintner.llm import html_main_text, quality_svm, robust_outliers, simhash_dedup, toxicity_chain, warc
from vintner.llm.decontamination import contaminated
from vintner.llm.packing import pack
from vintner.llm.shared import bounded_sample, fresh
from vintner.llm.token_counts import counts_after_edits
from vintner.llm.training_order import materialise

LONG = "many words make a very long text indeed " * 20_000
TEXTS = [
    (1, "some words of a text, plain and good", "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, " \n\t ", "de", "b"),
    (5, LONG, "en", "a"), (6, "x" * 300_000, "en", "a"), (7, "repeated row here, word for word", "en", "a"),
    (7, "repeated row here, word for word", "en", "a"), (None, "no id at all but some words", "en", "a"),
    (8, "ünï çødé   \x00 text", "fr", None), (9, "SOME WORDS OF A TEXT, PLAIN AND GOOD", "en", "a"),
]
#: Names that the operators use inside or return.
CLASHES = ["score", "length", "fingerprint", "component_id", "bucket", "piece", "t", "key", "group_", "text_to_score", "quality_score",
           "p_toxic", "toxic", "label", "n_words", "size", "first", "n", "rank", "place", "shard", "Text_To_Score"]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(TEXTS, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    return frame.withColumns({c: F.lit("clash") for c in CLASHES if c != "Text_To_Score"})


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, None if i == 2 else "u", t) for i, t, *_ in TEXTS]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("payload", "first", "block", "text", "n_chars")})


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Labels and benchmark beside which the stages run."""
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(1, 10)] + [(None, 1, 1), (1, None, None), (3, 7, 7)]
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, "many words make a very long text"), (2, None), (3, ""), (None, "no item id but words enough here")]
    spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)).write.parquet(f"{folder}/benchmark.parquet")
    return folder


def chain(docs):
    none = docs.sparkSession.createDataFrame([], "doc_id long, toxic int")
    return toxicity_chain.with_categories(docs.select("doc_id", "text"), toxicity_chain.fit(docs, none))


def quality(docs):
    none = docs.sparkSession.createDataFrame([], "doc_id long, quality int")
    return quality_svm.with_scores(docs.select("doc_id", "text"), quality_svm.fit(docs, none))


ONE_ROW_EACH = {
    "quality": quality, "simhash": simhash_dedup.classes, "outliers": robust_outliers.judged,
    "toxicity": chain, "token_counts": counts_after_edits,
}
SEVERAL = {"training_order": lambda d: materialise(d, n_shards=3), "packing": pack}


@pytest.mark.parametrize("name", [*ONE_ROW_EACH, *SEVERAL])
def test_operators_on_documents(docs, name):
    operator = (ONE_ROW_EACH | SEVERAL)[name]
    rows = operator(docs).collect()
    ids = [r["doc_id"] for r in rows if "piece" not in r or r["piece"] == 0]
    assert sorted(map(str, ids)) == sorted(str(i) for i, *_ in TEXTS)
    empty = operator(docs.filter(F.lit(False)))
    assert empty.collect() == [] and "doc_id" in empty.columns


BLANKS = [" " * 1_000_000, "\n" * 1_000_000, "word " + "\t " * 600_000 + "word", "\r\n" * 500_000 + " x"]


def test_long_runs_of_white_space(spark, sf_dir):
    """Ids are those of the reference library, and every operator on tokens takes such texts whole."""
    from vintner.llm import tokens

    path = tokens.default_path()
    for text in BLANKS:
        assert tokens.encoder(path)(text) == tokens._reference(path)(text)
    long = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate([*BLANKS, "a b"])], "doc_id long, text string, lang string, source string, n_chars long")
    want = {i: len(tokens._reference(path)(t)) for i, t in enumerate([*BLANKS, "a b"])}
    assert {r["doc_id"]: r["n_tokens"] for r in counts_after_edits(long).collect()} == want
    for rows in (materialise(long, n_shards=2).select("doc_id", "length").collect(), corpus_pipeline.STAGES[4][1](spark, long, sf_dir).collect()):
        sums = {i: 0 for i in want}
        for r in rows:
            sums[r["doc_id"]] += r["length"]
        assert sums == {i: n + 1 for i, n in want.items()}


def test_results_of_the_cases(docs):
    scores = {r["doc_id"]: r["score"] for r in quality(docs).collect()}
    assert set(scores.values()) == {0.5}
    found = {str(r["doc_id"]): r for r in simhash_dedup.classes(docs).collect()}
    assert [found[i]["component_id"] for i in "2347"] == [2, 2, 2, 7] and found["2"]["fingerprint"] == "0" * 16
    assert found["9"]["component_id"] == 1
    judged = {str(r["doc_id"]): r for r in robust_outliers.judged(docs).collect()}
    assert [judged[i]["n_words"] for i in "2346"] == [0, 0, 0, 1] and judged["5"]["base_failed"] and judged["2"]["distance2"] is None
    counts = {str(r["doc_id"]): r["n_tokens"] for r in counts_after_edits(docs).collect()}
    assert counts["2"] == counts["3"] == 0 < counts["4"]
    packed = pack(docs).toPandas()
    assert packed[packed.doc_id.isin([2, 3])].length.tolist() == [1, 1]


def test_decontamination(spark, docs, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contaminated(docs, items).collect()
    assert [(r["doc_id"], r["item_id"], r["similarity"]) for r in found if r["item_id"]] == [(5, 1, 1.0)]
    assert contaminated(docs.limit(0), items).collect() == [] == contaminated(docs, items.limit(0)).collect()


def test_operators_on_pages(pages):
    for operator in (html_main_text.extract, warc.archive_and_read):
        rows = operator(pages).collect()
        assert sorted(str(r["page_id"]) for r in rows) == sorted(str(i) for i, *_ in TEXTS)
        assert operator(pages.filter(F.lit(False))).collect() == []
    texts = {r["page_id"]: r["text"] for r in html_main_text.extract(pages).collect()}
    assert texts[2] == texts[3] == texts[4] == "" and texts[5] == LONG.strip()


@pytest.mark.parametrize("stage", range(5))
def test_stages(spark, docs, sf_dir, stage):
    name, function = corpus_pipeline.STAGES[stage]
    out = function(spark, docs, sf_dir)
    ids = {str(r["doc_id"]) for r in out.collect()}
    assert ids <= {str(i) for i, *_ in TEXTS}
    assert function(spark, docs.filter(F.lit(False)), sf_dir).collect() == []
    if stage < 4:
        assert out.dtypes == docs.dtypes
    if name == "SimHash near-dedup":
        assert sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "2", "5", "6", "7", "8", "None"]
    if name == "benchmark decontamination":
        assert ids == {str(i) for i, *_ in TEXTS} - {"5", "None"} or ids == {str(i) for i, *_ in TEXTS} - {"5"}


def test_a_sample_is_bounded_and_repeatable(spark):
    labels = spark.range(5000).selectExpr("id AS doc_id", "CAST(id % 10 = 0 AS INT) AS label")
    rows = sorted(bounded_sample(labels, "doc_id", "label", 300).collect())
    assert rows == sorted(bounded_sample(labels.repartition(9), "doc_id", "label", 300).collect())
    by = [sum(r["label"] == k for r in rows) for k in (0, 1)]
    assert 200 < by[0] <= 300 and 200 < by[1] <= 300


def test_fresh_names():
    assert fresh("a", ["b"]) == "a" and fresh("a", ["A", "a_"]) == "a__"
