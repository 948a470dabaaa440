"""The numbered operators as queries over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintner.llm import bpe_tree, quality_svm, toxicity_chain
from vintner.llm.decontamination import contaminated
from vintner.llm.html_main_text import extract
from vintner.llm.packing import pack
from vintner.llm.robust_outliers import judged
from vintner.llm.shared import table
from vintner.llm.simhash_dedup import classes
from vintner.llm.source_divergence import audit
from vintner.llm.token_counts import counts_after_edits
from vintner.llm.training_order import materialise, read_shards
from vintner.llm.warc import archive_and_read
from vintner.llm.whitening import whitened

#: Least score of a document that is predicted to be good.
GOOD = 0.3


def held_out(doc_id: Column) -> Column:
    """Whether no model may learn from the label of this document."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))


def op1_quality_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_svm.fit(docs, training_labels(spark, sf_dir), "quality")
    scored = quality_svm.with_scores(docs, model).drop("text")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))


def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op4_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_and_read(table(spark, sf_dir, "pages"))


def op6_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence with its slot and place, its checksum taken from the shard read back."""
    written = materialise(table(spark, sf_dir, "documents"))
    read = read_shards(written.drop("ids_crc32")).withColumn("ids_crc32", F.crc32("ids"))
    return read.drop("ids", "path")


def op7_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity_chain.fit(docs, training_labels(spark, sf_dir))
    scored = toxicity_chain.with_categories(docs, chain).drop("text")
    return scored.withColumn("toxic", F.col("p_toxic") >= toxicity_chain.THRESHOLD)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_after_edits(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact deviation as a long; null where a long cannot hold it."""
    rows = whitened(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe_tree.with_bytes(bpe_tree.with_ids(table(spark, sf_dir, "documents")))
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op1_quality_svm": op1_quality_svm,
    "op2_simhash": op2_simhash,
    "op3_html_main_text": op3_html_main_text,
    "op4_robust_outliers": op4_robust_outliers,
    "op5_warc": op5_warc,
    "op6_training_order": op6_training_order,
    "op7_toxicity_chain": op7_toxicity_chain,
    "op8_packing": op8_packing,
    "op9_token_counts": op9_token_counts,
    "op10_decontamination": op10_decontamination,
    "op11_whitening": op11_whitening,
    "op12_source_divergence": op12_source_divergence,
    "op13_byte_bpe": op13_byte_bpe,
}
ORACLE: dict[str, str] = {
    "op5_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload FROM pages
        ), d AS (
            SELECT page_id, octet_length(encode(payload)) AS payload_bytes, sha1(payload) AS payload_digest FROM p
        ), f AS (
            SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS first
            FROM d
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM f
    """,
    "op12_source_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents
        ), t AS (
            SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
        ), kept AS (
            SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 30
        ), g AS (
            SELECT DISTINCT lang, source FROM d
        ), v AS (
            SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang
        ), c AS (
            SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term
        ), s AS (
            SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY g.lang, g.source
        ), p AS (
            SELECT s.lang, s.source, kept.term, coalesce(c.n, 0) AS n,
                   CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (s.n + 5 * v.v) AS BIGINT) AS p,
                   CAST(1 + (1000000000::HUGEINT * (kept.n + 5)) // (v.n + 5 * v.v) AS BIGINT) AS q
            FROM s JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN c ON (c.lang, c.source, c.term) = (s.lang, s.source, kept.term)
        ), pair AS (
            SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), every AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pair.value, 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pair ON (pair.lang, pair.source, pair.item) = (a.lang, a.source, b.source)
            UNION ALL
            SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM every
        )
        SELECT * FROM r WHERE part = 'pair' OR rank <= 50
    """,
}
