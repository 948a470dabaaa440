"""Documents to packed training sequences: good, not toxic, one of each kind, clean of benchmarks, packed.

Each stage works on all that its predecessor kept and is stored before the next one reads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintner.llm import quality_svm, toxicity_chain
from vintner.llm.decontamination import without_contaminated
from vintner.llm.packing import pack
from vintner.llm.queries import GOOD, training_labels
from vintner.llm.shared import fresh, stored, table
from vintner.llm.simhash_dedup import one_of_each


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality_svm.fit(docs, training_labels(spark, sf_dir), "quality")
    score = fresh("quality_score", docs.columns)
    return quality_svm.with_scores(docs, model, score=score).filter(F.col(score) >= GOOD).select(*docs.columns)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the last link of the toxicity chain does not reject."""
    chain = toxicity_chain.fit(docs, training_labels(spark, sf_dir))
    prefix = fresh("p_", [c[:2] for c in docs.columns])
    toxic = F.col(prefix + toxicity_chain.LABEL) >= toxicity_chain.THRESHOLD
    return toxicity_chain.with_categories(docs, chain, prefix).filter(~toxic).select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near-duplicates."""
    return one_of_each(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good),
    ("toxicity", not_toxic),
    ("SimHash near-dedup", distinct),
    ("benchmark decontamination", uncontaminated),
    ("best-fit packing", packed),
]

#: Fingerprints, models and token ids are beyond SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
