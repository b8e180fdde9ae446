"""The corpus pipeline: quality rules, near-duplicate removal, redaction of personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from deltafolio.llm import ngram_join, packing, pii, quality
from deltafolio.llm.common import materialize, release, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the likelihood ratio reject go."""
    return quality.filter_documents(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data becomes a placeholder of its kind."""
    return pii.redact(docs, length_col="n_chars")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("ngram_jaccard", ngram_jaccard), ("personal_data", personal_data), ("best_fit_packing", best_fit_packing)]

#: Byte-pair encoding, the similarity join and the bin search have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each stored and read again; what a stage no longer needs is deleted.

    Null texts have no words and go in the first stage, and so do blank and short ones; repeated rows and rows that share an id
    leave one row (ngram_join.keep_one), rows without an id all stay; an empty table gives no pieces; further columns of documents
    are kept up to the last stage, whatever their names.
    """
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return made
        stored = materialize(made, f"pipeline-{name}")
        release(made, docs)
        docs = stored
    return docs
