"""Corpus pipeline: quality, near-duplicates, decontamination, secrets, mixing; in this order, each on what the one before kept.

Defined results, of every stage: a null text is an empty one; very long texts are read whole; repeated rows are rows of
their own, of which the second stage keeps one; a null doc_id is kept like any other; an empty table gives an empty
result of the same columns; extra columns are carried along, whatever their names.  Each operator's module states the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlight.llm import decontam, mixing, quality, secrets, simhash
from ledgerlight.llm.common import stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score below 0.3) go."""
    return quality.keep_good(spark, docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (3-word shingles, at most 3 bits): the one with the smallest id."""
    return simhash.keep_one(spark, docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, at a word edit similarity of 0.8 or more, go."""
    return decontam.keep_clean(spark, docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking secrets are masked in the text; every document stays."""
    return secrets.redact_live(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the number of copies in ``mix_copies``."""
    return mixing.mixed_documents(spark, docs)


STAGES = [("quality", keep_quality), ("near_copies", drop_near_copies), ("decontamination", decontaminate),
          ("secrets", mask_secrets), ("mixing", mix_sources)]
#: The classifier, the searches and the draw are not SQL; tests/llm checks run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read back before the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
