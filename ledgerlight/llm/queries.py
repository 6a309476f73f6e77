"""Queries of the thirteen operators and the pipeline, over whole tables; SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import ann, decontam, licenses, lm, manifest, mixing, negatives, oracles, pii, quality, secrets, simhash, urls, warc
from .common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(spark, table(spark, sf_dir, "documents"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(spark, table(spark, sf_dir, "embeddings"), every=20, k=20)


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(spark, table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(spark, table(spark, sf_dir, "documents"))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(spark, table(spark, sf_dir, "pages"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(spark, table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(spark, table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(spark, table(spark, sf_dir, "documents"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(spark, table(spark, sf_dir, "embeddings"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(spark, table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_quality, op2_pii, op3_neighbours, op4_licenses, op5_decontamination, op6_secrets,
                                   op7_urls, op8_simhash, op9_lm, op10_mixing, op11_manifest, op12_negatives, op13_warc, pipeline)}
#: The other operators are models, draws and fingerprints that SQL cannot say; tests/llm holds them against brute force.
ORACLES: dict[str, str] = dict(oracles.ORACLES)
