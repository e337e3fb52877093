"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import fill_in_middle, license_scan, mixing, periodic_runs, warc
from tessera.llm.common import table
from tessera.llm.embedding_dedup import embedding_near_dedup
from tessera.llm.line_dedup import line_lists
from tessera.llm.ngram_join import ngram_jaccard_join
from tessera.llm.packing import pack
from tessera.llm.pii import digest, pii_spans
from tessera.llm.quality_classifier import quality_classifier
from tessera.llm.quality_rules import quality_rules
from tessera.llm.toxicity import toxicity
from tessera.session import ensure_checkpoint_dir


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pii_spans(table(spark, sf_dir, "documents")))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return r.withColumn("evidence", F.concat_ws(",", F.transform("evidence", lambda x: x.cast("string"))))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents")).drop("text_key")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = mixing.sampled(table(spark, sf_dir, "documents"))
    return r.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_lists(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_dedup(table(spark, sf_dir, "embeddings"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.archive_pages(pages, path)
    return warc.page_digest(spark, path, dict(pages.dtypes)["page_id"])


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digest(fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), tail=periodic_runs.tenth()))


QUERIES = {f.__name__: f for f in (
    op1_pii, op2_toxicity, op3_quality_rules, op4_license_scan, op5_ngram_jaccard_join, op6_mixing,
    op7_quality_classifier, op8_line_dedup, op9_packing, op10_embedding_near_dedup,
    op11_warc, op12_fill_in_middle, op13_periodic_runs)}

ORACLES = {"op4_license_scan": license_scan.oracle(), "op6_mixing": mixing.SQL, "op11_warc": warc.SQL,
           "op12_fill_in_middle": fill_in_middle.SQL, "op13_periodic_runs": periodic_runs.SQL}
