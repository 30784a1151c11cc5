"""Raw documents to packed training sequences: quality rules, quality classifier, near-duplicates, repeated passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import classifier, packing, quality, simhash, substrings
from larder.llm.common import table
from larder.plans.registry import query
from larder.session import cut


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or whose n-grams are unlike the trusted target go."""
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below its threshold go. It learns from the whole documents table: the rules before it leave hardly
    any example of label 0."""
    return classifier.kept_documents(docs, table(spark, sf_dir, "labels"), training=table(spark, sf_dir, "documents"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.kept_documents(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows that start anywhere else go; every document stays, with its new length."""
    cleaned = substrings.cleaned_documents(docs)
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def mixture_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full sequences in the mixture of the sources, with their ids."""
    pieces = packing.pack(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substring_dedup),
    ("mixture_packing", mixture_packing),
]

#: No stage but the base rule can be put in SQL; the tests compare the stages with brute-force versions.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each one's rows written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
