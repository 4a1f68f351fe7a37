"""The corpus pipeline: quality rules, quality classifier, near duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the docs of the
next one. All but the last return the columns of ``documents``, with the documents that they keep: those the rules do
not reject, those with a sufficient quality score, one of each group of near duplicates (the smallest ``doc_id``),
those without benchmark passages. The last returns a row for each packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dumpscope.llm import classifier, decontaminate, jaccard, packing, quality_rules
from dumpscope.llm.common import written


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Learns from the given documents: the rules leave too few labelled 0.
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return classifier.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), given)


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", rules_stage),
    ("quality_classifier", classifier_stage),
    ("ngram_jaccard", duplicates_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: The stages learn and tokenise; SQL cannot express them. Tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
