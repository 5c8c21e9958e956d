"""Corpus pipeline: quality rules, near-duplicates, decontamination, secrets, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``.  A filtering stage ships only ids to
the join that drops documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendwatch.llm import decontam, near_dup, packing, quality, secret_scan
from spendwatch.llm.common import stage, table, workers_import

# Tokenisation and the randomness battery are beyond SQL; the tests compare
# run() with a brute-force version.
ORACLE_SQL = None


def _keeping(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """``docs`` semi or anti joined to one-column ``ids``; a null id matches a null id."""
    ids = ids.select(F.col("doc_id").alias("other_id"))
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["other_id"]), how)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the risk-controlled cutoffs."""
    judged = quality.judge(docs, table(spark, sf_dir, "labels"))
    return _keeping(docs, judged.where("kept"), "left_semi")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (similarity 0.8 or more); a repeated row stays once."""
    workers_import(spark)
    # 28 bands of 4 values miss a pair at 0.8 with a probability below 1e-6.
    found = near_dup.near_duplicates(docs, percent=80, bands=28, rows=4, batch=28)
    return _keeping(docs, found.where("kept"), "left_semi").dropDuplicates(["doc_id", "text"])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    found = decontam.contained_items(docs, table(spark, sf_dir, "benchmark"))
    return _keeping(docs, found.select("doc_id").distinct(), "left_anti")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret's text replaced by a mark and n_chars to match."""
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences of at most 2048 tokens."""
    workers_import(spark)
    return packing.pack(docs, special_tokens=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
