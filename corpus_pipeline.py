"""Training-corpus pipeline: toxic documents out, exact and near duplicates out, benchmark items out, sources mixed.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import decontaminate, exact_dedup, mixing, near_dedup, toxicity as toxic_terms
from tallyloom.llm.storage import dropped, located, shared_folder, stored


def _staying(docs: DataFrame, operator, stays: str) -> DataFrame:
    """Rows of ``docs`` that the operator's column ``stays`` marks.

    The locators of the rows that go are written, and the operator's working tables are deleted, before the join.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark)
    verdicts = operator(docs, folder=f"{folder}/work")
    gone = stored(verdicts.filter(~F.col(stays)).select("file", "at"), f"{folder}/gone")
    rows = located(docs, folder)
    dropped(spark, f"{folder}/work")
    return rows.join(gone, ["file", "at"], "left_anti").select("row.*")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxic_terms.toxicity(docs, labels).filter("predicted = 0").select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest doc_id."""
    return _staying(docs, exact_dedup.exact_duplicates, "kept")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id; sets of five-word runs."""
    return _staying(docs, near_dedup.near_duplicates, "stays")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contamination(docs, benchmark).filter(F.size("hits") == 0).select("row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once per use in the mixture, with its place."""
    return mixing.epochs(mixing.mix(docs), docs.columns)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", decontamination), ("mixing", mixture)]
ORACLE_SQL = None  # the learned stages have no SQL; tests/llm compares run() with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), shared_folder(spark)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return docs
