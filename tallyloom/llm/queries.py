"""The dealt operators as named queries over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import (alignment, decontaminate, exact_dedup, lm_scoring, mixing, near_dedup, pii, ranked_search, secret_scan,
                           sentence_pieces, token_counts, toxicity, url_filter)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query
def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op2_minhash_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(documents(spark, sf_dir), words=4).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op3_masked_lm_scoring(spark, sf_dir):
    return lm_scoring.lm_scores(documents(spark, sf_dir))


@query
def op4_temperature_mixing(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir)).select("row.doc_id", "source", "n_tokens", "weight", "block", "key", "copies")


@query
def op5_secret_scan(spark, sf_dir):
    return secret_scan.secret_report(documents(spark, sf_dir))


@query
def op6_toxicity(spark, sf_dir):
    return toxicity.toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


@query
def op7_token_counts(spark, sf_dir):
    return token_counts.token_counts(documents(spark, sf_dir))


@query
def op8_decontamination(spark, sf_dir):
    found = decontaminate.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", (F.size("hits") > 0).alias("contaminated"), F.array_sort(F.col("hits.item_id")).alias("item_ids"),
                        F.coalesce(F.array_max("hits.share"), F.lit(0.0)).alias("share"))


@query
def op9_url_filter(spark, sf_dir):
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


@query
def op10_pii(spark, sf_dir):
    return pii.pii_report(documents(spark, sf_dir))


@query
def op11_tokenizer_alignment(spark, sf_dir):
    return alignment.alignments(documents(spark, sf_dir))


@query
def op12_ranked_search(spark, sf_dir):
    return ranked_search.ranked(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@query
def op13_sentence_pieces(spark, sf_dir):
    return sentence_pieces.digests(sentence_pieces.pieces_and_back(documents(spark, sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
