"""URL rules by host suffix and path prefix.

Every URL becomes its expressions: each suffix of the host at a dot, joined with each prefix of the path that ends in a slash.
Expressions meet rules on the first HASH_CHARS hexadecimal characters of their SHA-256 (an equi-join on a short key), the full digest
confirms the hit, and of several rules the longest wins.  Only shapes that some rule has are expanded (rules bound the labels and the
depth), which loses nothing and bounds the expressions of a hostile URL.  The best rule of a URL is a maximum, combined before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HASH_CHARS = 8
#: host, path, verdict
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """rank (precedence, longer rules higher, block before allow at the same length), rule, verdict, digest, short."""
    for host, path, verdict in rules:
        if not path.startswith("/") or not path.endswith("/") or verdict not in ("allow", "block") or host != host.lower():
            raise ValueError(f"a rule has a lower-case host, a path from slash to slash, and allow or block: {(host, path, verdict)}")
    ranked = sorted({(host + path, verdict) for host, path, verdict in rules}, key=lambda r: (len(r[0]), r[1] == "block", r[0]))
    df = spark.createDataFrame([(k + 1, *r) for k, r in enumerate(ranked)], "rank int, rule string, verdict string")
    digest = F.sha2(F.col("rule").cast("binary"), 256)
    return df.withColumn("digest", digest).withColumn("short", F.left(digest, F.lit(HASH_CHARS)))


def parts(urls: DataFrame) -> DataFrame:
    """Adds host and path: the host after the first ``://``, lower-cased A-Z; both empty for null or no ``://``."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring(F.col("url"), at + 3, F.length("url"))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*+", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return urls.withColumn("host", host).withColumn("path", F.regexp_extract(rest, r"(?s)^[^/?#]*+([^?#]*+)", 1))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, otherwise: str = "allow") -> DataFrame:
    """page_id, host, path, rule (null without one), verdict; one row per row of ``pages``, whatever its page_id."""
    spark = pages.sparkSession
    table = rule_table(spark, rules)
    labels = max([len(h.split(".")) for h, _, _ in rules], default=0)
    depth = max([p.count("/") for _, p, _ in rules], default=0)
    rows = parts(pages.select(F.monotonically_increasing_id().alias("rid"), F.col("page_id"), F.col("url").cast("string").alias("url"))).drop("url")
    names, steps = F.split("host", r"\."), F.split("path", "/")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(names), F.lit(max(labels, 1)))), lambda k: F.array_join(F.slice(names, -k, k), "."))
    prefixes = F.when(F.size(steps) > 1, F.transform(F.sequence(F.lit(1), F.least(F.size(steps) - 1, F.lit(max(depth, 1)))),
                                                     lambda k: F.concat(F.array_join(F.slice(steps, 1, k), "/"), F.lit("/"))))
    prefixes = F.filter(F.coalesce(prefixes, F.array().cast("array<string>")), lambda p: F.left(p, F.lit(1)) == "/")
    spread = rows.withColumn("suffix", F.explode(suffixes)).withColumn("prefix", F.explode_outer(prefixes))
    spread = spread.withColumn("full", F.sha2(F.concat("suffix", "prefix").cast("binary"), 256)).drop("suffix", "prefix")
    spread = spread.withColumn("short", F.left("full", F.lit(HASH_CHARS)))
    hits = spread.join(table.select("short", "digest", "rank"), "short", "left")
    best = hits.groupBy("rid", "page_id", "host", "path").agg(F.max(F.when(F.col("full") == F.col("digest"), F.col("rank"))).alias("rank"))
    return best.join(table.select("rank", "rule", "verdict"), "rank", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(otherwise)).alias("verdict"))
