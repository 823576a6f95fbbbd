"""Secrets in texts: certain forms, and weak candidates that only count together (DataFrame functions only).

Certain: assignments of a value to a telling name, cloud access identifiers, long hexadecimal runs.  Weak parts are an identifier
(``client_id=``, ``user: ``), a secret (a long token of mixed characters) and an endpoint (a URL or host with port).
The interval join is an as-of lookup over opening and closing positions: every weak part sees the nearest part of each role that closes before
it and that opens after it; parts no farther than SCOPE code points away are in its scope (an endpoint takes up its whole URL there).  A weak identifier is reported with a secret in scope, a weak
secret with an identifier or an endpoint, an endpoint with both.  Weak parts that overlap a certain one
are dropped, and so is a weak secret that is the value of a weak identifier.
A window holds the matches of one document, so no key gathers more than that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.spans import Kind, found, joined, placed

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = [
    Kind("assign", ASSIGN),
    Kind("access", r"AKIA[A-Z0-9]+", "AKIA"),
    Kind("hex", r"[0-9a-f]{24,}"),  # a run of 24 or more; shorter runs fail anyway
    Kind("weak_id", r"(?i:client_?id|username|login|account_?id)[\x22']?\x20*[:=]\x20*[\x22']?[A-Za-z0-9._@-]+"),
    Kind("weak_key", r"[A-Za-z0-9+/_=-]{20,}"),
    Kind("endpoint", r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?", "://"),
    Kind("url", r"https?://[A-Za-z0-9.-]+[^\s\x22'<>]*", "://"),  # how far an endpoint goes on; no part itself
]
BASE = ["assign", "access", "hex"]
ROLE = {"assign": "secret", "hex": "secret", "weak_key": "secret", "access": "identifier", "weak_id": "identifier", "endpoint": "endpoint"}
SCOPE = 200


def secret_spans(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """rid, doc_id, kind, start, end, base, reported; one row with a null kind for a document without matches.

    A null text is empty; a null or repeated doc_id is no key here (rid is the row).
    """
    valid = (F.when(F.col("kind") == "assign", F.length(F.regexp_extract("hit", ASSIGN, 2)) >= 6)
             .when(F.col("kind") == "access", F.length("hit") >= 20)
             .when(F.col("kind") == "weak_key", F.col("hit").rlike("[0-9]") & F.col("hit").rlike("[a-z]") & F.col("hit").rlike("[A-Z]"))
             .otherwise(True))
    spans = placed(found(docs, KINDS)).withColumn("kind", F.when(valid, F.col("kind"))).drop("hit", "context", "gap", "number")
    number = F.array_position(F.array(*[F.lit(k.name) for k in KINDS]), F.col("kind"))
    role = F.create_map(*[F.lit(x) for pair in ROLE.items() for x in pair])[F.col("kind")]
    spans = spans.withColumn("order", number).withColumn("base", F.coalesce(F.col("kind").isin(BASE), F.lit(False))).withColumn("role", role)
    # windows only look back: one that looks ahead is ordered from the end, as Spark sums a frame without an end anew for each row
    urls = Window.partitionBy("rid").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    on = F.when(F.col("kind") == "endpoint", F.max(F.when(F.col("kind") == "url", F.col("end"))).over(urls))
    spans = spans.withColumn("reach", F.greatest(F.col("end"), on)).filter("kind is null or kind <> 'url'")
    past = Window.partitionBy("rid").orderBy("start", "order", "end").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy("rid").orderBy(F.desc("start"), F.desc("order"), F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)

    def overlapped(by):
        return (F.coalesce(F.max(F.when(by, F.col("end"))).over(past) > F.col("start"), F.lit(False))
                | F.coalesce(F.min(F.when(by, F.col("start"))).over(ahead) < F.col("end"), F.lit(False)))
    spans = spans.withColumn("value", F.coalesce(F.col("kind") == "weak_key", F.lit(False)) & overlapped(F.col("kind") == "weak_id")).filter(~F.col("value"))
    spans = spans.withColumn("covered", overlapped(F.col("base")))
    # a span opens at its start and closes where its reach ends: it looks back from its start at what has closed, ahead from its end at what opens
    events = spans.select("rid", "doc_id", "kind", "order", "start", "end", "base", "role", "covered", F.explode_outer(
        F.array(F.struct(F.col("start").alias("at"), F.lit(True).alias("opens")), F.struct(F.col("reach").alias("at"), F.lit(False).alias("opens")))).alias("e"))
    events = events.select("*", "e.at", "e.opens").drop("e")
    closed = Window.partitionBy("rid").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    coming = Window.partitionBy("rid").orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, 0)

    def near(role):
        behind = F.max(F.when(~F.col("opens") & (F.col("role") == role), F.col("end"))).over(closed)
        before = F.min(F.when(F.col("opens") & (F.col("role") == role), F.col("start"))).over(coming)
        return F.when(F.col("opens"), F.col("start") - behind).otherwise(before - F.col("end")) <= scope
    roles = ["identifier", "secret", "endpoint"]
    events = events.select("*", *[F.coalesce(near(r), F.lit(False)).alias(f"near_{r}") for r in roles])
    key = ["rid", "doc_id", "kind", "order", "start", "end", "base", "role", "covered"]
    seen = events.groupBy(*key).agg(*[F.max(f"near_{r}").alias(r) for r in roles])
    linked = F.when(F.col("role") == "identifier", F.col("secret")).when(F.col("role") == "secret", F.col("identifier") | F.col("endpoint")).when(
        F.col("role") == "endpoint", F.col("identifier") & F.col("secret"))
    return seen.select("rid", "doc_id", "kind", "order", "start", "end", "base",
                       F.coalesce(F.col("base") | (linked & ~F.col("covered")), F.lit(False)).alias("reported"))


def secret_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked (weak parts reported).

    An empty table gives no rows; a document without matches gives zeros and the digest of the empty string; repeated ids stay rows of their own.
    """
    spans = secret_spans(docs)
    return spans.groupBy("rid", "doc_id").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in BASE],
        F.sha2(joined(F.col("base"), ["start", "order", "end"]).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("reported"), ["start", "order", "end"]).alias("spans"),
        F.count(F.when(F.col("reported") & ~F.col("base"), 1)).alias("n_linked")).drop("rid")
