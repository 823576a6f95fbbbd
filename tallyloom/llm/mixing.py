"""Mixing sources to target weights by temperature.

A source with token share p gets the weight p^t / sum p^t.  The exponent t in [0, 1] is bisected: t = 1 keeps the shares, smaller values
flatten them.  The smallest t is taken whose weights repeat no source more than ``max_repeats`` times as often as the least
repeated one; with ``target_entropy`` (share of the greatest possible entropy) t is no smaller than that target asks for.

The budget defaults to the smallest at which every document is used at least once.  A source is realised in epochs: whole ones use every
document, and the last, partial one takes documents along a permutation made of blocks: the documents of a source are dealt to blocks by
hash, blocks are permuted by hash, and documents inside a block too.  A document is used once more if its place (tokens before it in
the permutation) is below the partial epoch's tokens.  Prefix sums run over block totals first and inside one block after, so no
task gathers a source, however large.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.storage import shared_folder, stored

BLOCK_DOCUMENTS = 2000
SOURCES, SALTS = 100_000, 64  # rows of a table that is broadcast at most; keys over which a source is spread beyond
MAX_REPEATS, TARGET_ENTROPY = 2.0, 0.98


def weights(tokens: dict[str, int], max_repeats: float = MAX_REPEATS, target_entropy: float = TARGET_ENTROPY) -> tuple[float, dict[str, float]]:
    """(exponent, weight per source) of the sources that have tokens."""
    total = sum(tokens.values())
    shares = {s: n / total for s, n in tokens.items() if n}

    def at(t):
        raw = {s: p**t for s, p in shares.items()}
        return {s: x / sum(raw.values()) for s, x in raw.items()}

    def too_flat(t):
        w = at(t)
        ratios = [w[s] / shares[s] for s in shares]
        entropy = -sum(x * math.log(x) for x in w.values())
        return max(ratios) / min(ratios) > max_repeats or entropy > max(target_entropy * math.log(len(shares)), -sum(p * math.log(p) for p in shares.values()))
    low, high = 0.0, 1.0
    if len(shares) < 2 or not too_flat(low):
        return low, at(low)
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if too_flat(middle) else (low, middle)
    return high, at(high)


def measured(docs: DataFrame, seed: int) -> DataFrame:
    """row, source, n_tokens, key (hash that orders the documents of a block)."""
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    return (docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
            .select("row", F.coalesce(F.col("row.source").cast("string"), F.lit("")).alias("source"),
                    F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("n_tokens"),
                    F.xxhash64(F.lit(seed), F.col("row.doc_id"), text).alias("key")))


def beside(rows: DataFrame, table: DataFrame, sources: int) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row per source.

    Up to SOURCES sources the table is broadcast; beyond, rows of a source are spread over SALTS keys, so neither way gathers a source.
    """
    if sources <= SOURCES:
        return rows.join(F.broadcast(table), "source")
    salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod("key", F.lit(SALTS)).cast("int")).join(salted, ["source", "salt"]).drop("salt")


def mix(docs: DataFrame, budget: float | None = None, max_repeats: float = MAX_REPEATS, target_entropy: float = TARGET_ENTROPY, seed: int = 17) -> DataFrame:
    """row (the input row), source, n_tokens, weight (of its source), block and key (place in the permutation of its
    source: by block, then key), copies (times it is used); one row per row of ``docs``.

    A null source is the source "".  Null and empty texts have no tokens; they are used as often as the whole epochs of their source.  Without
    any tokens every row is used once.  Rows that repeat id and text share a place.  An empty table gives an empty one.

    The driver holds two rows per source: its sums, and where its partial epoch ends.  Tokens are counted once for these and once for the result.
    """
    rows = measured(docs, seed)
    spark = docs.sparkSession
    narrow = stored(rows.select("source", "n_tokens", "key"), shared_folder(spark))
    sums = narrow.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("documents")).collect()
    tokens = {r.source: r.tokens for r in sums}
    _, w = weights(tokens, max_repeats, target_entropy)
    total = budget if budget is not None else max([n / w[s] for s, n in tokens.items() if n], default=0)
    plan = [(r.source, w.get(r.source, 0.0), math.ceil(r.documents / BLOCK_DOCUMENTS), *(divmod(round(total * w[r.source]), r.tokens) if r.tokens else (1, 0))) for r in sums]
    schema = "source string, weight double, blocks bigint, epochs bigint, rest bigint"
    number = F.pmod(F.xxhash64(F.lit(seed + 1), "key"), "blocks")
    block = F.xxhash64(F.lit(seed + 2), "source", number)
    dealt = beside(narrow, spark.createDataFrame(plan, schema), len(plan)).filter("rest > 0").select("source", block.alias("block"), "key", "n_tokens", "rest")
    totals = dealt.groupBy("source", "block", "rest").agg(F.sum("n_tokens").alias("tokens"))
    so_far = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)  # one row per block
    border = (totals.withColumn("end", F.sum("tokens").over(so_far)).filter("end > rest and end - tokens <= rest")
              .groupBy("source").agg(F.min(F.struct("block", (F.col("rest") - F.col("end") + F.col("tokens")).alias("left"))).alias("b"))
              .select("source", F.col("b.block").alias("last"), F.col("b.left").alias("left")).collect())
    # documents of the one block where the partial epoch ends, about BLOCK_DOCUMENTS a source
    ends = spark.createDataFrame([tuple(r) for r in border], "source string, last bigint, left bigint")
    edge = beside(dealt, ends, len(border)).filter("block = last").select("source", "left", "key", "n_tokens")
    order = Window.partitionBy("source").orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    cut = {r.source: r.cut for r in edge.withColumn("end", F.sum("n_tokens").over(order)).groupBy("source").agg(
        F.max(F.when(F.col("end") <= F.col("left"), F.col("key"))).alias("cut")).collect()}
    last = {r.source: r["last"] for r in border}
    plan = spark.createDataFrame([(*p, last.get(p[0]), cut.get(p[0])) for p in plan], schema + ", last bigint, cut bigint")
    used = F.col("block") < F.col("last")
    used = F.coalesce(used | ((F.col("block") == F.col("last")) & (F.col("key") <= F.col("cut"))), F.lit(False))
    return beside(rows, plan, len(sums)).withColumn("block", block).select(
        "row", "source", "n_tokens", "weight", "block", "key", (F.col("epochs") + used.cast("int")).alias("copies"))


def epochs(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mixture itself: the ``columns`` of the input once per copy, with epoch, mix_block and mix_key; a reader that goes by these
    three reads whole permutations of each source.  Where the input has a column of such a name, the new one gets underscores behind it."""
    taken = {c.lower() for c in columns}

    def free(name):
        while name in taken:
            name += "_"
        return name
    spread = mixed.filter("copies > 0").withColumn("_epoch", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return spread.select(*[F.col(f"row.`{c}`") for c in columns], F.col("_epoch").alias(free("epoch")), F.col("block").alias(free("mix_block")),
                         F.col("key").alias(free("mix_key")))
