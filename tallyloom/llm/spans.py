"""Positions of pattern matches with DataFrame functions only.

``found`` spreads every match of every pattern over rows (row key, kind, number, hit, context); ``placed`` turns the lengths of the
gaps and hits before a match into code point positions with a window over one document's matches.  Texts never leave
the scan's stage: one shuffle moves the matches, and documents without any come through as one row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEFORE, AFTER = 40, 20


@dataclass(frozen=True)
class Kind:
    """A pattern; ``needs``: a string that every match contains, tested before the pattern runs.

    ``wide``: the context runs across neighbouring matches, each of at least two characters, instead of ending at them.
    """
    name: str
    pattern: str
    needs: str = ""
    wide: bool = False


def found(docs: DataFrame, kinds: list[Kind]) -> DataFrame:
    """rid (row key), doc_id, kind, number, gap, hit, context (lower-cased text around it); kind is null for a row without matches."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    none = F.array().cast("array<string>")

    def only_if(kind, value):
        return F.when(F.contains(F.col("text"), F.lit(kind.needs)), value).otherwise(none) if kind.needs else value
    hits = rows.select("*", *[only_if(k, F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0))).alias(f"h_{k.name}") for k in kinds])
    gaps = hits.select("rid", "doc_id", *[f"h_{k.name}" for k in kinds], *[
        F.when(F.size(f"h_{k.name}") > 0, F.split("text", k.pattern, -1)).otherwise(none).alias(f"g_{k.name}") for k in kinds])

    def matches(k):
        gap = F.col(f"g_{k.name}")

        def one(hit, i):
            left, right = gap[i], gap[i + 1]
            if k.wide:
                hits, first, last = F.col(f"h_{k.name}"), F.greatest(i - BEFORE // 2, F.lit(0)), F.least(i + 1 + AFTER // 2, F.size(gap) - 1)
                end, start = (lambda x: F.right(x, F.lit(BEFORE))), (lambda x: F.left(x, F.lit(AFTER)))
                left = F.array_join(F.transform(F.sequence(first, i), lambda j: F.concat(F.coalesce(F.when(j > first, end(F.get(hits, j - 1))), F.lit("")), end(F.get(gap, j)))), "")
                right = F.array_join(F.transform(F.sequence(i + 1, last), lambda j: F.concat(start(F.get(gap, j)), F.coalesce(F.when(j < last, start(F.get(hits, j))), F.lit("")))), "")
            near = F.concat(F.right(left, F.lit(BEFORE)), F.lit(" "), F.left(right, F.lit(AFTER)))
            return F.struct(F.lit(k.name).alias("kind"), i.alias("number"), F.length(gap[i]).cast("bigint").alias("gap"), hit.alias("hit"), F.lower(near).alias("context"))
        return F.transform(f"h_{k.name}", one)
    return gaps.select("rid", "doc_id", F.explode_outer(F.concat(*[matches(k) for k in kinds])).alias("m")).select("rid", "doc_id", "m.*")


def placed(matches: DataFrame) -> DataFrame:
    """Adds start and end (exclusive, code points); all rows of a document are in one partition."""
    before = Window.partitionBy("rid", "kind").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("hit").cast("bigint")
    return (matches.repartition("rid").withColumn("end", F.sum(F.col("gap") + size).over(before))
            .withColumn("start", F.col("end") - size))


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def joined(kept: Column, order: list[str], base: Column | None = None) -> Column:
    """kind:start:end of the rows of a group that ``kept`` marks, in ``order``, comma-joined."""
    entry = F.when(kept, F.struct(*order, F.concat_ws(":", "kind", "start", "end").alias("said")))
    return F.concat_ws(",", F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["said"]))
