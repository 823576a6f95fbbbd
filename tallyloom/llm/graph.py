"""Connected components of a link table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.storage import stored


def components(links: DataFrame, folder: str) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node reachable.

    Alternates two steps until the links are stars: every node passes its smallest neighbour to its larger
    neighbours, then every node points at its smallest smaller neighbour and hands the others over.  Both steps keep the
    components; the number of rounds grows with the logarithm of a component's size.  Each round is a
    written table, so nothing is recomputed and only two counts reach the driver.
    """
    step = 0
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                   f"{folder}/0")
    while True:
        step += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("a"), F.col("m").alias("b")).unionByName(
            small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        new = stored(small.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{folder}/{step}")
        if new.join(edges, ["a", "b"], "left_anti").isEmpty() and edges.join(new, ["a", "b"], "left_anti").isEmpty():
            break
        edges = new
    roots = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
                             .join(roots.select("node"), "node", "left_anti"))
