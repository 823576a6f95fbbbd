"""Exact duplicates with disk-backed streaming state.

Documents arrive as a stream of digests; the state (RocksDB, no watermark, so nothing expires) retains per digest the
number of rows, the identifier of the row that stays and its content locator (file and row number).  Partial counts
and maxima are made before the shuffle, so a text that holds a third of all rows sends one row per task.  A digest that hits
is only a hint: the bytes of every such row are compared with the bytes at the locator, and digests that stand for several
texts are regrouped by their texts.

The state folder can be kept and the next delivery run against it (``retain`` with the same folder).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.storage import located, shared_folder, stored

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",  # all stores of an executor together
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else every store reserves megabytes of disk ahead
}
BATCH = 64 * 2**30  # bytes of arrivals per micro-batch
PER_BLOCK = 1000


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def retain(arrivals: DataFrame, folder: str) -> DataFrame:
    """Run the stream ``arrivals`` (digest, doc_id, file, at) into the state under ``folder``; the state as a table:
    digest, group_size, keep (doc_id, file, at: largest doc_id, ties to the last locator)."""
    spark = arrivals.sparkSession

    def save(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/changes/number={number}")

    before = {key: spark.conf.get(key, None) for key in ROCKSDB}
    for key, value in ROCKSDB.items():
        spark.conf.set(key, value)
    try:
        seen = arrivals.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "file", "at")).alias("keep"))
        (seen.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/state").foreachBatch(save)
             .trigger(availableNow=True).start().awaitTermination())
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    schema = "digest string, group_size bigint, keep struct<doc_id: bigint, file: string, at: bigint>, batch bigint"
    changes = spark.read.schema(schema).parquet(f"{folder}/changes/number=*")
    return changes.groupBy("digest").agg(F.max(F.struct("batch", "group_size", "keep")).alias("last")).select(
        "digest", "last.group_size", "last.keep")


def collisions(texts: DataFrame, groups: DataFrame, folder: str) -> DataFrame:
    """Digests of ``groups`` (with several rows) that stand for more than one text, by comparing the bytes of every row.

    ``texts``: digest, file, at, text.  A group of n rows is cut into n / PER_BLOCK blocks, each with its own copy of the
    text that stays.
    """
    several = groups.filter("group_size > 1").withColumn("blocks", (F.col("group_size") / PER_BLOCK).cast("bigint") + 1)
    hits = stored(texts.join(several, "digest").withColumn("block", F.pmod(F.xxhash64("file", "at"), "blocks")), f"{folder}/hits")
    kept = (hits.filter("file = keep.file and at = keep.at")
            .select("digest", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("text").alias("kept")))
    return hits.join(kept, ["digest", "block"]).filter("text <> kept").select("digest").distinct()


def exact_duplicates(docs: DataFrame, digest=sha256, folder: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, and the locator (file, at).

    Texts are equal when they are identical; null counts as empty.  Of equal texts the row with the largest doc_id stays; of rows
    that also repeat the doc_id the last by (file, at), so exactly one row of a group has ``kept``.  A null doc_id is smaller
    than any other.  ``digest`` maps a text column to a string column.  The result reads tables under ``folder`` (default: a new one).
    """
    spark, folder = docs.sparkSession, folder or shared_folder(docs.sparkSession)
    rows = located(docs, folder).select(F.col("row.doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("row.text").cast("string"), F.lit("")).alias("text"), "file", "at")
    arrivals = stored(rows.select(digest(F.col("text")).alias("digest"), sha256(F.col("text")).alias("text_sha256"), "doc_id", "file", "at"), f"{folder}/arrivals")
    stream = spark.readStream.schema(arrivals.schema).option("maxBytesPerTrigger", BATCH).parquet(f"{folder}/arrivals")
    groups = stored(retain(stream.select("digest", "doc_id", "file", "at"), folder), f"{folder}/groups")
    texts = rows.select(digest(F.col("text")).alias("digest"), "file", "at", "text")
    wrong = stored(collisions(texts, groups, folder), f"{folder}/collisions")
    resolved = arrivals.join(groups, "digest")
    if not wrong.isEmpty():
        mixed = texts.join(wrong, "digest").join(arrivals.select("file", "at", "doc_id", "text_sha256"), ["file", "at"])
        own = mixed.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "file", "at")).alias("keep"))
        resolved = resolved.join(wrong, "digest", "left_anti").unionByName(mixed.join(own, ["digest", "text"]).select(*resolved.columns))
    return resolved.select("doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
                           F.expr("file = keep.file and at = keep.at").alias("kept"), "text_sha256", "file", "at")
