"""The message router of all nine types as an incremental job on keyed state.

Messages arrive as files and every message gets a fate.  A batch of them is written with keys once (``keyed``); an aggregate on RocksDB state, which runs
inside the batch and reads that batch's keys only, gives for every key the first message ever to take it; the fates follow by joins of keys, and a
join on the row's number brings them to the messages, piece by piece.

* ``error``: a gift-card adjustment or order cancel whose key came before, in an earlier batch or earlier in this one;
* ``known``: a message of another type whose key an earlier batch took;
* ``unprocessed``: a shipment that waits for its last part, until the order's last part comes or ``wait`` seconds pass without a message of
  the order; then it comes out once more as ``released``, or as ``known`` if its key was taken meanwhile;
* ``queue``: taken; its key stays in the state.

Taken and released messages are parsed into their type's staging table.  The first message of a key to arrive counts: inside a batch the
earliest by time and id, across batches the one of the earlier batch even if its time is later.  Keys stay without expiry.

A batch costs what it holds and what waits (``waiting``, rewritten by every batch with the fates of those that come out).  It has its own folders.  A
retry keeps what is whole (a folder with its ``_SUCCESS``) and overwrites the rest; the aggregate commits its state with the list of the files it
took, and a minimum doesn't change by a mark seen twice, so a restart repeats nothing.

On disk: a message is kept where it came from and as routed.  Its copy in ``keyed`` goes as soon as its piece is routed, the other working tables
(``first``, ``fates``) once the batch is.  Tables are packed by zstd and shuffle files go with the query that wrote them.
"""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from tallyloom.operators import ingest, ledger

DEDUPED = ("gca", "ocn")
HELD, CLOSED = "of", "of closed"  # the type that may wait; marks of the last parts
TAKEN = ("queue", "released")
WAIT = 7 * 24 * 3600  # seconds that a shipment waits for its last part
WAREHOUSES = 100_000  # rows of the warehouse table that travel with the plan at most
PARSERS = {
    "gca": ingest.parse_gift_card_adjustment, "gcf": ingest.parse_gift_card_fulfillment, "ocn": ingest.parse_order_cancel,
    "ma": ingest.parse_membership_adjustment, "oc": ingest.parse_order_capture, "mc": ingest.parse_membership_capture,
    "cm": ingest.parse_credit_memo, "of": ingest.parse_fulfillment, "oa": ingest.explode_assignments,
}
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    # a run that ends with its files would otherwise go on for ever with empty batches, for the sake of waiting times
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    "spark.sql.parquet.compression.codec": "zstd",
    # a task writes its few types and fates side by side, else it sorts whole messages first
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    # packed text grows tenfold when read, so tasks and row groups are small
    "spark.sql.files.maxPartitionBytes": "32m",
    "parquet.block.size": str(16 << 20),
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
PART_BITS = 18  # a part of a batch has 2^18 messages at most; 2^33 is a task's first row
PIECE = 1 << 20  # messages that are routed together, about
OUT = -1  # the part of a batch that comes out of ``waiting``
MARK = ["kind", "family", "key"]


def with_keys(messages: DataFrame, fc_xref: DataFrame) -> DataFrame:
    """message_type, family (a shipment's order), id, key, at, held, last, and the message as a struct; one pass, no join."""
    ids = [r.fc for r in fc_xref.filter("is_hj").select(F.col("fc_id").cast("string").alias("fc")).limit(WAREHOUSES + 1).collect()]
    if len(ids) > WAREHOUSES:
        raise ValueError(f"more than {WAREHOUSES} warehouses")
    held, last = ingest.shipment_parts(ids)
    order = F.coalesce(F.get_json_object("json_data", "$.order_id"), F.lit(""))
    family = F.when(F.col("message_type") == HELD, order).otherwise("")
    at = F.coalesce(F.unix_micros(F.col("s3_updated_at").cast("timestamp")), F.lit(-(10**17)))
    whole = F.struct(*[F.col(c) for c in messages.columns])
    return messages.filter(F.col("message_type").isin(*PARSERS)).select(
        "message_type", family.alias("family"), "id", ingest.key_text().alias("key"), at.alias("at"), held.alias("held"), last.alias("last"), whole.alias("m"))


def _mark(kind, family, key, taken) -> Column:
    first = F.when(taken, F.struct("batch", "at", "id", "row"))
    return F.struct(kind.alias("kind"), family.alias("family"), key.alias("key"), first.alias("first"))


def marks(keyed: DataFrame) -> DataFrame:
    """What a batch does to the keys: who takes a key, and which orders got their last part.  Shipments that wait and other parts leave
    marks without a taker, which ask for the state only.  Shipments that the batch before let out take their keys and close nothing (``last`` is NULL)."""
    own = _mark(F.col("message_type"), F.col("family"), F.col("key"), ~F.col("held"))
    closing = _mark(F.lit(CLOSED), F.col("family"), F.lit(""), F.col("last"))
    both = (F.col("message_type") == HELD) & F.col("last").isNotNull()
    return keyed.select(F.explode(F.when(both, F.array(own, closing)).otherwise(F.array(own))).alias("k")).select("k.*")


def first_of_key(stream: DataFrame) -> DataFrame:
    """Per key the first message ever to take it; the built-in aggregate whose state holds the keys."""
    return stream.groupBy(*MARK).agg(F.min("first").alias("first"))


def arrived_fates(arrived: DataFrame, first: DataFrame) -> DataFrame:
    """The fate of every message of a batch, by its row."""
    own = (F.col("first.batch") == F.col("batch")) & (F.col("first.row") == F.col("row"))
    fate = (F.when(F.col("held"), "unprocessed").when(F.col("message_type").isin(*DEDUPED), F.when(own, "queue").otherwise("error"))
             .when(F.col("first.batch") < F.col("batch"), "known").otherwise("queue"))
    return arrived.join(first.withColumnRenamed("kind", "message_type"), ["message_type", "family", "key"]).select("row", fate.alias("fate"))


def in_pieces(fates: DataFrame, arrived: DataFrame) -> DataFrame:
    """Fates with the ``piece`` that each is routed with: all rows of some parts.  Only the sizes of the parts come to the driver."""
    spark, before, pieces = fates.sparkSession, 0, []
    for part, rows in arrived.groupBy("part").count().sort("part").collect():
        pieces.append((part, before // PIECE))
        before += rows
    cores, dealt = spark.sparkContext.defaultParallelism, spark.createDataFrame(pieces, "part bigint, piece int")
    count = max([p for _, p in pieces], default=0) + 1
    return (fates.join(dealt, part_of("row") == F.col("part")).select("row", "fate", "piece")
            .repartition(count * cores, "piece", F.pmod("row", F.lit(cores))).sortWithinPartitions("piece", "row"))


def part_of(row: str) -> Column:
    """A part of the batch: so many rows that one task numbered."""
    return F.shiftright(row, PART_BITS)


def waiting_fates(pending: DataFrame, first: DataFrame, now: float, wait: float) -> DataFrame:
    """Shipments that wait, with ``fate`` for those that come out now: the order's last part is there, or their time is up.

    Of several with one key the first to arrive is released.  Any message of the order starts the waiting time again.
    """
    keys = first.filter(F.col("kind") == HELD).select("family", "key", F.col("first").isNotNull().alias("_taken"))
    orders = first.filter(F.col("kind") == CLOSED).select("family", F.col("first").isNotNull().alias("_closed"))
    rows = pending.join(keys, ["family", "key"], "left").join(orders, "family", "left")
    touched = F.col("_closed").isNotNull()
    rows = rows.withColumns({"taken": F.col("taken") | F.coalesce("_taken", F.lit(False)),
                             "_out": F.when(touched, F.col("_closed")).otherwise(F.col("due") <= now),
                             "due": F.when(touched, F.lit(now + wait)).otherwise(F.col("due"))})
    best = rows.filter("_out").groupBy("family", "key").agg(F.min(F.struct("batch", "row")).alias("_best"))
    rows = rows.join(best, ["family", "key"], "left")
    leads = ~F.col("taken") & (F.col("_best.batch") == F.col("batch")) & (F.col("_best.row") == F.col("row"))
    return rows.withColumn("fate", F.when(F.col("_out"), F.when(leads, "released").otherwise("known"))).select(*pending.columns, "fate")


def route_batch(out: str, wait: float):
    """Gives the messages of a batch their fates and saves them: all by type and fate, the taken ones parsed."""
    def run(messages: DataFrame, batch: int) -> None:
        spark = messages.sparkSession
        keyed, routed, work = f"{out}/keyed/run={batch}", f"{out}/routed/batch={batch}", [f"{out}/{name}/{batch}" for name in ("first", "fates")]

        def whole(path: str) -> bool:
            return ledger.exists(spark, f"{path}/_SUCCESS")

        def once(rows: DataFrame, path: str, *by: str) -> DataFrame:
            if not whole(path):
                rows.write.mode("overwrite").partitionBy(*by).parquet(path)
            return spark.read.schema(rows.schema).parquet(path)

        def route() -> None:
            numbered = messages.withColumns({"batch": F.lit(batch).cast("bigint"), "row": F.monotonically_increasing_id()})
            arrived = once(numbered.withColumn("part", part_of("row")), keyed, "part").filter(F.col("part") != OUT)
            held = arrived.drop("part").filter("held").withColumns({"taken": F.lit(False), "due": F.lit(0.0)})
            schema = held.schema.add("fate", StringType())
            before = spark.read.schema(schema).parquet(f"{out}/waiting/{batch - 1}") if batch > 0 else spark.createDataFrame([], schema)
            keys = arrived.drop("m", "part").schema
            released = before.filter("fate = 'released'").withColumns({"held": F.lit(False), "last": F.lit(None).cast("boolean")})
            once(released.select(*keys.names), f"{keyed}/part={OUT}")

            def save(rows: DataFrame, _: int) -> None:
                taker = F.when(F.col("first").isNotNull(), F.struct("first.batch", "first.row"))
                rows.withColumn("first", taker).write.mode("overwrite").parquet(work[0])

            stream = spark.readStream.schema(keys).parquet(f"{out}/keyed")
            (first_of_key(marks(stream)).writeStream.foreachBatch(save).outputMode("update")
                .option("checkpointLocation", f"{out}/checkpoint_keys").trigger(availableNow=True).start().awaitTermination())
            first = spark.read.schema("kind string, family string, key string, first struct<batch: bigint, row: bigint>").parquet(work[0])

            pending = before.filter("fate is null").drop("fate").unionByName(held)
            waiting = once(waiting_fates(pending, first, time.time(), wait), f"{out}/waiting/{batch}")
            if not whole(work[1]):
                in_pieces(arrived_fates(arrived, first), arrived).write.mode("overwrite").partitionBy("piece").parquet(work[1])
            fates = spark.read.schema("row bigint, fate string, piece int").parquet(work[1])
            # from here on parts of the keyed messages go
            for piece, parts in fates.groupBy("piece").agg(F.sort_array(F.collect_set(part_of("row")))).sort("piece").collect():
                if not whole(f"{routed}/part={piece}"):
                    whose = fates.filter(F.col("piece") == piece).select("row", "fate")
                    rows = arrived.filter(F.col("part").isin(parts)).select("row", "m", "key").join(whose, "row").select("m.*", "key", "fate")
                    rows.write.mode("overwrite").partitionBy("message_type", "fate").parquet(f"{routed}/part={piece}")
                for part in parts:
                    ledger.remove(spark, f"{keyed}/part={part}")
            rows = waiting.filter("fate is not null").select("m.*", "key", "fate")
            rows.write.mode("overwrite").partitionBy("message_type", "fate").parquet(f"{routed}/part={OUT}")

        if not whole(f"{routed}/part={OUT}"):
            route()
        for path in (keyed, *work):
            ledger.remove(spark, path)
        schema = messages.select("m.*", "key").schema.add("fate", StringType())
        taken = spark.read.schema(schema).parquet(routed).filter(F.col("fate").isin(*TAKEN))
        for message_type, parse in PARSERS.items():
            parse(taken.filter(F.col("message_type") == message_type)).write.mode("overwrite").parquet(f"{out}/staging/{message_type}/batch={batch}")
    return run


@contextmanager
def settings(spark: SparkSession):
    """The router's settings, for as long as it lasts."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    try:
        for k, v in SETTINGS.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start_router(messages: DataFrame, out: str, fc_xref: DataFrame, wait: float = WAIT):
    """Start the job on a streaming DataFrame of queue rows; it stops once all waiting files are done.

    Waiting times that are over are seen to by the next batch that has messages.
    """
    spark = messages.sparkSession
    with settings(spark):  # a query keeps the settings it was started with
        return (with_keys(messages, fc_xref).writeStream.foreachBatch(route_batch(out, wait))
                .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start())


def run_once(queue: DataFrame, folder: str, fc_xref: DataFrame, wait: float = WAIT, **limits) -> DataFrame:
    """Write a queue as files, stream them through the router, and return ids with their fate.

    ``limits``: options of the stream's reader, such as maxBytesPerTrigger.
    """
    spark = queue.sparkSession
    with settings(spark):
        queue.write.parquet(f"{folder}/incoming")
    stream = spark.readStream.schema(queue.schema).options(**limits).parquet(f"{folder}/incoming")
    start_router(stream, folder, fc_xref, wait).awaitTermination()
    return fates(spark, folder, queue.schema)


def events(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """All events so far: the messages with key, fate and batch; a held one has a second event once it is released."""
    routed = StructType(list(schema.fields)).add("key", StringType()).add("fate", StringType()).add("batch", LongType())
    return spark.read.schema(routed).parquet(f"{out}/routed").select(*routed.names)


def fates(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """id, message_type and the fate that each message met when it arrived."""
    return events(spark, out, schema).filter("fate <> 'released'").select("id", "message_type", "fate")
