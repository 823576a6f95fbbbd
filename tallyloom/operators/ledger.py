"""The ledger as a table: rows with ids and a load time, partitioned by GL date.

Only the partitions that a run touches are read and written.  A partition is replaced whole, so a run that is repeated
after a failure leaves one copy of its rows.

Beside the ledger lie two small tables.  ``_keys`` holds a sketch of the posted keys per GL date: bit vectors, one bit per hashed key, appended
with every posting and merged on read.  A row whose bit isn't set is surely new; only rows whose bit is set are looked up in the ledger,
in their own GL dates.  ``_last`` holds the greatest id of every posting.  Both are written before the ledger rows, so after a failure they know
too much at most, which costs a lookup or leaves ids out, and never too little.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import relational as R
from tallyloom.schema import LEDGER, to_ledger

PARTITION = "tran_gl_date"
ID_BUCKETS = 1024
FILE_ROWS = 1 << 18  # rows of one file of a partition, about


def read(spark: SparkSession, path: str) -> DataFrame:
    """The ledger under ``path``; an empty one before the first write."""
    schema = ", ".join(f"{c} {t}" for c, t in LEDGER.items())
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def numbered(rows: DataFrame, start, order: list[str]) -> DataFrame:
    """Ids after ``start``, dense and unique, in any order over buckets and in ``order`` inside one."""
    return R.surrogate_ids(rows, F.pmod(F.xxhash64(*order), F.lit(ID_BUCKETS)), order, "tran_id", start)


def prepared(rows: DataFrame, ledger: DataFrame, as_of, order: list[str], last: int | None = None) -> DataFrame:
    """Posting rows as ledger rows: all columns, load time, ids after the ledger's greatest (``last``, if it is known)."""
    if last is None:
        last = ledger.agg(F.coalesce(F.max("tran_id"), F.lit(0)).alias("last")).first().last
    stamped = to_ledger(rows).withColumn("created_at", F.lit(as_of).cast("timestamp_ntz"))
    return numbered(stamped.drop("tran_id"), last, order).select(*LEDGER)


def in_dates_of(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """The partitions of ``ledger`` that ``rows`` have; their dates (one value per GL date) become a partition filter."""
    days = [r[0] for r in rows.select(PARTITION).distinct().collect()]
    mine = F.col(PARTITION).isin([d for d in days if d is not None])
    return ledger.filter(mine | F.col(PARTITION).isNull() if None in days else mine)


def not_posted(rows: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys (null-safe) the ledger doesn't have.

    The ledger side is cut to the rows' GL dates first when the keys include the partition; ``rows`` are read once for that, so hand over a written table.
    """
    if PARTITION in keys:
        ledger = in_dates_of(ledger, rows)
    mine = rows.alias("r")
    theirs = ledger.select(*keys).distinct().alias("l")
    match = None
    for k in keys:
        same = F.col(f"r.{k}").eqNullSafe(F.col(f"l.{k}"))
        match = same if match is None else match & same
    return mine.join(theirs, match, "left_anti")


# --------------------------------------------------------------------------- key sketches

BITS, BUCKETS = 1 << 15, 64  # bits of a vector (the size Spark's bitmap functions have), vectors per GL date


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _spot(keys: list[str]):
    """(vector, bit) of a row's keys."""
    hashed = F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in sorted(keys)])
    return F.pmod(hashed, F.lit(BUCKETS)).cast("int"), F.pmod(F.shiftright(hashed, 8), F.lit(BITS))


def _sketch_path(path: str, keys: list[str]) -> str:
    return f"{path.rstrip('/')}_keys/{'+'.join(sorted(keys))}"


def _add_to_sketch(rows: DataFrame, path: str, keys: list[str]) -> None:
    bucket, bit = _spot(keys)
    # by month, so that a posting adds few files
    (rows.groupBy(PARTITION, bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("bits")).withColumn("month", _month())
         .repartition("month").write.mode("append").partitionBy("month").parquet(_sketch_path(path, keys)))


def _month():
    return F.coalesce(F.date_format(PARTITION, "yyyyMM"), F.lit("none"))


def _sketched_keys(spark: SparkSession, path: str) -> list[list[str]]:
    """Key lists that have a sketch beside this ledger."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}_keys")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName().split("+") for f in fs.listStatus(at)] if fs.exists(at) else []


def may_hold(rows: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """``rows`` with ``_hit``: false where the ledger surely hasn't the row's keys.  Reads the sketches of the rows' GL dates only."""
    spark = rows.sparkSession
    schema = f"{PARTITION} date, bucket int, bits binary, month string"
    if not exists(spark, _sketch_path(path, keys)):
        if not exists(spark, path):
            return rows.withColumn("_hit", F.lit(False))
        _add_to_sketch(read(spark, path), path, keys)  # a ledger from before its first sketch by these keys
    months = [r[0] for r in rows.select(_month()).distinct().collect()]
    held = in_dates_of(spark.read.schema(schema).parquet(_sketch_path(path, keys)).filter(F.col("month").isin(months)), rows)
    held = held.groupBy(F.col(PARTITION).alias("_day"), F.col("bucket").alias("_bucket")).agg(F.bitmap_or_agg("bits").alias("_bits"))
    bucket, bit = _spot(keys)
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    spotted = rows.withColumns({"_spot": bucket, "_bit": bit})
    same = F.col(PARTITION).eqNullSafe(F.col("_day")) & (F.col("_spot") == F.col("_bucket"))
    hit = F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), F.col("_bit") % 8).cast("int")) > 0, F.lit(False))
    return spotted.join(held, same, "left").withColumn("_hit", hit).drop("_spot", "_bit", "_day", "_bucket", "_bits")


def last_id(spark: SparkSession, path: str) -> int | None:
    """The greatest id given so far, or None if only the ledger itself can tell."""
    at = f"{path.rstrip('/')}_last"
    return spark.read.schema("last bigint").parquet(at).agg(F.max("last")).first()[0] if exists(spark, at) else None


def _dealt(rows: DataFrame) -> DataFrame:
    """``rows`` by GL date, a date's in as many parts as its number of rows asks for, so that a posting adds one file to most dates."""
    parts = rows.groupBy(F.col(PARTITION).alias("_day")).agg(F.ceil(F.count(F.lit(1)) / FILE_ROWS).alias("_parts"))
    dealt = rows.join(parts, F.col(PARTITION).eqNullSafe(F.col("_day")))
    return dealt.repartition(PARTITION, F.pmod(F.col("tran_id"), F.col("_parts"))).drop("_day", "_parts")


def append(rows: DataFrame, path: str, as_of, keys: list[str], staging: str) -> DataFrame:
    """Post ``rows`` (the columns of a posting) to the ledger under ``path`` unless their ``keys`` are there; the new rows.

    A repeat adds nothing: the keys are found, and a half-written partition is not visible, since files are committed at the end of the job.
    With the GL date among the keys, partitions that can't hold a key aren't read.
    """
    spark = rows.sparkSession
    ledger = read(spark, path)
    if PARTITION in keys:
        flagged = R.stored(may_hold(R.stored(to_ledger(rows), f"{staging}/asked"), path, keys), f"{staging}/flagged")
        doubtful = not_posted(flagged.filter("_hit"), ledger, keys)
        new = flagged.filter("not _hit").unionByName(doubtful).drop("_hit")
    else:
        new = not_posted(to_ledger(rows), ledger, keys)
    fresh = R.stored(prepared(new, ledger, as_of, keys, last_id(spark, path)), f"{staging}/fresh")
    known = {tuple(sorted(k)) for k in _sketched_keys(spark, path)} | ({tuple(sorted(keys))} if PARTITION in keys else set())
    for each in sorted(known):
        _add_to_sketch(fresh, path, list(each))
    top = fresh.agg(F.max("tran_id")).first()[0]
    if top is not None:
        spark.createDataFrame([(top,)], "last bigint").write.mode("append").parquet(f"{path.rstrip('/')}_last")
    _dealt(fresh).write.mode("append").partitionBy(PARTITION).parquet(path)
    return fresh


def rewrite(changed: DataFrame, path: str, staging: str) -> None:
    """Put ``changed`` rows (whole ledger rows, by tran_id) in place of those in the ledger, partition by partition.

    The GL dates of the changed rows decide which partitions are read and overwritten; the rest of the ledger isn't touched.
    """
    spark = changed.sparkSession
    changed = R.stored(changed.select(*LEDGER), f"{staging}/changed")
    for keys in _sketched_keys(spark, path):  # a changed key is a posted key
        _add_to_sketch(changed, path, keys)
    old = in_dates_of(read(spark, path), changed)
    kept = old.join(changed.select("tran_id"), "tran_id", "left_anti")
    whole = R.stored(kept.select(*LEDGER).unionByName(changed), f"{staging}/partitions")
    _dealt(whole).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION).parquet(path)
