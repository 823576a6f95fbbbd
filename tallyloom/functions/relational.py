"""Relational patterns the operators share, written so that no key value decides the size of a task.

* first-per-key goes through a grouped minimum (combined on the map side) and a join on
  the unique row id, so a key that holds a third of the rows is never gathered;
* ranks inside a group are built from a histogram plus a short rank inside one bucket;
* NULL join keys are split off before an outer join instead of meeting in one partition;
* no join carries a broadcast hint: Spark broadcasts a side only after checking its size
  against ``spark.sql.autoBroadcastJoinThreshold``, else it merges sorted sides, which
  AQE splits when one is skewed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_ids(df: DataFrame, keys: list[str], moment: str, row_id: str) -> DataFrame:
    """Id of the first row of every key by (``moment``, ``row_id``), a missing moment first; NULL keys form a group of their own.

    Moment (microseconds) and id are packed into one decimal, a fixed-width minimum that Spark hash-aggregates on the map side; a
    minimum over a struct would sort all rows first.
    """
    low, wide = F.lit(str(2**63)).cast("decimal(20,0)"), F.lit(str(10**20)).cast("decimal(21,0)")
    at = F.coalesce(F.unix_micros(F.col(moment).cast("timestamp")), F.lit(-(10**17)))
    packed = ((at + F.lit(10**17)).cast("decimal(18,0)") * wide + (F.col(row_id).cast("decimal(20,0)") + low)).cast("decimal(38,0)")
    first = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return first.select(*keys, (F.col("_first") % wide - low).cast("bigint").alias(row_id))


def split(df: DataFrame, other: DataFrame, keys) -> tuple[DataFrame, DataFrame]:
    """Rows with a match in ``other`` and rows without one."""
    return df.join(other, keys, "left_semi"), df.join(other, keys, "left_anti")


def not_in(df: DataFrame, column: str, listed: DataFrame) -> DataFrame:
    """SQL ``NOT IN``: nothing qualifies once the list holds a NULL, and a NULL never qualifies.

    Plain anti join plus one scalar test on the list; Spark's own null-aware anti join
    has to broadcast the list.
    """
    name = listed.columns[0]
    has_null = listed.select(F.coalesce(F.max(F.col(name).isNull()), F.lit(False)).alias("has_null"))
    known = listed.filter(F.col(name).isNotNull()).select(F.col(name).alias(column))
    return (df.filter(F.col(column).isNotNull()).filter(~has_null.scalar())
              .join(known, column, "left_anti"))


def one_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One whole row per key, the smallest by ``order``; combined on the map side."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def update_from(target: DataFrame, updates: DataFrame, keys: list[str], columns: list[str],
                order: list[str] | None = None) -> DataFrame:
    """Overwrite ``columns`` of matched target rows.

    Several source rows per key would fan out, so the source is first reduced to the
    smallest row by ``order`` (default: the columns themselves).
    """
    unknown = [c for c in [*keys, *columns] if c not in target.columns]
    if unknown:
        raise ValueError(f"update_from: the target has no {unknown}")
    source = one_per_key(updates.select(*keys, *columns), keys, order or columns)
    source = source.select(*keys, F.struct(*columns).alias("_new"))
    joined = target.join(source, keys, "left")
    hit = F.col("_new").isNotNull()
    return joined.select(*[
        F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in target.columns])


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    fresh = rows.join(target.select(*keys), keys, "left_anti")
    return union_all(target, fresh).select(*target.columns)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Insert new keys whole; of known keys overwrite only ``columns``.  One full outer join."""
    rest = [c for c in target.columns if c not in keys]
    t = target.select(*keys, F.struct(*rest).alias("_old"))
    s = source.select(*keys, F.struct(*[c for c in rest]).alias("_new"))
    joined = t.join(s, keys, "full_outer")
    known, fresh = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    def value(c):
        if c in keys:
            return F.col(c)
        take_new = ~known if c not in columns else fresh
        return F.when(take_new, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c)

    return joined.select(*[value(c) for c in target.columns])


def penny_rank(rows: DataFrame, group: list[str], tie: str, amount: str, target: str) -> DataFrame:
    """Rows of each group that must move by one cent so that ``amount`` adds up to ``target``.

    The difference in cents is spread over the largest positive amounts, one cent each.
    Equal amounts rank by (``tie`` mod 64, ``tie``), which makes the order a concatenation
    of buckets (amount, salt): a bucket's offset comes from a histogram, and only the rows
    of one bucket are numbered together.  A group of any size is thus spread over its
    distinct amounts times 64 tasks.  Groups in balance drop out before the ranking, and
    the histogram and the numbering read one exchange.

    Returns group, tie, cent (+0.01 or -0.01).
    """
    bucket = [*group, amount, "_salt"]
    sums = rows.groupBy(*group).agg(
        F.round((F.coalesce(F.max(target), F.lit(0)) - F.sum(F.coalesce(F.col(amount), F.lit(0)))) * 100, 0).cast("bigint").alias("_off")
    ).filter("_off <> 0")
    # the join below would push these tests under the exchange on one side only, and so lose its reuse
    salt = F.pmod(F.col(tie), F.lit(SALTS))
    usable = (F.col(amount) > 0) & F.col(tie).isNotNull() & salt.isNotNull()
    for key in group:
        usable = usable & F.col(key).isNotNull()
    spread = (rows.select(*group, tie, amount).filter(usable)
                  .withColumn("_salt", salt)
                  .repartition(*[F.col(c) for c in bucket]))
    hist = spread.groupBy(*bucket).agg(F.count(tie).alias("_n"))
    above = Window.partitionBy(*group).orderBy(F.col(amount).desc(), F.col("_salt")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (hist.join(sums, group)
                   .withColumn("_before", F.coalesce(F.sum("_n").over(above), F.lit(0)))
                   .filter(F.col("_before") < F.abs("_off")).select(*bucket, "_off", "_before"))
    inside = Window.partitionBy(*bucket).orderBy(tie)
    return (spread.join(offsets, bucket)
                  .withColumn("_rn", F.row_number().over(inside))
                  .filter(F.col("_before") + F.col("_rn") <= F.abs("_off"))
                  .select(*group, tie, F.when(F.col("_off") > 0, F.lit(0.01)).otherwise(F.lit(-0.01))
                          .cast("decimal(3,2)").alias("cent")))


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a result that several later steps read, and hand back the table.  It also cuts the lineage:
    a lost executor rereads the table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def surrogate_ids(df: DataFrame, bucket: Column, order: list[str], name: str, start=0) -> DataFrame:
    """Dense ids after ``start``: number inside a bucket, plus the rows of the buckets before it.

    Stands in for an autoincrement column.  Only the per-bucket counts meet in one task.
    """
    b = df.withColumn("_bucket", bucket)
    counts = b.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # one row per bucket, so the single-partition window is bounded by the bucket count
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_bucket").orderBy(*order)
    numbered = b.withColumn("_rn", F.row_number().over(inside)).join(offsets, "_bucket")
    return numbered.withColumn(name, F.col("_offset") + F.col("_rn") + F.lit(start)).drop("_bucket", "_offset", "_rn")
