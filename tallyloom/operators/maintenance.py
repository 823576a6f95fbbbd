"""Sources, sinks and table maintenance.

Plain Parquet has no MERGE, so an update or delete is a function from the old table and
a batch to the new table; the caller writes the result to a new path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import relational as R
from tallyloom.schema import HIERARCHY


def queue_source(queue: DataFrame, message_type: str) -> DataFrame:
    """Waiting messages of one type.  Arrival order is a column (``s3_updated_at``), not a sort."""
    return queue.filter(F.col("message_type") == message_type)


def read_source(spark: SparkSession, kind: str, **options) -> DataFrame:
    """Source side of a load: ``jdbc`` (pass partitionColumn, lowerBound, upperBound and numPartitions
    to read in parallel) or any file format with ``path``."""
    if kind == "jdbc":
        return spark.read.format("jdbc").options(**options).load()
    path = options.pop("path")
    return spark.read.format(kind).options(**options).load(path)


def erp_snapshot_load(source: DataFrame, path: str, truncate: bool = True) -> DataFrame:
    """Load a source into a staging table, emptying it first, and hand back the stored table."""
    source.write.mode("overwrite" if truncate else "append").parquet(path)
    return source.sparkSession.read.schema(source.schema).parquet(path)


def append_insert(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Insert by name; columns the rows lack become NULL."""
    return target.unionByName(rows, allowMissingColumns=True).select(*target.columns)


insert_if_absent = R.insert_if_absent
update_from = R.update_from
upsert_dimension = R.upsert


def semi_delete(target: DataFrame, matches: DataFrame, keys: list[str]) -> DataFrame:
    """Delete rows for which a match exists."""
    return target.join(matches, keys, "left_anti")


def in_delete(target: DataFrame, column: str, listed: DataFrame) -> DataFrame:
    """Delete rows whose key is listed; a NULL key is never listed."""
    keys = listed.select(F.col(listed.columns[0]).alias(column))
    return target.join(keys, column, "left_anti")


def archive_move(staging: DataFrame, work: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows to archive, rows that stay)."""
    return R.split(staging, work, keys)


def quarantine_already_done(detail: DataFrame, order_detail: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """Shipment rows of lines already fulfilled or shorted: (error rows, rows that stay)."""
    done = order_detail.filter(
        F.coalesce("fulfillment_qty", F.lit(0)) + F.coalesce("short_qty", F.lit(0)) != 0).select("item_id")
    errors, kept = R.split(detail, done, "item_id")
    return errors.withColumn("error_date", F.lit(as_of).cast("timestamp_ntz")), kept


def null_fill_from_dimension(ledger: DataFrame, items: DataFrame, fc: int = 2) -> DataFrame:
    """Give type-300 rows without item group the item's hierarchy, id and cost (amount times unit cost).

    Only the rows to fill take part in the join.
    """
    gap = ((F.col("tran_type") == 300) & F.col("group_id").isNull() & F.col("sku").isNotNull())
    master = items.filter(F.col("fc_id") == fc).select(
        F.col("item_name").alias("sku"), F.struct("item_id", "net_unit_cost", *HIERARCHY.values()).alias("_item"))
    hit = F.col("_item").isNotNull()
    fill = {"item_id": F.col("_item.item_id"),
            "tran_cost_amt": F.round(F.col("tran_amt") * F.col("_item.net_unit_cost"), 2).cast("decimal(14,2)")}
    fill |= {mine: F.col(f"_item.{theirs}") for mine, theirs in HIERARCHY.items() if mine in ledger.columns}
    joined = ledger.filter(gap).join(master, "sku", "left")
    filled = joined.select(*[
        F.when(hit, fill[c]).otherwise(F.col(c)).alias(c) if c in fill else F.col(c) for c in ledger.columns])
    return filled.unionByName(ledger.filter(~F.coalesce(gap, F.lit(False))))


def link_rebate_to_fulfillment(ledger: DataFrame) -> DataFrame:
    """Point unlinked rebate rows (111) at the product row (16) of their order line.

    A line with several product rows links to the smallest id.  Other rows skip the join.
    """
    open_rebate = ((F.col("tran_sub_type_id") == 111) & F.col("fulfillment_tran_id").isNull()
                   & F.col("order_line_id").isNotNull())
    products = (ledger.filter((F.col("tran_sub_type_id") == 16) & F.col("order_line_id").isNotNull())
                      .groupBy("order_line_id").agg(F.min("tran_id").alias("_product")))
    linked = (ledger.filter(open_rebate).join(products, "order_line_id", "left")
                    .withColumn("fulfillment_tran_id", F.col("_product")).select(*ledger.columns))
    return linked.unionByName(ledger.filter(~F.coalesce(open_rebate, F.lit(False))))


def add_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Schema growth: typed NULL columns; existing ones stay."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def purge_by_predicate(df: DataFrame, condition: Column) -> DataFrame:
    """Delete rows for which the condition is true; unknown keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))
