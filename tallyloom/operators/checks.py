"""Reconciliation: balance checks over staging, duplicates in the ledger, audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import relational as R
from tallyloom.functions.exprs import local_date, nz, total, whole
from tallyloom.wire import CASH, ZERO_CHARGE


def check_order_payment(header, items, payments, gift_cards, cash):
    """Orders whose parts do not add up to their tenders.  Parts and tenders are summed before the joins."""
    lines = items.groupBy("order_id").agg(F.sum("base_row_total").alias("total_product"), F.sum("tax_amt").alias("product_tax"))
    gifts = gift_cards.groupBy("order_id").agg(F.sum("gift_card_amt").alias("gift_card_amt"))
    coins = cash.filter(F.col("tc_amt") > 0).groupBy("order_id").agg(F.sum("tc_amt").alias("tc_amt"))
    parts = ["total_product", "grocery_base_shipment", "frozen_base_shipment", "wine_base_shipment",
             "grocery_base_shipment_tax", "frozen_base_shipment_tax", "wine_base_shipment_tax", "base_donations",
             "ppe_fee", "ppe_fee_tax", "product_tax"]
    tenders = ["pay_amt", "gift_card_amt", "tc_amt"]
    rows = (header.join(lines, "order_id").join(payments.select("order_id", "pay_amt"), "order_id", "left")
                  .join(gifts, "order_id", "left").join(coins, "order_id", "left"))
    rows = rows.withColumns({"expected_payment": total(*parts), "total_paid": total(*tenders)})
    return rows.filter(F.col("expected_payment") != F.col("total_paid")).select(
        "order_id", "increment_id", local_date("created_at").alias("sale_date"), "expected_payment", "total_paid",
        *[nz(c).alias(c) for c in (*tenders, "total_order", *parts)], F.lit("order").alias("order_type"))


# the columns an order error has and a membership can't fill
ORDER_ONLY = ["gift_card_amt", "tc_amt", "grocery_base_shipment", "frozen_base_shipment", "wine_base_shipment", "grocery_base_shipment_tax",
              "frozen_base_shipment_tax", "wine_base_shipment_tax", "base_donations", "ppe_fee", "ppe_fee_tax"]


def check_membership_payment(members, payments):
    """Memberships whose total misses the payment, in the columns of the order errors."""
    rows = members.join(payments.select("order_id", "pay_amt"), "order_id", "left")
    due, paid = nz("total_order"), nz("pay_amt")
    return rows.filter(due != paid).select(
        "order_id", "increment_id", local_date("updated_at").alias("sale_date"), due.alias("expected_payment"),
        paid.alias("total_paid"), paid.alias("pay_amt"), due.alias("total_order"), (due - nz("total_tax")).alias("total_product"),
        nz("total_tax").alias("product_tax"), *[F.lit(0).alias(c) for c in ORDER_ONLY],
        F.lit("membership").alias("order_type"))


def _discount_sums(header, items, payments, discounts):
    """Item discount beside the sum of its detail rows, for paid, non-gift lines."""
    off = F.col("base_amt_off_applied")

    def of(kind):
        return F.sum(F.when(F.col("discount_type") == kind, off).otherwise(0))

    detail = discounts.groupBy("item_id").agg(
        of("tpa").alias("disc_tpa_amt"), of("coupon").alias("disc_coupon_amt"),
        of("tiered_pricing").alias("disc_tiered_pricing_amt"), F.sum(nz("amt_off_applied")).alias("disc_total_amt"))
    paid = payments.filter(F.col("payment_gateway") != ZERO_CHARGE).select("order_id")
    kind = F.when(F.coalesce("parent_item_id", F.lit("0")) != "0", "component").otherwise(F.col("product_type"))
    sums = ["disc_tpa_amt", "disc_coupon_amt", "disc_tiered_pricing_amt", "disc_total_amt"]
    rows = (items.filter(F.col("is_gwp").try_cast("boolean") == F.lit(False))
                 .join(header.select("order_id", "increment_id", "created_at"), "order_id").join(paid, "order_id")
                 .join(detail, "item_id", "left"))
    # an item without detail rows counts as zero, as an outer join below the sums gives
    return rows.select(
        "order_id", "increment_id", "item_id", local_date("created_at").alias("sale_date"), "base_price",
        F.round(F.col("base_discount_amt") * F.col("qty_ordered"), 2).alias("base_discount_amt"),
        *[nz(c).alias(c) for c in sums], kind.alias("product_type")
    ).withColumn("var", F.col("disc_total_amt") - F.col("base_discount_amt"))


def check_discounts(header, items, payments, discounts, *codes):
    """Discount errors in one pass: 1 detail over item, 2 item over detail, 3 negative item discount."""
    rows = _discount_sums(header, items, payments, discounts)
    item = F.col("base_discount_amt")
    code = (F.when(item < 0, 3).when(whole("var") > 0, 1)
             .when((whole(-F.col("var")) > 0) & (F.col("base_price") != 0), 2))
    out = rows.withColumn("error_code", code).filter(F.col("error_code").isNotNull()).drop("base_price")
    return out.filter(F.col("error_code").isin(*codes)) if codes else out


def check_discount_detail_over(header, items, payments, discounts):
    return check_discounts(header, items, payments, discounts, 1)


def check_discount_item_over(header, items, payments, discounts):
    return check_discounts(header, items, payments, discounts, 2)


def check_negative_discount(header, items, payments, discounts):
    return check_discounts(header, items, payments, discounts, 3)


def check_credit_memo(credits, refunds, gift_cards):
    """Credits whose tenders (gift cards, card refund, store cash) miss their parts."""
    gifts = gift_cards.groupBy("credit_id").agg(F.sum("gift_card_amt").alias("gc_amt"))
    rows = credits.join(refunds.select("credit_id", "pay_amt"), "credit_id", "left").join(gifts, "credit_id", "left")
    parts = ["base_total_product", "base_total_discount", "base_adjustment", "base_total_tax", "base_donations",
             "base_shipment", "base_frozen_shipment", "base_wine_shipment", "ppe_fee"]
    rows = rows.withColumns({"calc_refund": total(*parts), "calc_credit": total("gc_amt", "pay_amt", f"total_{CASH}")})
    return rows.filter(F.col("calc_credit") != F.col("calc_refund")).select(
        "credit_id", "credit_increment_id", "order_id", "increment_id", local_date("updated_at").alias("credit_date"),
        *[nz(c).alias(c) for c in ("base_total_credit", "base_total_refund", "base_total_gift_cards", *parts, "base_shipment_tax",
                                   "base_frozen_shipment_tax", "base_wine_shipment_tax", "ppe_fee_tax")],
        nz("gc_amt").alias("gc_amt"), nz("pay_amt").alias("pay_amt"), "calc_refund", "calc_credit")


# --------------------------------------------------------------------------- duplicates

def ledger_duplicates(ledger, row_id="tran_id"):
    """Rows equal to another on every business column, except the one with the smallest id."""
    business = [c for c in ledger.columns if c != row_id]
    keep = ledger.groupBy(*business).agg(F.min(row_id).alias(row_id)).select(row_id)
    return ledger.join(keep, row_id, "left_anti")


def ledger_dedupe(ledger, row_id="tran_id"):
    """The ledger without those rows: the kept ids are the group minima themselves, so no join is needed."""
    business = [c for c in ledger.columns if c != row_id]
    return ledger.groupBy(*business).agg(F.min(row_id).alias(row_id)).select(*ledger.columns)


def duplicate_profile(ledger, row_id="tran_id"):
    """Number of duplicates per posting name, from group sizes alone."""
    business = [c for c in ledger.columns if c != row_id]
    copies = ledger.groupBy(*business).agg((F.count(F.lit(1)) - 1).alias("_extra")).filter(F.col("_extra") > 0)
    return copies.groupBy("tran_sub_type").agg(F.sum("_extra").alias("duplicates"))


def header_dedupe(headers):
    """Of the headers of one message the latest loaded stays."""
    latest = headers.withColumn("_age", -F.unix_micros(F.col("ods_processed_at").cast("timestamp")))
    return R.one_per_key(latest, ["message_uuid"], ["_age"]).drop("_age")


def multi_posted_lines(ledger, gl_date=None, sub_type=16):
    """Product rows of order lines posted more than once on a GL date."""
    rows = ledger.filter((F.col("tran_sub_type_id") == sub_type) & F.col("order_line_id").isNotNull())
    if gl_date is not None:
        rows = rows.filter(F.col("tran_gl_date") == F.lit(gl_date).cast("date"))
    keys = ["order_line_id", "tran_gl_date"]
    many = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys)
    return rows.join(many, keys, "left_semi")


def with_warehouse_item(ledger, fc_xref, items, *columns):
    """Item master of the ledger row's sku at its warehouse; a master row without fc counts as fc 2."""
    fc = fc_xref.select(F.col("ns_fc_id").alias("location_id"), F.col("ods_fc_id").alias("_fc"))
    goods = items.select(F.col("item_name").alias("sku"), F.coalesce("fc_id", F.lit(2)).cast("bigint").alias("_fc"), *columns)
    return ledger.join(fc, "location_id", "left").join(goods, ["sku", "_fc"], "left")


def unmatched_brand_audit(ledger, fc_xref, items, start, end):
    """Rebate rows in a date range whose item has no brand."""
    rows = ledger.filter((F.col("tran_sub_type_id") == 111)
                         & F.col("tran_gl_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return with_warehouse_item(rows, fc_xref, items, "brand_name").filter(F.col("brand_name").isNull()).drop("_fc")

