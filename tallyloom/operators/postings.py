"""Order, membership and cancel postings, and the store tables they load.

Each function reads the staging batch it is given and returns the new ledger rows; the
pipeline widens them with :func:`tallyloom.schema.to_ledger` and appends.  ``as_of`` is
the run's clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import relational as R
from tallyloom.functions.exprs import capitalise, card_label, local_date, nz, total
from tallyloom.schema import coded
from tallyloom.wire import ZERO_CHARGE


# --------------------------------------------------------------------------- corrections before posting

def _zero_charge(payments: DataFrame) -> DataFrame:
    return payments.filter(F.col("payment_gateway") == ZERO_CHARGE).select("order_id").distinct()


def _flag(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.withColumn("_hit", F.lit(True)), key, "left")


def _clear_discounts(items: DataFrame, condition: Column) -> DataFrame:
    hit = F.coalesce(condition, F.lit(False))
    return items.withColumns({
        c: F.when(hit, F.lit(0).cast(items.schema[c].dataType)).otherwise(F.col(c))
        for c in ("discount_amt", "base_discount_amt", "discount_percent")})


def fix_zero_charge_discounts(items, payments):
    """No discount on free lines of orders paid through the zero-charge gateway."""
    flagged = _flag(items, _zero_charge(payments), "order_id")
    return _clear_discounts(flagged, F.col("_hit") & (F.col("price") == 0)).select(*items.columns)


def fix_gift_card_negative_discount(items):
    return _clear_discounts(items, (nz("discount_amt") < 0) & (F.col("product_type") == "aw_giftcard"))


def reclassify_reshipment(header, payments):
    flagged = _flag(header, _zero_charge(payments), "order_id")
    return flagged.withColumn(
        "order_type", F.when(F.col("_hit"), F.lit("Reshipment")).otherwise(F.col("order_type"))).select(*header.columns)


# --------------------------------------------------------------------------- order capture

def _order(moment="created_at", kind=None) -> list[Column]:
    return [F.col(moment).alias("tran_date"), (F.col("order_type") if kind is None else kind.alias("order_type")),
            "order_id", "increment_id", "customer_id", F.lit(1).alias("company_id"), F.lit(1).alias("location_id"),
            local_date(moment).alias("sale_date"), local_date(moment).alias("tran_gl_date")]


def _card(pay_amt="base_pay_amt") -> list[Column]:
    return [F.col(pay_amt).alias("tran_amt"), F.col("cc_tran_id").alias("cc_auth"),
            F.col("cc_last_four").alias("cc_last4"), card_label("cc_type", "payment_gateway").alias("cc_type"),
            nz(pay_amt).alias("cc_pay_amt")]


def post_order_payment(header, payments):
    """100/6, one row per card payment; an order without one still posts, without amount."""
    paid = header.join(payments.drop("message_uuid"), "order_id", "left")
    return paid.select(*coded("order_payment"), *_order(), *_card(), "message_uuid")


def post_order_gift_card(header, gift_payments, cards, legacy_cards):
    """100/9 with the card's issue type, current card table before the legacy one."""
    key = F.col("gift_card_id").try_cast("bigint")
    pays = gift_payments.filter(F.col("gift_card_id").isNotNull()).select(
        "order_id", key.alias("gift_card_id"), "gift_card_amt")
    now = cards.select(F.col("card_id").alias("gift_card_id"), F.col("issue_type").alias("_now"))
    old = legacy_cards.select(F.col("giftcard_id").alias("gift_card_id"), F.col("issue_type").alias("_old"))
    rows = header.join(pays, "order_id").join(now, "gift_card_id", "left").join(old, "gift_card_id", "left")
    kind = F.coalesce("_now", "_old")
    return rows.select(
        *coded("order_gift_card"), *_order(), F.col("gift_card_amt").alias("tran_amt"),
        F.when(kind == "other", F.lit("Make-Good")).otherwise(capitalise(kind)).alias("gc_sub_type"),
        F.lit(1).alias("gc_type"), "gift_card_id")


SHIPPING_TAX = ["base_shipment_tax", "grocery_base_shipment_tax", "frozen_base_shipment_tax", "wine_base_shipment_tax"]


def post_order_charges(header, *codes):
    """Positive header amounts as postings: taxes (105) and donation (400).

    One scan: each header row spreads into its amounts, kept where positive.
    """
    shipping = total(*SHIPPING_TAX)
    amounts = {
        "product_tax": nz("base_total_tax") - nz("ppe_fee_tax") - shipping,
        "shipping_tax": shipping,
        "fee_tax": nz("ppe_fee_tax"),
        "donation": nz("base_donations"),
    }
    entries = [F.struct(*coded(c), amounts[c].cast("decimal(14,4)").alias("tran_amt")) for c in codes or amounts]
    spread = header.withColumn("_p", F.explode(F.array(*entries))).filter(F.col("_p.tran_amt") > 0)
    return spread.select("_p.*", *_order(), "message_uuid")


def post_product_tax(header):
    return post_order_charges(header, "product_tax")


def post_shipping_tax(header):
    return post_order_charges(header, "shipping_tax")


def post_fee_tax(header):
    return post_order_charges(header, "fee_tax")


def post_donation(header):
    return post_order_charges(header, "donation")


def load_order_header(header, as_of):
    now = F.lit(as_of).cast("timestamp_ntz")
    return header.withColumns({"ods_processed_at": now, "sale_date": local_date("created_at"),
                               "status": F.lit("open"), "status_date": now, "gaap_sale_date": F.lit(None).cast("date")})


def load_order_detail(items, header):
    """Lines of the batch's messages with the order's sale date; nothing shipped, short or returned yet."""
    sale = header.select("order_id", "message_uuid", local_date("created_at").alias("sale_date"))
    lines = items.join(sale, ["order_id", "message_uuid"])
    none = {c: F.lit(None).cast(t) for c, t in (("fulfillment_qty", "bigint"), ("short_qty", "bigint"), ("return_qty", "bigint"), ("fulfillment_date", "timestamp_ntz"))}
    return lines.withColumns({c: v for c, v in none.items() if c not in lines.columns})


def load_order_discounts(discounts, header):
    return discounts.join(header.select("order_id"), "order_id")


def load_order_payments(header, payments, gift_cards, cash):
    """Card, gift-card and store-cash tenders in one table."""
    sale = header.select("order_id", local_date("created_at").alias("sale_date"))
    rows = R.union_all(
        payments.withColumn("payment_type", F.lit("cc")),
        gift_cards.withColumnRenamed("gift_card_amt", "pay_amt").withColumn("payment_type", F.lit("gc")),
        cash.withColumnRenamed("tc_amt", "pay_amt").withColumn("payment_type", F.lit("tc")))
    return rows.join(sale, "order_id")


# --------------------------------------------------------------------------- assignment

def assignment_cost(assignments, order_detail, fc_xref, items):
    """Assigned warehouse and extended cost of each line; an unmapped warehouse counts as fc 2."""
    lines = order_detail.select("item_id", "sku", "qty_ordered")
    fc = fc_xref.select(F.col("ns_fc_id").alias("fc_id"), "ods_fc_id")
    cost = items.select(F.col("item_name").alias("sku"), F.col("fc_id").alias("_fc"), "net_unit_cost")
    rows = (assignments.select("item_id", F.col("fc").alias("fc_id"), "qty_assigned")
            .join(lines, "item_id").join(fc, "fc_id", "left")
            .withColumn("_fc", F.coalesce("ods_fc_id", F.lit(2)).cast("bigint")).join(cost, ["sku", "_fc"], "left"))
    return rows.select("item_id", "fc_id", "qty_assigned",
                       (F.col("net_unit_cost") * F.col("qty_ordered")).alias("ext_cost_amt"))


def apply_assignment(order_detail, work):
    """Write the assignment onto the lines; of several assignments the smallest warehouse wins."""
    updates = work.select("item_id", F.col("fc_id").alias("assignment_fc"),
                          F.col("qty_assigned").alias("assignment_qty"), "ext_cost_amt")
    columns = ["assignment_fc", "assignment_qty", "ext_cost_amt"]
    missing = {c: F.lit(None).cast(updates.schema[c].dataType) for c in columns if c not in order_detail.columns}
    return R.update_from(order_detail.withColumns(missing) if missing else order_detail, updates, ["item_id"], columns)


# --------------------------------------------------------------------------- membership

def _member_kind() -> Column:
    start = F.col("start_status")
    return F.when(start == "member", "Renewal").when(start == "canceled", "Re-Activation").otherwise("New Member")


def post_membership_payment(members, payments):
    paid = members.join(payments.drop("message_uuid"), "order_id", "left")
    return paid.select(*coded("membership_payment"), *_order("updated_at", _member_kind()), *_card(), "message_uuid")


def post_membership_gift_card(members, gift_cards):
    paid = members.join(gift_cards.filter(F.col("gift_card_id").isNotNull()).drop("message_uuid"), "order_id")
    return paid.select(*coded("membership_gift_card"), *_order("updated_at", _member_kind()),
                       F.col("gift_card_amt").alias("tran_amt"), F.lit("Purchased").alias("gc_sub_type"),
                       F.lit(2).alias("gc_type"))


def post_membership_tax(members):
    taxed = members.filter(nz("base_total_tax") > 0)
    return taxed.select(*coded("membership_tax"), *_order("updated_at", _member_kind()),
                        F.col("base_total_tax").alias("tran_amt"), "message_uuid")


def load_membership_header(members, as_of):
    return members.withColumns({"ods_processed_at": F.lit(as_of).cast("timestamp_ntz"),
                                "sale_date": local_date("updated_at"), "status": F.lit(None).cast("string"),
                                "status_date": F.lit(None).cast("timestamp_ntz")})


def load_membership_payments(members, payments, gift_cards):
    sale = members.select("order_id", local_date("updated_at").alias("sale_date"))
    rows = R.union_all(
        payments.withColumn("payment_type", F.lit("cc")),
        gift_cards.withColumnRenamed("gift_card_amt", "pay_amt").withColumn("payment_type", F.lit("gc")))
    return rows.join(sale, "order_id")


# --------------------------------------------------------------------------- cancels

def cancel_worklist(cancels, headers):
    """Cancel messages of known orders; ``is_voided`` sits in the refund JSON."""
    voided = F.get_json_object("refunds", "$.payment_detail.voided").try_cast("boolean")
    known = headers.select("order_id", "sale_date")
    return cancels.join(known, "order_id").select(
        "order_id", "message_uuid", "updated_at", "sale_date",
        F.coalesce("ms_initiated", F.lit(False)).alias("ms_initiated"),
        F.coalesce("is_fraud", F.lit(False)).alias("is_fraud"), voided.alias("is_voided"))


REVERSED_ORDER_TYPES = (100, 105, 400)
REVERSED_MEMBER_TYPES = (150, 155)


def _reverse(ledger, work, sub_types, types):
    voided = work.filter("is_voided").select(
        "order_id", F.col("message_uuid").alias("_uuid"), F.col("updated_at").alias("_at"),
        F.col("sale_date").alias("_sale"))
    names = sub_types.select("tran_type", "tran_sub_type", "tran_sub_type_id")
    rows = (ledger.filter(F.col("tran_type").isin(*types)).join(voided, "order_id")
            .withColumn("tran_type", F.col("tran_type") + 10)
            .withColumn("tran_sub_type", F.concat("tran_sub_type", F.lit(" Cancel")))
            .drop("tran_sub_type_id", "tran_date", "message_uuid", "sale_date", "tran_gl_date")
            .join(names, ["tran_type", "tran_sub_type"], "left"))
    return rows.withColumns({
        "tran_date": F.col("_at"), "message_uuid": F.col("_uuid"), "sale_date": F.col("_sale"),
        "tran_gl_date": local_date("_at"), "cancel_type": F.lit("void")}).drop("_at", "_uuid", "_sale", "tran_id")


def reverse_order_postings(ledger, work, sub_types):
    """Re-post 100, 105 and 400 of voided orders as type + 10; the new type carries the sign."""
    return _reverse(ledger, work, sub_types, REVERSED_ORDER_TYPES)


def reverse_membership_postings(ledger, work, sub_types, refunds):
    """The same on 150 and 155; a refund of the same amount gives the card authorisation."""
    rows = _reverse(ledger, work, sub_types, REVERSED_MEMBER_TYPES)
    matched = refunds.select("order_id", F.col("base_pay_amt").alias("tran_amt"), "gateway_tran_id")
    return (rows.join(matched, ["order_id", "tran_amt"], "left")
                .withColumn("cc_auth", F.coalesce("gateway_tran_id", "cc_auth")).drop("gateway_tran_id"))


def _set_status(headers, work, status: Column):
    news = work.select("order_id", status.alias("status"), F.col("updated_at").alias("status_date"), "updated_at")
    if "updated_at" not in headers.columns:
        headers = headers.withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    return R.update_from(headers, news, ["order_id"], ["status", "status_date", "updated_at"])


def cancel_order_status(headers, work):
    return _set_status(headers, work, F.when(F.col("is_voided"), "void").otherwise("cancel"))


def cancel_membership_status(headers, work):
    return _set_status(headers, work.filter("is_voided"), F.lit("cancel"))

