"""Credit memos and gift-card adjustments.

Credits are routed once; every refund family then posts from the routed credits in one
pass, the route choosing the code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions import relational as R
from tallyloom.functions.exprs import legacy_number, local_date, nz, whole
from tallyloom.schema import HIERARCHY, coded
from tallyloom.wire import CASH

LEGACY_PRE, LEGACY_POST, PRE, POST, MEMBER = "legacy_preship", "legacy_postship", "preship", "postship", "membership"
# Sale date given to orders older than the store tables, and the largest membership number.
LEGACY_SALE_DATE = "2021-01-01"
LAST_MEMBERSHIP_NUMBER = 99999999


def credit_worklists(credits, order_header, membership_header, control):
    """Credits with their route: before or after shipment (legacy or current orders), or membership.

    Orders numbered below the control value are legacy and need no header.
    """
    cut = control.filter(F.col("control_name") == "pre_ods_order_id").select("int_value").scalar()
    order = order_header.select("order_id", F.struct("sale_date", "customer_id", "increment_id").alias("_order"))
    member = membership_header.select("order_id", F.struct(
        F.col("sale_date"), F.col("customer_id"), F.col("increment_id").cast("string").alias("increment_id")).alias("_member"))
    rows = credits.withColumn("_legacy", F.col("order_id") < cut) \
        .join(order, "order_id", "left").join(member, "order_id", "left")
    before = (F.col("order_has_shipped") == "false") & (nz("base_total_product") > 0)
    after = (F.col("order_has_shipped") == "true") | (nz("base_total_product") == 0)
    stage = F.when(before, "preship").when(after, "postship")
    by_order = F.when(F.col("_legacy"), F.concat(F.lit("legacy_"), stage)).when(F.col("_order").isNotNull(), stage)
    by_member = F.when(~F.col("_legacy") & F.col("_member").isNotNull(), F.lit(MEMBER))
    rows = rows.withColumn("route", F.explode(F.array(by_order, by_member))).filter(F.col("route").isNotNull())
    owner = F.when(F.col("route") == MEMBER, F.col("_member")).otherwise(F.col("_order"))
    legacy = F.col("route").startswith("legacy")
    return rows.withColumns({
        "sale_date": F.when(legacy, F.lit(LEGACY_SALE_DATE).cast("date")).otherwise(owner["sale_date"]),
        "store_customer_id": F.when(legacy, F.col("customer_id")).otherwise(owner["customer_id"]),
        "store_increment_id": F.when(legacy, F.col("increment_id")).otherwise(owner["increment_id"]),
    }).drop("_legacy", "_order", "_member")


def _head() -> list[Column]:
    return [F.col("updated_at").alias("tran_date"), F.lit("order").alias("order_type"), "order_id",
            F.lit(1).alias("company_id"), F.col("credit_id").alias("credit_memo_id"), "sale_date",
            local_date("updated_at").alias("tran_gl_date")]


def post_preship_items(routed, items, order_detail, fc_xref, master):
    """365/82 per credited line of an unshipped order."""
    rows = routed.filter(F.col("route").isin(LEGACY_PRE, PRE)).select(
        "credit_id", "order_id", "increment_id", "customer_id", "updated_at", "sale_date", "route")
    line = items.select("credit_id", F.col("order_item_id").alias("order_line_id"), F.col("sku").alias("_sku"),
                        "qty_refunded", "base_price", "base_discount_amt", "base_tax_amt", "tax_amt", "discount_amt")
    detail = order_detail.select(F.col("item_id").alias("order_line_id"), F.col("sku"), "assignment_fc")
    fc = fc_xref.select(F.col("ns_fc_id").alias("assignment_fc"), "ods_fc_id")
    goods = master.select(F.col("item_name").alias("_sku"), F.col("fc_id").alias("_fc"),
                          F.struct("item_id", *HIERARCHY.values()).alias("item"))
    rows = (rows.join(line, "credit_id", "left").join(detail, "order_line_id", "left").join(fc, "assignment_fc", "left")
                .withColumn("_fc", F.coalesce("ods_fc_id", F.lit(2)).cast("bigint")).join(goods, ["_sku", "_fc"], "left"))
    gross = F.col("qty_refunded") * F.col("base_price")
    legacy = F.col("route") == LEGACY_PRE
    return rows.select(
        *coded("preship_product"), *_head(), "order_line_id", "increment_id", "customer_id",
        F.col("qty_refunded").alias("tran_qty"),
        (gross - nz("base_discount_amt") + nz("base_tax_amt")).alias("tran_amt"),
        F.when(legacy, gross).otherwise(gross - nz("discount_amt")).alias("tran_full_price"),
        nz("tax_amt").alias("tran_tax_amt"), F.when(legacy, nz("discount_amt")).alias("tran_discount_amt"),
        F.lit(0).alias("reason_id"), F.lit("Short Shipment").alias("refund_reason"),
        *[F.col(f"item.{t}").alias(n) for n, t in HIERARCHY.items()], "sku", F.col("item.item_id").alias("item_id"))


def _codes(order_pre, order_post, member) -> tuple[Column, Column]:
    """Type and sub type by route, number range and whether products were credited.

    ``order_pre`` and ``order_post`` are (pre-shipment, legacy pre-shipment) and
    (product, appeasement) codes; ``member`` the membership pair.
    """
    route = F.col("route")
    member_number = legacy_number("increment_id") <= LAST_MEMBERSHIP_NUMBER
    product = F.col("base_total_product") > 0

    def both(pick):
        post = F.when(product, pick(order_post[0])).otherwise(pick(order_post[1]))
        mem = F.when(product, pick(member[0])).otherwise(pick(member[1]))
        return (F.when(route == PRE, pick(order_pre[0]))
                 .when((route == LEGACY_PRE) & member_number, pick(member[0]))
                 .when(route == LEGACY_PRE, pick(order_pre[1]))
                 .when((route == LEGACY_POST) & member_number, mem)
                 .when(route == MEMBER, mem)
                 .otherwise(post))

    return both(lambda c: F.lit(c[0])), both(lambda c: F.lit(c[1]))


def _name(route_pre, kept, appeased) -> Column:
    return F.when(F.col("route").isin(*route_pre) | (F.col("base_total_product") > 0), kept).otherwise(appeased)


def post_refunds(routed, refunds, *routes):
    """Card refunds of all routes: 365/38, 360/81 or 78, 380/84 or 83."""
    rows = routed.filter(F.col("route").isin(*routes)) if routes else routed
    pay = refunds.filter(F.col("base_pay_amt") > 0).select("credit_id", "base_pay_amt", "gateway_tran_id", "cc_type")
    rows = rows.join(pay, "credit_id")
    kind, sub = _codes([(365, 38), (365, 38)], [(360, 81), (360, 78)], [(380, 84), (380, 83)])
    route = F.col("route")
    pre = route.isin(LEGACY_PRE, PRE)
    shared = (F.col("base_total_product") - F.col("base_total_gift_cards") + F.col("base_donations") + F.col("ppe_fee")
              + F.col("base_shipment") - nz("base_frozen_shipment") - nz("base_wine_shipment")
              + F.col("base_total_discount") + F.col("base_adjustment") - F.col(f"total_{CASH}"))
    legacy_taxes = F.col("base_shipment_tax") + nz("base_frozen_shipment_tax") + nz("base_wine_shipment_tax")
    paid, tax = F.col("base_pay_amt"), F.col("base_total_tax")
    full = (F.when(route == PRE, shared).when(route == LEGACY_PRE, shared - legacy_taxes)
             .when(route == LEGACY_POST, paid - tax).when(route == POST, paid - nz(tax))
             .otherwise(paid - nz(tax) - nz("base_total_gift_cards") + F.col("base_donations") + F.col("base_shipment")))
    own = route.isin(POST, MEMBER)
    return rows.select(
        "route", kind.alias("tran_type"), sub.alias("tran_sub_type_id"),
        _name((LEGACY_PRE, PRE), "Refund Capture", "Appeasement Capture").alias("tran_sub_type"), *_head(),
        F.when(own, F.col("store_customer_id")).otherwise(F.col("customer_id")).alias("customer_id"),
        F.when(own, F.col("store_increment_id")).otherwise(F.col("increment_id")).alias("increment_id"),
        paid.alias("tran_amt"), full.cast("decimal(14,4)").alias("tran_full_price"), tax.alias("tran_tax_amt"),
        F.col("gateway_tran_id").alias("cc_auth"), "cc_type",
        F.when(pre, F.lit("Short Shipment")).alias("refund_reason"))


def post_preship_refund(routed, refunds):
    return post_refunds(routed, refunds, LEGACY_PRE, PRE)


def post_postship_refund(routed, refunds):
    return post_refunds(routed, refunds, LEGACY_POST, POST)


def post_membership_refund(routed, refunds):
    return post_refunds(routed, refunds, MEMBER)


def _card_refunds(routed, gift_cards):
    paid = gift_cards.select("credit_id", F.col("gift_card_id").try_cast("bigint").alias("gift_card_id"), "gift_card_amt")
    return routed.join(paid.filter((F.col("gift_card_id") > 0) & (F.col("gift_card_amt") > 0)), "credit_id")


def post_refund_gift_cards(routed, gift_cards, adjustments, *routes):
    """Refunds onto gift cards, with the reasons of the card's 'Created' adjustment."""
    rows = routed.filter(F.col("route").isin(*routes)) if routes else routed
    created = adjustments.filter(F.col("action_label") == "Created").select(
        F.col("card_id").alias("gift_card_id"), F.col("reason_id").alias("gc_reason_id"),
        F.col("reason_label").alias("gc_reason_name"), F.col("group_label").alias("gc_group_name"),
        F.col("group_code").alias("gc_group_code"))
    rows = _card_refunds(rows, gift_cards).join(created, "gift_card_id", "left")
    kind, sub = _codes([(365, 36), (360, 79)], [(360, 79), (360, 80)], [(380, 23), (380, 92)])
    route = F.col("route")
    legacy = route.startswith("legacy")
    amount, tax = F.col("gift_card_amt"), F.col("base_total_tax")
    return rows.select(
        "route", kind.alias("tran_type"), sub.alias("tran_sub_type_id"),
        _name((LEGACY_PRE, PRE), "Gift Card", "Gift Card Appeasement").alias("tran_sub_type"), *_head(),
        "store_customer_id", "store_increment_id", amount.alias("tran_amt"), tax.alias("tran_tax_amt"),
        F.when(legacy, amount - tax).otherwise(amount - nz(tax)).alias("tran_full_price"), "gift_card_id",
        "gc_reason_id", "gc_reason_name", "gc_group_name", "gc_group_code", F.lit("refund").alias("gc_sub_type")
    ).withColumnsRenamed({"store_customer_id": "customer_id", "store_increment_id": "increment_id"})


def post_preship_gift_card(routed, gift_cards, adjustments):
    return post_refund_gift_cards(routed, gift_cards, adjustments, LEGACY_PRE, PRE)


def post_postship_gift_card(routed, gift_cards, adjustments):
    return post_refund_gift_cards(routed, gift_cards, adjustments, LEGACY_POST, POST)


def post_membership_refund_gift_card(routed, gift_cards, adjustments):
    return post_refund_gift_cards(routed, gift_cards, adjustments, MEMBER)


def new_refund_gift_cards(routed, gift_cards, cards):
    """Refund cards that the card table does not list (``NOT IN``): type 2 for memberships, else 1."""
    rows = _card_refunds(routed.filter(F.col("route") != LEGACY_PRE).filter(F.col("route") != PRE), gift_cards)
    rows = R.not_in(rows, "gift_card_id", cards.select("card_id"))
    return rows.select(
        F.col("gift_card_id").alias("card_id"), F.when(F.col("route") == MEMBER, 2).otherwise(1).alias("card_type"),
        F.col("gift_card_amt").alias("initial_amount"), F.col("gift_card_amt").alias("current_balance"),
        F.lit("refund").alias("issue_type"), "order_id", F.col("increment_id").alias("order_increment_id"),
        F.col("updated_at").alias("created_at"), F.col("message_uuid").alias("source_uuid"))


def load_credit_memo_tables(routed, credits, items, refunds, gift_cards):
    """The four store tables: staging rows of the credits that were posted."""
    done = routed.select("credit_id").distinct()
    tables = {"credit_memo": credits, "credit_memo_items": items, "credit_memo_refunds": refunds,
              "credit_memo_gift_cards": gift_cards}
    return {name: rows.join(done, "credit_id", "left_semi") for name, rows in tables.items()}


def archive_credit_memos(routed, credits, items, refunds, gift_cards):
    """Per staging table: (rows of posted credits, which move to the archive; rows that stay for a later run)."""
    done = routed.select("credit_id").distinct()
    tables = {"credit_memo": credits, "credit_memo_items": items, "credit_memo_refunds": refunds, "credit_memo_gift_cards": gift_cards}
    return {name: R.split(rows, done, "credit_id") for name, rows in tables.items()}


# --------------------------------------------------------------------------- gift-card adjustments

def post_membership_redemption(adjustments):
    """500/94: the amount taken off a card when a membership starts."""
    rows = adjustments.filter((whole(F.col("action").try_cast("decimal(10,2)")) == 2)
                              & F.col("subscription_start_date").isNotNull())
    return rows.select(
        *coded("membership_redemption"), F.col("updated_at").alias("tran_date"), "customer_id",
        F.lit(1).alias("company_id"), (-F.col("card_delta")).alias("tran_amt"), F.col("card_id").alias("gift_card_id"),
        F.col("reason_id").alias("gc_reason_id"), F.col("reason_label").alias("gc_reason_name"),
        F.col("group_label").alias("gc_group_name"), F.col("group_code").alias("gc_group_code"),
        F.lit("membership").alias("gc_sub_type"), local_date("updated_at").alias("tran_gl_date"),
        F.col("subscription_start_date").alias("start_date"), F.col("subscription_end_date").alias("end_date"))


WINDOW_SECONDS = 30
SPREAD = 4096  # values that rows without a join key are spread over


def _seconds(ts) -> Column:
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def redeeming_orders(adjustments, spent):
    """Adjustments matched to the order that spent the card: same card and amount (to the cent), the
    adjustment falling in the 30 seconds from the order on.

    Time is cut into 30-second steps; an order reaches into two of them, so the range
    becomes an equality on (card, amount, step) and a card used all the time meets only
    the orders of its own half minute.
    """
    step = F.floor(_seconds("_opened") / WINDOW_SECONDS)
    orders = spent.select(
        F.col("gift_card_id").alias("card_id"), F.round(F.col("pay_amt").cast("decimal(14,4)"), 2).alias("_amount"),
        F.col("created_at").alias("_opened"), F.col("increment_id").alias("redeeming_increment_id"),
        F.col("customer_id").alias("redeeming_cust_id"))
    orders = orders.withColumn("_step", F.explode(F.array(step, step + 1)))
    rows = adjustments.withColumn("_amount", F.round(F.col("card_delta").cast("decimal(14,4)"), 2)) \
        .withColumn("_step", F.floor(_seconds("updated_at") / WINDOW_SECONDS))
    lag = _seconds("updated_at") - _seconds("_opened")
    orders = orders.withColumnsRenamed({"card_id": "_card", "_amount": "_paid", "_step": "_at"})
    return rows.join(orders, (F.col("card_id") == F.col("_card")) & (F.col("_amount") == F.col("_paid"))
                     & (F.col("_step") == F.col("_at")) & lag.between(0, WINDOW_SECONDS), "left") \
        .drop("_card", "_paid", "_at", "_amount", "_step", "_opened")


def gift_card_adjustment_enrich(adjustments, card_types, sold, credited, order_header, spent):
    """Adjustment history row: issue type, purchaser, first credit memo, redeeming order.

    ``expire_at`` stays only if more than 20 days out.
    """
    types = card_types.select(F.col("group_code").alias("_group"), "issue_type")
    bought = sold.select("card_id", F.col("card_type").alias("_sold_type"), F.col("increment_id").alias("purchasing_increment_id"))
    memo = credited.groupBy(F.col("gift_card_id").alias("card_id")).agg(
        F.min("credit_id").alias("credit_id"), F.min("credit_increment_id").alias("cm_increment_id"),
        F.min("increment_id").alias("increment_id"))
    # most rows have no order to come from; a second key, zero on the other side, spreads them over the tasks
    buyer = order_header.select(F.col("increment_id").alias("_from"), "billing_state", "customer_id").withColumn("_spread", F.pmod(F.xxhash64("_from"), F.lit(1)))
    spread = F.when(F.col("_from").isNull(), F.pmod(F.xxhash64("card_id", "updated_at", "card_delta"), F.lit(SPREAD))).otherwise(0)
    rows = redeeming_orders(adjustments.drop("customer_id"), spent)
    rows = (rows.withColumn("_group", F.coalesce("group_code", F.lit(""))).join(types, "_group", "left")
                .join(bought, "card_id", "left").join(memo, "card_id", "left")
                .withColumn("_from", F.coalesce("purchasing_increment_id", "increment_id"))
                .withColumn("_spread", spread).join(buyer, ["_from", "_spread"], "left"))
    far = F.date_add(F.to_date("updated_at"), 20) < F.to_date("expire_at")
    return rows.select(
        "card_id", "billing_state", "credit_id", "cm_increment_id", "increment_id", "updated_at",
        F.when(far, F.col("expire_at")).alias("expire_at"), "action", "action_label", "redeeming_increment_id",
        "redeeming_cust_id", "purchasing_increment_id", "customer_id", "issue_type", "group_code", "group_label",
        "reason_id", "reason_label", "card_delta", "card_amt",
        F.when(F.col("credit_id").isNotNull(), 1).otherwise(F.col("_sold_type")).alias("card_type"))
