"""Fulfillment: choose orders, stage lines, allocate bundles to the cent, post revenue."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions import relational as R
from tallyloom.functions.exprs import local_date, nz
from tallyloom.schema import HIERARCHY, coded
from tallyloom.wire import CASH_DISCOUNT


def first_of_list(text) -> Column:
    """First number of a JSON list held as text."""
    return F.get_json_object(text, "$[0]").try_cast("bigint")


# --------------------------------------------------------------------------- work selection and staging

def fulfillment_worklist(headers, details, order_header, order_detail, credits, as_of, cutoff="2021-09-26"):
    """Orders ready to post: every line known (sold on or after ``cutoff``) and either the last
    shipment came, a shipment is over a week old, or revenue was recognised before."""
    known = order_detail.filter(F.col("sale_date") >= F.lit(cutoff).cast("date")).select(
        "item_id", F.lit(0).alias("_unknown"))
    keys = ["order_id", "message_uuid"]
    lines = (details.join(known, "item_id", "left").groupBy(*keys)
                    .agg(F.sum(F.coalesce("_unknown", F.lit(1))).alias("_unknown")))
    credit = credits.select("credit_id")
    rows = (headers.withColumn("credit_id", first_of_list("credit_memo_id"))
                   .join(lines, keys, "left")
                   .join(credit.withColumn("_credit", F.col("credit_id")), "credit_id", "left")
                   .join(order_header.select("order_id", "sale_date", "gaap_sale_date"), "order_id", "left"))
    stale = F.to_date("updated_at") < F.date_sub(F.lit(as_of).cast("date"), 7)
    due = F.coalesce(F.col("is_last_shipment"), F.lit(False)) | stale
    grouped = rows.groupBy("order_id").agg(
        F.max("_credit").alias("credit_id"), F.max("updated_at").alias("tran_date"), F.max("sale_date").alias("sale_date"),
        F.sum(F.coalesce("_unknown", F.lit(1))).alias("_unknown"), F.max(due).alias("_due"),
        F.max("gaap_sale_date").alias("_gaap"))
    return grouped.filter((F.col("_unknown") == 0) & (F.col("_due") | F.col("_gaap").isNotNull())).select(
        "order_id", "credit_id", "tran_date", "sale_date")


def stage_fulfillment(headers, work, details, order_header, order_detail, discounts, credit_items, fc_xref):
    """One staged row per shipped line, with the order, price, credit and warehouse it needs."""
    shipment = headers.join(work.drop("sale_date"), "order_id").select(
        "order_id", "message_uuid", F.col("updated_at").alias("fulfilled_at"), "is_last_shipment",
        first_of_list("credit_memo_id").alias("_cm"), "credit_id", "tran_date")
    order = order_header.select("order_id", "increment_id", "customer_id", "sale_date")
    line = order_detail.select(
        "item_id", "qty_ordered", "base_price", "base_tax_amt", "base_row_total",
        F.when(~F.coalesce(F.col("is_gwp").try_cast("boolean"), F.lit(False)), F.col("base_discount_amt")).otherwise(0).cast("decimal(12,4)")
        .alias("base_discount_amt"))
    tpa = (discounts.filter((F.col("discount_type") == "tpa") & (F.col("discount_amt") > 0))
                    .groupBy("item_id").agg(F.sum("discount_amt").alias("tpa_unit_amt")))
    credit = credit_items.select(
        "credit_id", F.col("order_item_id").alias("item_id"), "qty_refunded", F.col("base_price").alias("credit_price"),
        F.col("base_tax_amt").alias("credit_tax_amt"), F.col("base_discount_amt").alias("credit_discount_amt"),
        (F.col("base_row_total_incl_tax") - F.col("base_discount_amt")).alias("credit_total_amt"))
    fc = fc_xref.select(F.col("fc_id").alias("store_fc"), F.col("ns_fc_id").alias("fc"))
    # the lines of a message repeat its order keys; the order's own are the ones to stage
    shipped = details.select("order_id", "message_uuid", "item_id", "parent_item_id", "product_type", "sku", "fc", "units_shipped",
                             "units_shorted", *_known(details, "shipment_id", "tracking_id"))
    rows = (shipped.join(shipment, ["order_id", "message_uuid"]).join(order, "order_id").join(line, "item_id")
                   .join(tpa, "item_id", "left").join(credit, ["credit_id", "item_id"], "left")
                   .withColumn("store_fc", first_of_list("fc")).drop("fc").join(fc, "store_fc", "left"))
    return rows.select(
        "order_id", "increment_id", "customer_id", "message_uuid", "fulfilled_at", "item_id", "parent_item_id",
        "product_type", "fc", "store_fc", "sku", "units_shipped", "qty_ordered", "units_shorted", "base_price",
        "base_discount_amt", "base_tax_amt", "base_row_total", "is_last_shipment",
        F.when(F.col("qty_refunded") > 0, F.col("_cm")).alias("cm_id"), "qty_refunded", "credit_price",
        "credit_tax_amt", "credit_discount_amt", "credit_total_amt", "tpa_unit_amt", "tran_date", "sale_date", "shipment_id", "tracking_id")


def _known(rows, *columns):
    """The columns, NULL where the rows come without them."""
    return [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns]


def retail_price_fallback(stage, fc_xref, items):
    """Retail at the line's warehouse, else at fc 2, else 1.3 times unit cost."""
    fc = fc_xref.select(F.col("fc_id").alias("store_fc"), "ods_fc_id")
    here = items.select(F.col("item_name").alias("sku"), F.col("fc_id").alias("_fc"),
                        F.struct("retail_price", "net_unit_cost").alias("_here"))
    base = items.filter("fc_id = 2").select(F.col("item_name").alias("sku"),
                                            F.struct("retail_price", "net_unit_cost").alias("_base"))
    rows = (stage.join(fc, "store_fc", "left").withColumn("_fc", F.coalesce("ods_fc_id", F.lit(2)).cast("bigint"))
                 .join(here, ["sku", "_fc"], "left").join(base, "sku", "left"))

    def best(c):
        return F.coalesce(f"_here.{c}", f"_base.{c}", F.lit(0))

    price = F.when(best("retail_price") > 0, best("retail_price")).otherwise(best("net_unit_cost") * F.lit(1.3).cast("decimal(2,1)"))
    columns = [c for c in stage.columns if c != "retail_price"]
    return rows.select(*columns, price.cast("decimal(12,4)").alias("retail_price"))


# --------------------------------------------------------------------------- bundle allocation

MEASURES = {"revenue": "bundle_total_amt", "tax": "bundle_tax_amt", "discount": "bundle_discount_amt"}


def _components(stage):
    """Bundle components with their bundle's amounts and their share of its retail value."""
    parents = stage.filter((F.col("base_price") > 0) & (F.col("units_shipped") > 0)).select(
        F.col("item_id").alias("parent_item_id"),
        (F.col("units_shipped") * (F.col("base_price") + F.col("base_discount_amt"))).cast("decimal(14,4)").alias("bundle_total_amt"),
        F.col("base_tax_amt").alias("bundle_tax_amt"), F.col("base_discount_amt").alias("bundle_discount_amt"))
    children = stage.filter(F.col("parent_item_id").isNotNull()).select(
        "item_id", "parent_item_id", "order_id", "sku", "fc",
        (F.col("units_shipped") * F.col("retail_price")).cast("decimal(14,4)").alias("_weight"))
    weights = children.groupBy("parent_item_id").agg(F.sum("_weight").cast("decimal(20,4)").alias("_all"))
    share = F.when(F.col("_all") != 0, F.round(F.col("_weight") / F.col("_all"), 10)).otherwise(0).cast("decimal(12,10)")
    return (children.join(parents.join(weights, "parent_item_id"), "parent_item_id")
                    .withColumn("_share", share).drop("_weight", "_all"))


def _portion(amount) -> Column:
    return F.round(F.col(amount) * F.col("_share"), 2).cast("decimal(12,2)")


def allocate_bundle(stage):
    """Split each bundle's total, tax and discount over its components by retail value shipped."""
    return _components(stage).select(
        "item_id", "parent_item_id", "order_id", "sku", "fc", *MEASURES.values(),
        *[_portion(a).alias(f"alloc_{m}_amt") for m, a in MEASURES.items()])


def bundle_out_of_balance(allocated):
    """Cents by which the allocation misses the bundle, per measure."""
    sums = allocated.groupBy("parent_item_id").agg(
        *[F.max(a).alias(a) for a in MEASURES.values()],
        *[F.sum(nz(f"alloc_{m}_amt")).alias(f"{m}_amt") for m in MEASURES])
    return sums.withColumns({
        f"adj_{m}": F.round((nz(a) - F.col(f"{m}_amt")) * 100, 0).cast("bigint") for m, a in MEASURES.items()})


def penny_fix(allocated, *measures):
    """Per component and measure the cent it must move, one row each."""
    rows = allocated.select("parent_item_id", "item_id", F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(f"alloc_{m}_amt").alias("amount"),
                 F.col(MEASURES[m]).cast("decimal(14,4)").alias("target")) for m in measures or MEASURES])).alias("m"))
    rows = rows.select("parent_item_id", "item_id", "m.*")
    return R.penny_rank(rows, ["parent_item_id", "measure"], "item_id", "amount", "target")


def _fixed(allocated, *measures):
    """Allocation after the penny fix of some measures."""
    moves = penny_fix(allocated, *measures).groupBy("item_id").agg(*[
        F.sum(F.when(F.col("measure") == m, F.col("cent"))).alias(f"_{m}") for m in measures or MEASURES])
    out = allocated.join(moves, "item_id", "left")
    return out.withColumns({
        f"alloc_{m}_amt": (F.col(f"alloc_{m}_amt") + nz(f"_{m}")).cast("decimal(12,2)") for m in measures or MEASURES
    }).select(*allocated.columns)


def penny_fix_revenue(allocated):
    return _fixed(allocated, "revenue")


def penny_fix_tax(allocated):
    return _fixed(allocated, "tax")


def penny_fix_discount(allocated):
    return _fixed(allocated, "discount")


def balance(allocated):
    """All three measures balanced in one ranking."""
    return _fixed(allocated)


def balanced_bundle(stage):
    return balance(allocate_bundle(stage))


def apply_allocation(stage, allocated):
    """Stage rows with the allocated amounts of their components."""
    news = allocated.select("item_id", F.col("alloc_revenue_amt").alias("allocated_price"),
                            F.col("alloc_discount_amt").alias("allocated_discount_amt"),
                            F.col("alloc_tax_amt").alias("allocated_tax_amt"))
    return stage.join(news, "item_id", "left")


def allocate_bundle_discounts(stage, discounts):
    """The same split for every discount row of a bundle."""
    bundles = stage.filter(F.col("product_type") == "bundle").select("item_id")
    dsc = discounts.join(bundles, "item_id", "left_semi").select(
        F.col("item_id").alias("parent_item_id"), "discount_id", F.col("base_amt_off_applied").alias("dsc_amt"),
        "rule_id", "rule_name", "rule_group", "discount_type")
    parts = _components(stage).select("item_id", "parent_item_id", "order_id", "sku", "fc", "_share")
    return parts.join(dsc, "parent_item_id").withColumn("alloc_discount_amt", _portion("dsc_amt")).drop("_share")


def discount_out_of_balance(allocated):
    sums = allocated.groupBy("parent_item_id", "discount_id").agg(
        F.max("dsc_amt").alias("dsc_amt"), F.sum(nz("alloc_discount_amt")).alias("dtl_amt"))
    return sums.withColumn("adj_discount", F.round((nz("dsc_amt") - F.col("dtl_amt")) * 100, 0).cast("bigint"))


def penny_fix_rule_discount(allocated):
    moves = R.penny_rank(allocated, ["parent_item_id", "discount_id"], "item_id", "alloc_discount_amt", "dsc_amt")
    out = allocated.join(moves.select("item_id", "discount_id", "cent"), ["item_id", "discount_id"], "left")
    return out.withColumn("alloc_discount_amt", (F.col("alloc_discount_amt") + nz("cent")).cast("decimal(12,2)")) \
              .select(*allocated.columns)


def bundle_discount_result(stage, discounts):
    return penny_fix_rule_discount(allocate_bundle_discounts(stage, discounts)).select(
        "order_id", "item_id", "discount_id", "parent_item_id", "alloc_discount_amt", "rule_id", "rule_name",
        "rule_group", "discount_type")


# --------------------------------------------------------------------------- postings

def with_item(rows, fc_xref, items, *extra):
    """Item master of the line's sku at its warehouse (an unmapped warehouse counts as fc 2)."""
    fc = fc_xref.select(F.col("ns_fc_id").alias("fc"), "ods_fc_id")
    master = items.select(F.col("item_name").alias("sku"), F.col("fc_id").alias("_fc"), F.struct(
        "item_id", "net_unit_cost", "brand_id", *HIERARCHY.values(), *extra).alias("item"))
    return (rows.join(fc, "fc", "left").withColumn("_fc", F.coalesce("ods_fc_id", F.lit(2)).cast("bigint"))
                .join(master, ["sku", "_fc"], "left").drop("_fc", "ods_fc_id"))


def _line(code=None) -> list[Column]:
    head = coded(code) if code else []
    return [*head, "tran_date", F.lit("order").alias("order_type"), "order_id", "increment_id",
            F.col("item_id").alias("order_line_id"), "customer_id", F.lit(1).alias("company_id"),
            F.col("fc").alias("location_id"), F.col("store_fc").alias("magento_location_id"), "sku", "parent_item_id",
            *[F.col(f"item.{t}").alias(n) for n, t in HIERARCHY.items()], F.col("units_shipped").alias("tran_qty"),
            "sale_date", F.col("item.item_id").alias("item_id"), local_date("tran_date").alias("tran_gl_date"),
            local_date("fulfilled_at").alias("ship_date")]


def _shipped(stage):
    return stage.filter((F.col("units_shipped") > 0) & (F.col("product_type") != "bundle"))


def post_product_revenue(stage, fc_xref, items):
    """300/16: allocated price of components, else ordered value less refunds; short units lose their TPA."""
    own = (F.col("qty_ordered") * (F.col("base_price") + nz("base_discount_amt"))
           - nz("qty_refunded") * nz("credit_price"))
    amount = F.round(F.coalesce("allocated_price", own)
                     - (F.col("qty_ordered") - F.col("units_shipped")) * nz("tpa_unit_amt"), 2)
    rows = with_item(_shipped(stage), fc_xref, items)
    return rows.select(*_line("product"), amount.cast("decimal(14,2)").alias("tran_amt"),
                       (F.col("qty_ordered") * F.col("item.net_unit_cost")).alias("tran_cost_amt"))


# Ledger code of each line discount type.
LINE_DISCOUNTS = {"coupon": "coupon", "tpa": "tpa", "tiered_pricing": "tiered_pricing"}


def post_line_discounts(stage, discounts, fc_xref, items, *types):
    """Coupon (69), TPA (48) and tiered pricing (98) of single lines, in one join.

    A coupon posts whole.  The other two post whole when all discounted units shipped, else
    per unit, and only on priced lines.
    """
    types = types or tuple(LINE_DISCOUNTS)
    kind = F.col("discount_type")
    odd = discounts.filter(kind.isin(*types)).select(
        "item_id", "discount_type", "rule_id", "rule_name", "rule_group", "discount_amt", "units_applied", "amt_off_applied")
    rows = _shipped(stage).join(odd, "item_id").filter((kind == "coupon") | (F.col("base_price") > 0))
    per_unit = F.round(F.col("units_shipped") * F.col("discount_amt"), 2)
    amount = F.when((kind == "coupon") | (F.col("units_shipped") == F.col("units_applied")), F.col("amt_off_applied")) \
              .otherwise(per_unit)
    return _discount_rows(with_item(rows, fc_xref, items), amount)


def post_bundle_discounts(stage, bundle_discounts, fc_xref, items, *types):
    """The same for bundle components, from the allocated discounts (coupon and TPA)."""
    types = types or ("coupon", "tpa")
    sbad = bundle_discounts.filter(F.col("discount_type").isin(*types)).select(
        "item_id", "discount_type", "rule_id", "rule_name", "rule_group", "alloc_discount_amt")
    rows = with_item(_shipped(stage).join(sbad, "item_id"), fc_xref, items)
    return _discount_rows(rows, F.col("alloc_discount_amt"))


def _discount_rows(rows, amount):
    kind = F.col("discount_type")
    codes = F.create_map(*[x for t, c in LINE_DISCOUNTS.items() for x in (F.lit(t), F.struct(*coded(c)))])
    coupon = kind == "coupon"
    return rows.withColumn("_code", codes[kind]).select(
        "_code.*", *_line(), amount.cast("decimal(14,4)").alias("tran_amt"), "rule_id",
        F.when(~coupon, F.col("rule_name")).alias("rule_name"),
        F.when(coupon, F.col("rule_name")).alias("coupon_rule_name"),
        F.when(coupon, F.col("rule_group")).alias("coupon_group_code"))


def _last_shipments(stage, *columns):
    return stage.filter("is_last_shipment").select("order_id", "tran_date", "sale_date", *columns).distinct()


def post_make_good(payments, stage, card_history, cards, cutoff="2021-09-30"):
    """300/64 for make-good gift cards spent on an order, at its last shipment.

    Reasons come from the card's adjustments (largest value per card and issue type), else the card.
    """
    last = _last_shipments(stage, "increment_id")
    reasons = card_history.filter(F.col("issue_type") == "Make-Good").groupBy("card_id").agg(
        F.max("group_code").alias("_gc"), F.max("group_label").alias("_gn"),
        F.max("reason_id").alias("_ri"), F.max("reason_label").alias("_rn"))
    own = cards.select("card_id", "reason_id", "reason", "group_code", "group_name")
    spent = (payments.filter((F.col("payment_type") == "gc") & (F.col("sale_date") >= F.lit(cutoff).cast("date")))
                     .select("order_id", "pay_amt", F.col("gift_card_id").try_cast("bigint").alias("card_id")))
    rows = spent.join(last, "order_id").join(reasons, "card_id").join(own, "card_id", "left")
    return rows.select(
        *coded("make_good"), "tran_date", F.lit(1).alias("company_id"), F.col("pay_amt").alias("tran_amt"),
        F.col("card_id").alias("gift_card_id"), F.lit(99).alias("gc_type"), F.lit("Make-Good").alias("gc_sub_type"),
        "order_id", F.lit("order").alias("order_type"), "increment_id", F.coalesce("_ri", "reason_id").alias("gc_reason_id"),
        F.coalesce("_rn", "reason").alias("gc_reason_name"), F.coalesce("_gc", "group_code").alias("gc_group_code"),
        F.coalesce("_gn", "group_name").alias("gc_group_name"), "sale_date", local_date("tran_date").alias("tran_gl_date"))


SHIPMENTS = {"grocery_shipment": "grocery_base_shipment", "frozen_shipment": "frozen_base_shipment",
             "wine_shipment": "wine_base_shipment", "fee_revenue": "ppe_fee"}


def post_shipment_revenue(order_header, stage):
    """300/17, 70, 71 and 96 once the last shipment is out: one scan, header amounts spread, positive ones kept."""
    entries = [F.struct(*coded(c), F.col(a).cast("decimal(14,4)").alias("tran_amt")) for c, a in SHIPMENTS.items()]
    charges = (order_header.select("order_id", "increment_id", "customer_id", F.explode(F.array(*entries)).alias("_p"))
                           .filter(F.col("_p.tran_amt") > 0))
    return charges.join(_last_shipments(stage), "order_id").select(
        "_p.*", "tran_date", F.lit("order").alias("order_type"), "order_id", "increment_id", "customer_id",
        F.lit(1).alias("company_id"), "sale_date", local_date("tran_date").alias("tran_gl_date"))


def post_cash_discount(stage, payments):
    spent = payments.filter((F.col("payment_type") == "tc") & (F.col("pay_amt") > 0)).select("order_id", "pay_amt")
    return _last_shipments(stage, "customer_id", "increment_id").join(spent, "order_id").select(
        F.lit(300).alias("tran_type"), F.lit(62).alias("tran_sub_type_id"), F.lit(CASH_DISCOUNT).alias("tran_sub_type"),
        "tran_date", F.lit("order").alias("order_type"), "order_id", "increment_id", "customer_id",
        F.lit(1).alias("company_id"), F.col("pay_amt").alias("tran_amt"), "sale_date",
        local_date("tran_date").alias("tran_gl_date"))


# --------------------------------------------------------------------------- status updates, gift cards sold

def stamped(rows, column):
    """``rows`` with the time column that updates set; a table that lacks it gets it empty."""
    return rows if column in rows.columns else rows.withColumn(column, F.lit(None).cast("timestamp_ntz"))


def update_detail_fulfillment(order_detail, stage, as_of):
    """Shipped and short units and the load time of the staged lines; other lines stay as they are."""
    news = stage.select("item_id", F.col("units_shipped").alias("fulfillment_qty"),
                        F.col("units_shorted").alias("short_qty"), F.col("fulfilled_at").alias("fulfillment_date"),
                        F.lit(as_of).cast("timestamp_ntz").alias("ods_updated_at"))
    return R.update_from(stamped(order_detail, "ods_updated_at"), news, ["item_id"], ["fulfillment_qty", "short_qty", "fulfillment_date", "ods_updated_at"])


def update_header_shipped(order_header, stage, as_of):
    """Status and revenue date from the latest fulfilment; headers that have a revenue date stay."""
    done = (stage.filter("is_last_shipment").groupBy("order_id").agg(F.max("fulfilled_at").alias("_at")))
    order_header = stamped(order_header, "updated_at")
    rows = order_header.join(done, "order_id", "left")
    hit = F.col("_at").isNotNull() & F.col("gaap_sale_date").isNull()
    return rows.withColumns({
        "status": F.when(hit, F.lit("shipped")).otherwise(F.col("status")),
        "status_date": F.when(hit, F.col("_at")).otherwise(F.col("status_date")),
        "gaap_sale_date": F.when(hit, local_date("_at")).otherwise(F.col("gaap_sale_date")),
        "updated_at": F.when(hit, F.lit(as_of).cast("timestamp_ntz")).otherwise(F.col("updated_at"))}).select(*order_header.columns)


def _sold(sales, order_detail):
    return sales.join(order_detail.select("item_id"), "item_id", "left_semi")


def post_gift_card_sale(sales, adjustments, order_detail, order_header):
    """310/30 for type 1, else 320/32; only cards with a 'Created' adjustment."""
    created = adjustments.filter(F.col("action_label") == "Created").select("card_id")
    line = order_detail.select("item_id", F.col("order_id").alias("_order"), "base_price", "base_original_price", "base_discount_amt")
    head = order_header.select(F.col("order_id").alias("_order"), F.col("increment_id").alias("_inc"), "sale_date")
    rows = sales.join(created, "card_id").join(line, "item_id").join(head, "_order")
    first = F.col("card_type") == 1
    return rows.select(
        F.when(first, 310).otherwise(320).alias("tran_type"), F.when(first, 30).otherwise(32).alias("tran_sub_type_id"),
        F.lit("Purchased").alias("tran_sub_type"), F.col("updated_at").alias("tran_date"), F.lit(1).alias("company_id"),
        F.col("base_price").alias("tran_amt"), F.col("base_original_price").alias("tran_full_price"),
        F.col("base_discount_amt").alias("tran_discount_amt"), F.col("card_id").alias("gift_card_id"),
        F.col("card_type").alias("gc_type"), F.lit("Purchased").alias("gc_sub_type"), F.col("_order").alias("order_id"),
        F.col("item_id").alias("order_line_id"), F.lit("order").alias("order_type"), F.col("_inc").alias("increment_id"),
        F.lit("Purchased").alias("gc_reason_name"), F.lit("Purchased").alias("gc_group_name"), "sale_date",
        local_date("updated_at").alias("tran_gl_date"))


def gift_card_fulfillment_updates(sales, order_detail, order_header, as_of):
    """(lines with quantity 1, headers touched, new gift cards); other lines and headers keep their times."""
    now = F.lit(as_of).cast("timestamp_ntz")
    sold = _sold(sales, order_detail)
    items = sold.select("item_id").distinct().withColumn("_hit", F.lit(True))
    orders = sold.select("order_id").distinct().withColumn("_hit", F.lit(True))
    detail = stamped(order_detail, "ods_updated_at").join(items, "item_id", "left").withColumns({
        "fulfillment_qty": F.when(F.col("_hit"), F.lit(1)).otherwise(F.col("fulfillment_qty")),
        "ods_updated_at": F.when(F.col("_hit"), now).otherwise(F.col("ods_updated_at"))}).drop("_hit")
    header = stamped(order_header, "updated_at").join(orders, "order_id", "left").withColumn(
        "updated_at", F.when(F.col("_hit"), now).otherwise(F.col("updated_at"))).drop("_hit")
    cards = sold.select("card_id", "card_type", F.col("card_amt").alias("initial_amount"),
                        F.col("card_amt").alias("current_balance"), F.lit("purchased").alias("issue_type"), "order_id",
                        F.col("increment_id").alias("order_increment_id"), "item_id", F.col("updated_at").alias("created_at"),
                        now.alias("updated_at"), F.col("message_uuid").alias("source_uuid"))
    return detail, header, cards

