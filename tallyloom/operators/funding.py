"""Vendor funding: ERP extracts, rebate waterfall, funding postings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.exprs import local_time
from tallyloom.operators.fulfillment import _line, _shipped, with_item
from tallyloom.schema import CODES, HIERARCHY, coded

ACTIVE, INACTIVE, INACTIVE_AT_SHIPMENT = 1, 2, 8
TERMS = ["start_date", "end_date", "percentage", "dollar_amount", "billing_period", "brand_sku", "billing_method_id"]


# --------------------------------------------------------------------------- ERP extracts

def _named(table, key, value, key_as, value_as):
    return table.select(F.col(key).alias(key_as), F.col(value).alias(value_as))


def _with_emails(rows, brand, erp):
    """Contact, customer and vendor addresses of a brand, joined by id and by brand name."""
    newest = erp["contact_map"].groupBy(F.col("brand_records_id").alias(brand)).agg(F.max("contact_id").alias("contact_id"))
    return (rows.join(erp["vendor_map"].select(F.col("brand_records_id").alias(brand), "vendor_id"), brand, "left")
                .join(newest, brand, "left")
                .join(_named(erp["contacts"], "contact_id", "email", "contact_id", "_contact"), "contact_id", "left")
                .join(_named(erp["customers"], "customer_id", "email", "billing_customer_id", "_customer"), "billing_customer_id", "left")
                .join(_named(erp["vendors"], "vendor_id", "email", "vendor_id", "_vendor"), "vendor_id", "left"))


def _by_name(rows, erp):
    return (rows.join(_named(erp["customers"], "name", "email", "brand_records_name", "_customer2"), "brand_records_name", "left")
                .join(_named(erp["vendors"], "name", "email", "brand_records_name", "_vendor2"), "brand_records_name", "left"))


def rebate_agreement_extract(agreements, erp):
    """Agreements of type 1 with list names, brand billing and the first known address of five."""
    base = agreements.filter(F.col("type_id") == 1).select(
        "rebate_agreement_id", "active_status_id", "billing_period_id", "brand_id", "start_date", "end_date",
        "dollar_amount", "percentage", "item_id", "type_id")
    brands = erp["brand_records"].select(F.col("brand_records_id").alias("brand_id"), "brand_records_name",
                                         "billing_method_id", "billing_customer_id")
    rows = (base.join(_named(erp["period_list"], "list_id", "list_item_name", "billing_period_id", "billing_period"), "billing_period_id", "left")
                .join(_named(erp["status_list"], "list_id", "list_item_name", "active_status_id", "active_status"), "active_status_id", "left")
                .join(_named(erp["rebate_types"], "list_id", "list_item_name", "type_id", "rebate_type"), "type_id", "left")
                .join(brands, "brand_id", "left"))
    rows = _by_name(_with_emails(rows, "brand_id", erp), erp)
    return rows.select(
        *base.columns, "billing_period", "active_status", "rebate_type", "brand_records_name", "billing_method_id",
        "billing_customer_id", "vendor_id",
        F.when(F.col("item_id").isNull(), "By Brand").otherwise("By SKU").alias("brand_sku"),
        F.coalesce("_contact", "_customer", "_vendor", "_customer2", "_vendor2").alias("brandemail"))


def brand_extract(erp):
    """Brands with billing method name, vendor and the first known address of five."""
    base = erp["brand_records"]
    rows = base.join(_named(erp["billing_method"], "list_id", "list_item_name", "billing_method_id", "billing_method"), "billing_method_id", "left")
    rows = _by_name(_with_emails(rows, "brand_records_id", erp), erp)
    return rows.select(*base.columns, "billing_method", "vendor_id",
                       F.coalesce("_contact", "_customer", "_vendor", "_customer2", "_vendor2").alias("brand_email"))


def brand_marketing_extract(marketing, erp, as_of):
    """Marketing orders whole, with the load time, asset type, contact person, brand billing and address."""
    looked_up = ["asset_type", "mm_email", "mm_name", "jobtitle", "brand_records_name", "billing_customer_id", "billing_vendor_id", "companyname",
                 "customer_email", "billing_method", "billing_method_id", "brandemail", "ods_processed_date"]
    base = marketing.drop(*looked_up)
    brands = erp["brand_records"].select(F.col("brand_records_id").alias("brand_id"), "brand_records_name",
                                         "billing_method_id", "billing_customer_id")
    people = erp["employees"].select(F.col("employee_id").alias("merch_marketing_contact_id"), F.col("email").alias("mm_email"),
                                     F.col("full_name").alias("mm_name"), "jobtitle")
    payer = erp["customers"].select(F.col("customer_id").alias("billing_customer_id"), "companyname", F.col("email").alias("customer_email"))
    rows = (base.join(_named(erp["asset_types"], "list_id", "list_item_name", "asset_type_id", "asset_type"), "asset_type_id", "left")
                .join(people, "merch_marketing_contact_id", "left").join(brands, "brand_id", "left")
                .join(payer, "billing_customer_id", "left")
                .join(_named(erp["billing_method"], "list_id", "list_item_name", "billing_method_id", "billing_method"), "billing_method_id", "left"))
    rows = _with_emails(rows, "brand_id", erp)
    return rows.select(
        *base.columns, "asset_type", "mm_email", "mm_name", "jobtitle", "brand_records_name", "billing_customer_id",
        F.col("vendor_id").alias("billing_vendor_id"), "companyname", "customer_email", "billing_method",
        F.coalesce("_contact", "_customer", "_vendor").alias("brandemail"), F.lit(as_of).cast("timestamp_ntz").alias("ods_processed_date"))


# --------------------------------------------------------------------------- waterfall

def rebate_terms(pairs, agreements, live: Column, item: str, brand: str, inactive=INACTIVE):
    """``pairs`` (a small table with the columns item and brand) with the rebate terms of each.

    Every attribute on its own comes from the first level that has it: item agreement active, item inactive,
    brand agreement active, brand inactive.  Several live agreements of one level each give a row; active agreements
    with equal terms stay apart (each is billed), inactive ones with equal terms count once.
    """
    levels = [("_i1", "item_id", ACTIVE), ("_i2", "item_id", inactive), ("_b1", "brand_id", ACTIVE), ("_b2", "brand_id", inactive)]
    out = pairs
    for name, key, status in levels:
        scope = F.col("item_id").isNotNull() if key == "item_id" else F.col("item_id").isNull()
        mine = item if key == "item_id" else brand
        apart = ["rebate_agreement_id"] if status == ACTIVE else []
        level = (agreements.filter(live & scope & (F.col("active_status_id") == status)).select(F.col(key).alias(mine), *TERMS, *apart).distinct()
                 .select(mine, F.struct(*TERMS).alias(name)))
        out = out.join(level, mine, "left")
    terms = {f"rebate_{t}": F.coalesce(*[F.col(f"{name}.{t}") for name, _, _ in levels]) for t in TERMS}
    return out.withColumns(terms).drop(*[n for n, _, _ in levels])


def rebate_waterfall(rows, agreements, live: Column, item: str, brand: str, inactive=INACTIVE, pairs=None):
    """Rebate terms of each row.

    Terms depend on item and brand only, so they are worked out on ``pairs`` (default: the distinct pairs of the rows;
    a caller with a dimension table passes that) and joined to the rows once.  Rows without item and brand skip the join.
    """
    keyed = F.col(item).isNotNull() | F.col(brand).isNotNull()
    pairs = (rows.filter(keyed) if pairs is None else pairs.filter(keyed)).select(item, brand).distinct()
    terms = rebate_terms(pairs, agreements, live, item, brand, inactive)
    names = [f"rebate_{t}" for t in TERMS]
    terms = terms.select(F.col(item).alias("_item"), F.col(brand).alias("_brand"), *names)
    hit = rows.filter(keyed).join(terms, F.col(item).eqNullSafe(F.col("_item")) & F.col(brand).eqNullSafe(F.col("_brand")), "left").drop("_item", "_brand")
    bare = rows.filter(~keyed).select("*", *[F.lit(None).cast(terms.schema[n].dataType).alias(n) for n in names])
    return hit.unionByName(bare)


def live_at(as_of, first_day=False) -> Column:
    now = F.lit(as_of).cast("timestamp_ntz")
    started = F.col("start_date").cast("timestamp_ntz") <= now if first_day else F.col("start_date").cast("timestamp_ntz") < now
    return started & (F.col("end_date").cast("timestamp_ntz") > now)


def live_between(start, end) -> Column:
    return (F.col("start_date") < F.lit(end).cast("date")) & (F.col("end_date") > F.lit(start).cast("date"))


def _rebate(moment: Column, cost: Column, units: Column) -> Column:
    """Percent of cost, else dollars per unit, inside the agreement's days; else NULL."""
    start, end = F.col("rebate_start_date").cast("timestamp_ntz"), F.col("rebate_end_date").cast("timestamp_ntz")
    inside = (moment >= start) & ((moment <= end) | end.isNull())
    share = (F.col("rebate_percentage") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(14,6)")
    by_percent = F.round(share * cost.cast("decimal(16,4)"), 4)
    by_unit = F.round(F.col("rebate_dollar_amount") * units.cast("decimal(10,0)"), 4)
    return F.when(inside & F.col("rebate_percentage").isNotNull(), by_percent.cast("decimal(18,4)")) \
            .when(inside & F.col("rebate_dollar_amount").isNotNull(), by_unit.cast("decimal(18,4)"))


def _calc_type() -> Column:
    return F.when(F.col("rebate_dollar_amount").isNotNull(), "Dollar Amount (unit)") \
            .when(F.col("rebate_percentage").isNotNull(), "Percentage of COGS")


def _terms() -> list[Column]:
    return ["rebate_start_date", "rebate_end_date", "rebate_percentage", "rebate_dollar_amount", "rebate_billing_period",
            F.col("rebate_brand_sku").alias("rebate_type"), _calc_type().alias("rebate_calc_type"),
            F.col("rebate_billing_method_id").alias("rebate_billing_method")]


def post_vendor_rebate(stage, fc_xref, items, agreements, as_of, inactive=INACTIVE_AT_SHIPMENT):
    """300/111 for shipped lines under an agreement live at the run."""
    names = [f"rebate_{t}" for t in TERMS]
    terms = rebate_terms(items.select("item_id", "brand_id").distinct(), agreements, live_at(as_of), "item_id", "brand_id", inactive)
    # the item master brings its terms along, so the shipped lines are joined once
    priced = items.join(terms.filter(F.col("rebate_start_date").isNotNull())
                        .select(F.col("item_id").alias("_item"), F.col("brand_id").alias("_brand"), *names),
                        F.col("item_id").eqNullSafe(F.col("_item")) & F.col("brand_id").eqNullSafe(F.col("_brand"))).drop("_item", "_brand")
    rows = with_item(_shipped(stage), fc_xref, priced, *names).filter(F.col("item").isNotNull())
    rows = rows.withColumns({n: F.col(f"item.{n}") for n in names})
    cost = F.col("units_shipped") * F.col("item.net_unit_cost")
    rows = rows.withColumn(
        "rebate_total", _rebate(local_time("tran_date"), cost, F.col("units_shipped")))
    return rows.filter(F.col("rebate_total").isNotNull()).select(
        *_line("vendor_rebate"), F.col("rebate_total").alias("tran_amt"), cost.alias("tran_cost_amt"), *_terms(), "rebate_total")


# --------------------------------------------------------------------------- rebates from posted rows

def _known_pairs(items, agreements):
    """Every (item, brand) that can have terms: the item master's, and agreement items that it lacks at a row's warehouse."""
    return items.select("item_id", F.col("brand_id").alias("_maker")).unionByName(
        agreements.select("item_id", F.lit(None).cast(items.schema["brand_id"].dataType).alias("_maker")))


def _posted_products(ledger, fc_xref, items, agreements, start, end):
    day = F.col("tran_gl_date")
    rows = ledger.filter((F.col("tran_sub_type_id") == 16) & (F.col("tran_type") == 300)
                         & day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    fc = fc_xref.filter(F.col("fc_type") != "drinks").select(F.col("ns_fc_id").alias("location_id"), F.col("ods_fc_id").alias("_fc"))
    brand = items.select("item_id", F.col("fc_id").alias("_fc"), F.col("brand_id").alias("_maker"))
    rows = rows.join(fc, "location_id").join(brand, ["item_id", "_fc"], "left")
    rows = rebate_waterfall(rows, agreements, live_between(start, end), "item_id", "_maker", pairs=_known_pairs(items, agreements))
    return rows.filter(F.col("rebate_start_date").isNotNull())


_CARRIED = ["tran_date", "order_type", "order_id", "order_line_id", "company_id", "location_id", "magento_location_id", "customer_id", "sku",
            "parent_item_id", *HIERARCHY, "tran_qty", "increment_id", "sale_date", "ship_date", "item_id",
            "tran_gl_date", "tran_cost_amt"]
_OWN_TERMS = ["rebate_start_date", "rebate_end_date", "rebate_percentage", "rebate_dollar_amount", "rebate_billing_period"]


def backfill_rebates(ledger, fc_xref, items, agreements, start, end):
    """300/111 for product rows posted in a date range, on the cost of goods rounded to the cent."""
    rows = _posted_products(_without_terms(ledger), fc_xref, items, agreements, start, end)
    cogs = F.round("tran_cogs_amt", 2)
    return rows.select(
        *coded("vendor_rebate"), *_CARRIED, cogs.alias("tran_cogs_amt"), *_terms(),
        _rebate(F.col("tran_date"), cogs, F.col("tran_qty")).alias("tran_amt"), F.col("tran_id").alias("fulfillment_tran_id"))


def _without_terms(ledger):
    return ledger.drop("rebate_total", "rebate_type", "rebate_billing_method", *_OWN_TERMS)


def rebate_cost_comparison(ledger, fc_xref, items, agreements, start, end):
    """Rebates on actual against book cost, by sku and terms."""
    rows = _posted_products(_without_terms(ledger), fc_xref, items, agreements, start, end)
    moment, units = F.col("tran_date"), F.col("tran_qty")
    rows = rows.select("sku", "tran_qty", "tran_cogs_amt", "tran_cost_amt", *_terms(),
                       _rebate(moment, F.col("tran_cogs_amt"), units).alias("_actual"),
                       _rebate(moment, F.col("tran_cost_amt"), units).alias("_book"))
    return rows.groupBy("sku", *_OWN_TERMS, "rebate_type", "rebate_calc_type", "rebate_billing_method").agg(
        F.sum("tran_qty").alias("quantity"), F.sum("tran_cogs_amt").alias("cogs"), F.sum("tran_cost_amt").alias("pb_cogs"),
        F.sum("_actual").alias("fifo_rebate"), F.sum("_book").alias("pb_rebate"))


# --------------------------------------------------------------------------- cost adjustments

COST_MEMO = "Cost of Sales Adjustment"


def cost_adjustment_header(headers, lines, start, end):
    """Headers in the date range that carry at least one cost-of-sales line."""
    marked = lines.filter(F.col("memo") == COST_MEMO).select("transaction_id")
    return _in_range(headers, start, end).join(marked, "transaction_id", "left_semi")


def cost_adjustment_detail(headers, lines, start, end):
    """Cost-of-sales lines of headers in the date range."""
    return lines.filter(F.col("memo") == COST_MEMO).join(
        _in_range(headers, start, end).select("transaction_id"), "transaction_id", "left_semi")


def _in_range(headers, start, end):
    return headers.filter(F.col("trandate").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def post_cost_adjustment_rebate(lines, headers, ledger, fc_xref, items, agreements, as_of, account=279):
    """300/111 on cost adjustments not posted before, where a percentage applies."""
    posted = ledger.select(F.col("ns_tran_id").alias("transaction_id")).filter(F.col("transaction_id").isNotNull())
    now = F.lit(as_of).cast("timestamp_ntz")
    head = headers.filter(F.col("trandate").cast("timestamp_ntz") < now).select("transaction_id", "trandate")
    fc = fc_xref.select(F.col("ns_fc_id").alias("location_id"), F.col("ods_fc_id").alias("_fc"))
    master = items.select("item_id", F.col("fc_id").alias("_fc"), F.col("item_name").alias("sku"), F.col("brand_id").alias("_maker"))
    rows = (lines.filter(F.col("account_id") == account).join(head, "transaction_id")
                 .join(posted, "transaction_id", "left_anti").join(fc, "location_id", "left")
                 .join(master, ["item_id", "_fc"], "left"))
    rows = rebate_waterfall(rows, agreements, live_at(as_of, first_day=True), "item_id", "_maker", pairs=_known_pairs(items, agreements))
    rows = rows.filter(F.col("rebate_percentage").isNotNull())
    value = _rebate(F.col("trandate").cast("timestamp_ntz"), F.col("amount"), F.lit(0))
    return rows.select(
        "sku", *coded("vendor_rebate"), F.col("trandate").cast("timestamp_ntz").alias("tran_date"),
        F.col("amount").alias("tran_cogs_amt"), F.col("date_created").alias("created_at"), "item_id",
        F.col("trandate").alias("tran_gl_date"), "location_id", *_terms(), value.alias("tran_amt"),
        value.alias("rebate_total"), F.col("transaction_id").alias("ns_tran_id"))


# --------------------------------------------------------------------------- promotional funding

BILLABLE = (1, 2, 3)


def _post_funding(ledger, discounts, fc_xref, items, brands, code, campaign: Column, key, since, as_of):
    """Brand-sponsored part of posted TPA discounts (48), unless that line was funded before.

    ``since`` bounds the GL dates of the discounts, so a run reads the open partitions only; a line's funding has its
    discount's GL date, so the guard is bounded alike.
    """
    _, sub, _ = CODES[code]
    if since is not None:
        ledger = ledger.filter(F.col("tran_gl_date") >= F.lit(since).cast("date"))
    done = ledger.filter((F.col("tran_sub_type_id") == sub) & F.col("order_line_id").isNotNull()).select("order_id", "order_line_id")
    deal = discounts.filter(F.col("sponsored_by").isin("Brand", "Both") & (F.col("discount_type") == "tpa") & campaign).select(
        F.col("item_id").alias(key), "rule_id", F.col("sponsored_percentage").cast("decimal(9,4)").alias("_share"))
    fc = fc_xref.select(F.col("fc_id").alias("magento_location_id"), "ods_fc_id")
    goods = items.filter(F.col("vendor_type") != "Private Label").select(
        F.col("item_name").alias("sku"), F.col("fc_id").alias("_fc"), F.col("brand_id").alias("_maker"))
    payer = brands.filter(F.col("billing_method_id").isin(*BILLABLE)).select(
        F.col("brand_records_id").alias("_maker"), "billing_method_id")
    tpa = ledger.filter((F.col("tran_sub_type_id") == 48) & F.col(key).isNotNull())
    rows = (tpa.join(deal, [key, "rule_id"]).join(fc, "magento_location_id", "left")
               .withColumn("_fc", F.coalesce("ods_fc_id", F.lit(2)).cast("bigint")).join(goods, ["sku", "_fc"])
               .join(payer, "_maker").join(done, ["order_id", "order_line_id"], "left_anti"))
    funded = (F.col("tran_amt") * (F.col("_share") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(11,6)")).cast("decimal(18,8)")
    return rows.select(
        *coded(code), "tran_date", "order_type", "order_id", "order_line_id", "parent_item_id", "company_id", "location_id", "magento_location_id",
        "customer_id", "sku", *HIERARCHY, "tran_qty", F.col("tran_amt").alias("tran_discount_amt"), "increment_id", "rule_id", "rule_name",
        "sale_date", "ship_date", "item_id", "tran_gl_date", F.lit(as_of).cast("timestamp_ntz").alias("created_at"),
        F.col("tran_id").alias("fulfillment_tran_id"),
        F.col("_share").alias("rebate_percentage"), F.col("billing_method_id").alias("rebate_billing_method"),
        funded.alias("rebate_total"), funded.alias("tran_amt"))


def _autoship() -> Column:
    return F.col("rule_name").like("A&S%")


def post_tpr_funding(ledger, discounts, fc_xref, items, brands, since=None, as_of=None):
    return _post_funding(ledger, discounts, fc_xref, items, brands, "tpr_funding", ~_autoship(), "order_line_id", since, as_of)


def post_tpr_funding_bundle(ledger, discounts, fc_xref, items, brands, since=None, as_of=None):
    return _post_funding(ledger, discounts, fc_xref, items, brands, "tpr_funding", ~_autoship(), "parent_item_id", since, as_of)


def post_as_funding(ledger, discounts, fc_xref, items, brands, since=None, as_of=None):
    return _post_funding(ledger, discounts, fc_xref, items, brands, "as_funding", _autoship(), "order_line_id", since, as_of)


def post_as_funding_bundle(ledger, discounts, fc_xref, items, brands, since=None, as_of=None):
    """Guards on its own sub type, so a rerun posts nothing again."""
    return _post_funding(ledger, discounts, fc_xref, items, brands, "as_funding", _autoship(), "parent_item_id", since, as_of)


def post_brand_marketing_fee(marketing, ledger):
    """300/112 for marketing orders with a start date that are not in the ledger yet."""
    posted = ledger.filter(F.col("brand_marketing_id").isNotNull()).select(F.col("brand_marketing_id").alias("bm_id"))
    rows = marketing.filter(F.col("start_date").isNotNull()).join(posted, "bm_id", "left_anti")
    return rows.select(
        *coded("brand_marketing"), F.col("start_date").cast("timestamp_ntz").alias("tran_date"), F.lit(1).alias("company_id"),
        F.col("ods_processed_date").cast("timestamp_ntz").alias("created_at"), F.col("start_date").cast("date").alias("tran_gl_date"),
        F.col("total_cost").alias("tran_amt"), F.col("bm_id").alias("brand_marketing_id"))
