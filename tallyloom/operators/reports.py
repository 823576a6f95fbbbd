"""Revenue, journal and vendor-billing reports over the ledger.

Reports take their date range as arguments and filter the ledger by ``tran_gl_date``
first, its partition column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tallyloom.functions.exprs import nz
from tallyloom.operators.checks import with_warehouse_item


def between(column, start, end) -> Column:
    return F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def with_month(rows):
    """Month name, year and month end of the GL date, computed in place of a calendar lookup join."""
    d = F.col("tran_gl_date")
    return rows.withColumns({"month_name": F.monthname(d), "calendar_year": F.year(d), "month_end_date": F.last_day(d)})


# --------------------------------------------------------------------------- revenue

# Journal maps that add to and take from each revenue, and the revenue accounts.
PRODUCT_PLUS, PRODUCT_MINUS = (80, 85, 90, 100, 37, 36), (35,)
MEMBER_PLUS, MEMBER_MINUS = (63, 145, 124, 10, 8), (64, 62, 79, 123)
REVENUE_ACCOUNTS = ("40100", "40105")


def _signed(plus, minus) -> Column:
    m, amount = F.col("je_map_id"), F.col("tran_amt")
    return F.coalesce(F.sum(F.when(m.isin(*plus), amount).when(m.isin(*minus), -amount)), F.lit(0))


def revenue_by_state(ledger, journal, order_header, membership_header, start, end):
    """Product and membership revenue by month and state; the order's state before the membership's."""
    booked = journal.filter(between("tran_date", start, end) & F.col("acct_number").isin(*REVENUE_ACCOUNTS)).select("tran_id")
    orders = order_header.select("increment_id", F.col("billing_state").alias("_order_state")).distinct()
    members = membership_header.select(F.col("increment_id").cast("string").alias("increment_id"),
                                       F.col("billing_state").alias("_member_state")).distinct()
    rows = ledger.filter(between("tran_gl_date", start, end)).join(booked, "tran_id", "left_semi")
    # sums per increment id first, so that the state joins meet fewer rows
    sums = rows.groupBy("increment_id", "tran_sub_type", "je_map_id",
                        F.concat(F.monthname("tran_gl_date"), F.lit("-"), F.year("tran_gl_date")).alias("order_month")) \
               .agg(_signed(PRODUCT_PLUS, PRODUCT_MINUS).alias("_prod"), _signed(MEMBER_PLUS, MEMBER_MINUS).alias("_mem"))
    placed = sums.join(orders, "increment_id", "left").join(members, "increment_id", "left") \
                 .withColumn("state", F.coalesce("_order_state", "_member_state"))
    first = placed.groupBy("order_month", "state", "tran_sub_type", "je_map_id").agg(
        F.sum("_prod").alias("_prod"), F.sum("_mem").alias("_mem"))
    return first.filter((F.col("_prod") != 0) | (F.col("_mem") != 0)).groupBy("order_month", "state").agg(
        F.sum("_prod").alias("prodrev"), F.sum("_mem").alias("memrev"))


# Coupon account, and the P&L columns by account.
COUPON_ACCOUNT = "41107"
PNL = {"pdgpr": "40100", "tpr": "41113", "astpr": "41104"}
COUPON_KEYS = ["order_id", "increment_id", "sale_date", "tran_gl_date", "coupon_rule_name", "rule_id", "coupon_group_code"]


def crm_discounts(ledger, journal, gl_map, manual_headers, manual_lines, accounts, start, end):
    """Coupon discounts per order and rule beside the order's P&L, plus one row of manual account activity."""
    booked = journal.filter(F.col("acct_number") == COUPON_ACCOUNT).select("tran_id")
    coupons = (ledger.filter(between("tran_gl_date", start, end)).join(booked, "tran_id", "left_semi")
                     .groupBy(*COUPON_KEYS).agg((-F.sum("tran_amt")).alias("crm_discount")))
    # summed for all orders: cutting them to those with coupons first would take the ledger through the coupon joins twice
    mapped = ledger.join(gl_map.withColumnRenamed("map_id", "je_map_id"), "je_map_id")
    # the debit side wins when both sides name the account
    amount = nz("tran_amt")
    pnl = mapped.groupBy("order_id").agg(*[
        F.sum(F.when(F.col("debit_account_number") == acct, -amount)
               .when(F.col("credit_account_number") == acct, amount).otherwise(0)).alias(name)
        for name, acct in PNL.items()])
    report = coupons.join(pnl, "order_id", "left")
    account = accounts.filter(F.col("accountnumber") == COUPON_ACCOUNT).select("account_id")
    manual = (manual_headers.filter(between("trandate", start, end) & ~F.col("is_from_ods")).select("transaction_id")
              .join(manual_lines, "transaction_id").join(account, "account_id")
              .groupBy(F.lit("Account Activity").alias("coupon_rule_name"))
              .agg((-F.sum(nz("debit_amount") - nz("credit_amount"))).alias("crm_discount"))
              .withColumn("order_id", F.lit(0).cast("bigint")))
    return report.unionByName(manual, allowMissingColumns=True)


# --------------------------------------------------------------------------- vendor funding journal

# Journal account names.
CREDIT_ACCOUNTS = {
    111: "51035 Cost of Goods Sold : Rebates from Vendors",
    112: "51041 - Brand Marketing Fees",
    113: "43113 Marketplace Revenue : TPA - Vendor Funds Earned",
    114: "43114 Marketplace Revenue : TPA - Autoship & Save - Vendor funds earned",
}
REVIEW_ACCOUNT = "43105 - Referral Credit - Vendor Funds Earned"
REVIEW_ITEMS = ("Reviews", "Review Incentives")
PAYABLE_ACCOUNT = "20103 Accounts Payable : Vendor Funding Credits"
RECEIVABLE_ACCOUNT = "12010 Unbilled Accounts Receivable"
BILLED = ("UNFI Bill", "AP Credit", "AR Invoice")


def vendor_funding_journal(ledger, fc_xref, items, brands, marketing, start, end):
    """Month-end accrual: one credit and one debit leg per account and posting name, reversed the next day.

    Both legs are read off the same rows, spread into a pair, so debit equals credit.
    """
    rows = ledger.filter(F.col("tran_sub_type_id").isin(*CREDIT_ACCOUNTS) & between("tran_gl_date", start, end)
                         & F.col("cancel_type").isNull())
    rows = with_warehouse_item(rows, fc_xref, items, "brand_id")
    rows = (rows.join(brands.select(F.col("brand_records_id").alias("brand_id"), "billing_method_id"), "brand_id", "left")
                .join(marketing.select(F.col("bm_id").alias("brand_marketing_id"), "billing_method", "vendor_funding_item"),
                      "brand_marketing_id", "left")
                .filter(F.col("billing_method_id").isin(1, 2, 3) | F.col("billing_method").isin(*BILLED)))
    rows = with_month(rows)
    sub = F.col("tran_sub_type_id")
    earned = F.when((sub == 112) & F.col("vendor_funding_item").isin(*REVIEW_ITEMS), REVIEW_ACCOUNT)
    for code, name in CREDIT_ACCOUNTS.items():
        earned = earned.when(sub == code, name)
    owed = F.when((F.col("billing_method_id") == 1) | (F.col("billing_method") == "AP Credit"), PAYABLE_ACCOUNT) \
            .when(F.col("billing_method_id").isin(2, 3) | F.col("billing_method").isin("AR Invoice", "UNFI Bill"), RECEIVABLE_ACCOUNT)
    amount = (F.when(sub == 111, F.col("rebate_total")).when(sub == 112, F.round("tran_amt", 2))
               .otherwise(F.round("rebate_total", 2))).cast("decimal(18,4)")
    month = F.concat_ws(" ", "month_name", "calendar_year")
    none = F.lit(None).cast("decimal(18,4)")
    legs = F.array(F.struct(F.lit("credit").alias("side"), earned.alias("acct"), none.alias("debit"), amount.alias("credit")),
                   F.struct(F.lit("debit").alias("side"), owed.alias("acct"), amount.alias("debit"), none.alias("credit")))
    spread = rows.select(
        F.explode(legs).alias("leg"), F.concat(month, F.lit(" Vendor Funding Accrual")).alias("memo"),
        F.concat(month, F.lit(" "), "tran_sub_type", F.lit(" Accrual")).alias("line_memo"),
        F.col("month_end_date").alias("je_date"), F.date_add("month_end_date", 1).alias("reversal_date"))
    return spread.groupBy("leg.side", "leg.acct", "memo", "line_memo", "je_date", "reversal_date") \
                 .agg(F.sum("leg.debit").alias("debit"), F.sum("leg.credit").alias("credit"))


# --------------------------------------------------------------------------- rebate reports

TERMS = ["rebate_type", "rebate_billing_period", "rebate_start_date", "rebate_end_date", "rebate_percentage", "rebate_dollar_amount"]
# Day from which the report shows book cost instead of actual cost.
COST_SWITCH = "2023-11-01"


def _payers(agreements, *columns):
    """Distinct billing parties of each brand name."""
    return agreements.select(F.col("brand_records_name").alias("brand_name"), *columns).distinct()


def _rebate_rows(ledger, fc_xref, items, start, end):
    rows = ledger.filter(F.col("tran_sub_type_id").isin(16, 111) & between("tran_gl_date", start, end))
    return with_warehouse_item(rows, fc_xref, items, "brand_name", "description")


def _parties(agreements, methods):
    """Billing parties of each brand and names of each method, with the number of rows that each stands for."""
    party = _payers(agreements, "brand_id", "billing_customer_id", "vendor_id") \
        .groupBy("brand_name", F.coalesce("billing_customer_id", "vendor_id").alias("cust_vend")).agg(F.count(F.lit(1)).alias("_parties"))
    method = methods.groupBy(F.col("list_id").alias("rebate_billing_method"), "list_item_name").agg(F.count(F.lit(1)).alias("_methods"))
    return party, method


_REPORT_KEYS = ["brand_name", "rebate_billing_method", "sku", "description", *TERMS]
_REPORT_SUMS = ["tran_qty", "tran_cogs_amt", "rebate_to_bill"]


def _named_sums(rows, party, method):
    """Sums by ledger keys, then the names: ``party`` and ``method`` join the sums, each times the rows it stands for."""
    sums = rows.groupBy(*_REPORT_KEYS).agg(
        F.sum("_qty").alias("tran_qty"), F.sum("_cogs").alias("tran_cogs_amt"), F.sum("_rebate").alias("rebate_to_bill"))
    times = (F.coalesce("_parties", F.lit(1)) * F.coalesce("_methods", F.lit(1))).cast("decimal(10,0)")

    def value(c):
        kind = sums.schema[c].dataType
        wide = DecimalType(min(38, kind.precision + 10), kind.scale) if isinstance(kind, DecimalType) else kind
        return (F.col(c) * times).cast(wide).alias(c)

    named = sums.join(party, "brand_name", "left").join(method, "rebate_billing_method", "left")
    return named.select(*_REPORT_KEYS, "list_item_name", "cust_vend", *[value(c) for c in _REPORT_SUMS])


def vendor_rebate_report(ledger, fc_xref, items, agreements, methods, start, end, cost_switch=COST_SWITCH):
    """Rebates by brand, sku and terms with their billing party."""
    rows = _rebate_rows(ledger.filter(F.col("cancel_type").isNull()), fc_xref, items, start, end)
    late = F.col("tran_gl_date") >= F.lit(cost_switch).cast("date")
    rows = rows.filter(F.col("rebate_start_date").isNotNull()).withColumns({
        "_qty": F.col("tran_qty"), "_cogs": F.when(late, F.col("tran_cost_amt")).otherwise(F.col("tran_cogs_amt")).cast("decimal(14,4)"),
        "_rebate": F.coalesce("rebate_total", "tran_amt")})
    # parties and methods are distinct, so the sums need no second grouping
    return _named_sums(rows, *_parties(agreements, methods)).withColumnRenamed("rebate_to_bill", "tran_amt")


def rebate_rollup(ledger, fc_xref, items, agreements, methods, start, end):
    """Second level: per brand and sku the largest terms and the sums; quantity and cost from product rows.

    A brand's parties fan out the sums, and only the greatest is shown, so they enter as one row per brand with their number.
    """
    product = F.col("tran_sub_type_id") == 16
    rows = _rebate_rows(ledger, fc_xref, items, start, end).withColumns({
        "_qty": F.when(product, F.col("tran_qty")), "_cogs": F.when(product, F.col("tran_cogs_amt")), "_rebate": F.col("rebate_total")})
    party, method = _parties(agreements, methods)
    party = party.groupBy("brand_name").agg(F.max("cust_vend").alias("cust_vend"), F.sum("_parties").alias("_parties"))
    method = method.groupBy("rebate_billing_method").agg(F.max("list_item_name").alias("list_item_name"), F.sum("_methods").alias("_methods"))
    return _named_sums(rows, party, method).groupBy("brand_name", "sku", "description").agg(
        *[F.max(c).alias(c) for c in ("rebate_billing_method", *TERMS, "list_item_name", "cust_vend")],
        *[F.sum(c).alias(c) for c in _REPORT_SUMS])


# --------------------------------------------------------------------------- billing files

# ERP item numbers by posting and billing method.
BILL_ITEMS = {("AR Invoice", 111): "31091", ("AR Invoice", 112): "7735", ("AP Credit", 111): "149998", ("AP Credit", 112): "150002"}
INVOICE_PREFIX = "TMVF-"


def _funding(ledger, fc_xref, items, agreements, marketing, methods, start, end, *payer_columns):
    rows = ledger.filter(F.col("tran_sub_type_id").isin(111, 112) & between("tran_gl_date", start, end))
    rows = with_warehouse_item(rows, fc_xref, items, "brand_name", "description", F.col("brand_id").alias("item_brand_id"))
    payer = _payers(agreements, "billing_customer_id", "vendor_id", "billing_method_id", *payer_columns) \
        .withColumnsRenamed({"billing_customer_id": "_customer", "vendor_id": "_vendor", "brandemail": "_payer_email"})
    bm = marketing.select(F.col("bm_id").alias("brand_marketing_id"), F.col("billing_method").alias("_bm_method"),
                          F.col("billing_customer_id").alias("_bm_customer"), F.col("billing_vendor_id").alias("_bm_vendor"),
                          "asset_description", F.col("brand_id").alias("_bm_brand"), "brand_records_name",
                          F.col("brandemail").alias("_bm_email"))
    method = methods.select(F.col("list_id").alias("billing_method_id"), "list_item_name")
    rows = with_month(rows.join(payer, "brand_name", "left").join(bm, "brand_marketing_id", "left")
                          .join(method, "billing_method_id", "left"))
    how = F.coalesce("list_item_name", "_bm_method")
    month = F.concat_ws(" ", "month_name", "calendar_year")
    sub = F.col("tran_sub_type_id")
    bill = F.lit(None).cast("string")
    for (name, code), number in BILL_ITEMS.items():
        bill = F.when((how == name) & (sub == code), number).otherwise(bill)
    return rows.withColumns({
        "method": how, "_month": month, "item": bill,
        "cust_vend_id": F.when(how == "AR Invoice", F.coalesce("_customer", "_bm_customer"))
                         .when(how == "AP Credit", F.coalesce("_vendor", "_bm_vendor")),
        "memo": F.concat(month, F.lit(" Brand Funding Participation")),
        "_invoice": F.concat(F.lit(INVOICE_PREFIX), "month_name", "calendar_year", F.lit("-")),
        "amount": F.when(sub == 111, nz("rebate_total")).otherwise(nz("tran_amt")).cast("decimal(18,4)")})


def _ratio(a: Column, b: Column) -> Column:
    return F.round(F.try_divide(a.cast("double"), F.nullif(b, F.lit(0)).cast("double")), 8)


def invoice_upload(ledger, fc_xref, items, agreements, marketing, methods, start, end):
    """Upload lines of invoices and credits.  Distributor bills are left out; the test is on the
    marketing order's method, so rows without one drop out."""
    rows = _funding(ledger, fc_xref, items, agreements, marketing, methods, start, end)
    sub = F.col("tran_sub_type_id")
    rows = rows.filter(F.col("_bm_method") != "UNFI Bill").withColumns({
        "invoice_number": F.concat("_invoice", F.col("cust_vend_id").cast("string")),
        "_text": F.when(sub == 111, F.concat("_month", F.lit(" Rebates"))).otherwise(F.col("asset_description")),
        "sku_info": F.when(sub == 111, F.concat("sku", F.lit(" - "), "description")).otherwise(F.col("asset_description"))})
    keys = ["tran_sub_type_id", "method", "cust_vend_id", "invoice_number", "month_end_date", "memo", "item",
            F.col("_text").alias("line_text"), "sku_info"]
    sums = rows.groupBy(*keys).agg(
        F.sum("amount").alias("amount"), F.sum("tran_cogs_amt").alias("_cogs"), F.sum("tran_qty").alias("_qty"))
    return sums.select(
        "tran_sub_type_id", "method", "cust_vend_id", "invoice_number", "month_end_date", "memo", "amount", "item",
        "line_text", F.lit(1).alias("ns_location"), "sku_info",
        F.when(sub == 111, F.col("_cogs")).otherwise(F.col("amount")).alias("discount"),
        F.when(sub == 111, _ratio(F.col("amount"), F.col("_cogs"))).otherwise(1.0).alias("rate"),
        F.coalesce("_qty", F.lit(1)).alias("tran_qty"))


def distributor_report(ledger, fc_xref, items, agreements, marketing, methods, start, end, contact=None):
    """The distributor's bills: program, brand-numbered invoice, percentage.  ``contact`` is the address printed."""
    rows = _funding(ledger, fc_xref, items, agreements, marketing, methods, start, end, "brandemail")
    rebate = F.col("tran_sub_type_id") == 111
    rows = rows.filter(F.col("method") == "UNFI Bill").withColumns({
        "brand": F.coalesce("brand_name", "brand_records_name"),
        "invoice_number": F.concat("_invoice", F.coalesce("item_brand_id", "_bm_brand").cast("string")),
        "program": F.when(rebate, "Rebates").otherwise("Ads"),
        "billing_type": F.when(rebate, "Rebates").otherwise("Brand Marketing"),
        "sku": F.coalesce("sku", F.lit("00000000000")),
        "email": F.coalesce("_bm_email", "_payer_email"),
        "invoice_category": F.coalesce(F.concat("brand_records_name", F.lit(" - "), "asset_description"), F.lit("Vendor Rebates")),
        "suppress": F.when(~rebate, "x"),
        "_discount": F.coalesce("tran_cogs_amt", "tran_cost_amt").cast("decimal(18,4)")})
    keys = ["brand", "invoice_number", "program", "billing_type", "month_end_date", "sku", "invoice_category",
            F.col("description").alias("sku_info"), "email", "suppress", "cust_vend_id", "item_brand_id", "memo"]
    sums = rows.groupBy(*keys).agg(
        F.sum(F.coalesce("tran_qty", F.lit(1))).alias("qty"), F.sum(F.coalesce("_discount", "amount")).alias("discount"),
        F.sum("amount").alias("amount"), F.sum("_discount").alias("_base"))
    return sums.withColumn("percentage", F.coalesce(_ratio(F.col("amount"), F.col("_base")), F.lit(1.0))) \
               .withColumn("contact", F.lit(contact).cast("string")).drop("_base", "cust_vend_id", "item_brand_id", "memo")


def brand_marketing_report(ledger, marketing, start, end):
    """Posted marketing fees with the party to bill."""
    rows = ledger.filter((F.col("tran_sub_type_id") == 112) & between("tran_gl_date", start, end)).select(
        "tran_gl_date", "tran_amt", F.col("brand_marketing_id").alias("bm_id"))
    return rows.join(marketing, "bm_id", "left").select(
        "tran_gl_date", "brand_records_name", "billing_method",
        F.coalesce("billing_customer_id", "billing_vendor_id").alias("vend_cust"), "vendor_funding_item",
        "asset_description", "mm_email", "start_date", "end_date", "billing_month_id", "tran_amt")
