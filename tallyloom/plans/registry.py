"""Every operator as a named query over the derived tables.

A query is registered with the columns it returns and their check type: n whole number,
m amount (double), s text, d date, t timestamp, b boolean.  Both engines cast to these
for comparison; the operators themselves keep exact decimals and native dates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import relational as R
from tallyloom.operators import checks, credits, fulfillment, funding, ingest, ledger, maintenance, postings, reports
from tallyloom.plans import pipelines
from tallyloom.schema import LEDGER
from tallyloom.session import shared_dir, tuned
from tallyloom.sources.messages import message_queue
from tallyloom.sources.shapes import table

AS_OF = "1999-01-01"
START, END = "1996-03-01", "1999-06-30"
PURGE_BEFORE = "1997-01-01"
CUTOFF = "1996-01-01"

SPECS: dict[str, str] = {}
BUILDERS: dict[str, Callable] = {}
CASTS = {"n": "bigint", "m": "double", "s": "string", "d": "string", "t": "string", "b": "bigint"}


class Tables:
    """Access to the derived tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        rows = table(self.spark, self.sf_dir, name)
        # the ledger has all its columns, also those that the fixture leaves empty
        return maintenance.add_columns(rows, LEDGER) if name == "ledger" else rows

    def many(self, *names: str) -> list[DataFrame]:
        return [self(n) for n in names]

    def queue(self, *types: str) -> DataFrame:
        return message_queue(self.spark, self.sf_dir, *types, tasks=int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    def erp(self) -> dict[str, DataFrame]:
        names = {"customers": "erp_customers", "vendors": "erp_vendors"}
        plain = ("contact_map", "vendor_map", "contacts", "brand_records", "billing_method", "period_list", "status_list",
                 "rebate_types", "employees", "asset_types")
        return {n: self(t) for n, t in (names | {p: p for p in plain}).items()}


def parse_spec(spec: str) -> list[tuple[str, str]]:
    return [tuple(c.split(":")) for c in spec.split()]


def shaped(df: DataFrame, spec: str) -> DataFrame:
    return df.select(*[F.col(c).cast(CASTS[k]).alias(c) for c, k in parse_spec(spec)])


def query(name: str, spec: str):
    def register(build):
        SPECS[name], BUILDERS[name] = spec, build
        return build
    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(name):
        return lambda spark, sf_dir: shaped(BUILDERS[name](Tables(tuned(spark), sf_dir)), SPECS[name])
    return {name: bound(name) for name in BUILDERS}


def fates(first: DataFrame, second: DataFrame, names=("moved", "kept")) -> DataFrame:
    return R.union_all(first.withColumn("fate", F.lit(names[0])), second.withColumn("fate", F.lit(names[1])))


# =========================================================================== S: sources, sinks, maintenance

@query("queue_source", "id:n message_uuid:s order_id:n s3_updated_at:t")
def _(t):
    return maintenance.queue_source(t.queue(), "oc")


@query("erp_snapshot_load", "customer_id:n name:s email:s companyname:s")
def _(t):
    return maintenance.erp_snapshot_load(t("erp_customers"), shared_dir(t.spark, "customers"))


@query("append_insert", "order_id:n tran_type:n tran_sub_type_id:n tran_amt:m")
def _(t):
    return maintenance.append_insert(t("order_ledger"), postings.post_order_charges(t("capture")))


LINE_KEYS = ["transaction_id", "item_id", "transaction_line_id"]


@query("insert_if_absent", "transaction_id:n transaction_line_id:n item_id:n amount:m")
def _(t):
    stored = t("adj_lines").filter("item_id % 2 = 0").withColumn("amount", F.lit(0).cast("decimal(12,2)"))
    return maintenance.insert_if_absent(stored, t("adj_lines"), LINE_KEYS)


@query("update_from", "rebate_agreement_id:n percentage:m brandemail:s billing_period:s")
def _(t):
    news = t("agreements").filter("rebate_agreement_id % 3 = 0").select(
        "rebate_agreement_id", (F.col("percentage") + 1).cast("decimal(12,4)").alias("percentage"), F.upper("brandemail").alias("brandemail"))
    return maintenance.update_from(t("agreements"), news, ["rebate_agreement_id"], ["percentage", "brandemail"])


@query("upsert_dimension", "rebate_agreement_id:n percentage:m dollar_amount:m brandemail:s billing_period:s item_id:n")
def _(t):
    stored = t("agreements").filter("rebate_agreement_id % 4 <> 1").withColumn("billing_period", F.lit("old"))
    news = t("agreements").filter("rebate_agreement_id % 5 <> 2").withColumns({
        "percentage": (F.col("percentage") + 1).cast("decimal(12,4)"), "brandemail": F.upper("brandemail")})
    return maintenance.upsert_dimension(stored, news, ["rebate_agreement_id"], ["percentage", "dollar_amount", "brandemail"])


@query("semi_delete", "order_id:n message_uuid:s")
def _(t):
    return maintenance.semi_delete(t("capture"), t("cancel_orders"), ["order_id"])


@query("in_delete", "item_id:n order_id:n")
def _(t):
    done = t("order_detail").filter("fulfillment_qty + short_qty <> 0").select("item_id")
    return maintenance.in_delete(t("ship_detail"), "item_id", done)


@query("archive_move", "order_id:n message_uuid:s fate:s")
def _(t):
    return fates(*maintenance.archive_move(t("cancels"), t("membership"), ["order_id"]), ("processed", "staging"))


@query("quarantine_already_done", "item_id:n order_id:n fate:s")
def _(t):
    return fates(*maintenance.quarantine_already_done(t("ship_detail"), t("order_detail"), AS_OF), ("error", "staging"))


@query("null_fill_from_dimension", "tran_id:n tran_sub_type_id:n group_id:n group_name:s category_id:n category_name:s sub_category_id:n sub_category_name:s"
       " class_id:n class_name:s subclass_id:n subclass_name:s item_id:n tran_cost_amt:m")
def _(t):
    return maintenance.null_fill_from_dimension(t("ledger"), t("curr_items"))


@query("link_rebate_to_fulfillment", "tran_id:n tran_sub_type_id:n order_line_id:n fulfillment_tran_id:n")
def _(t):
    return maintenance.link_rebate_to_fulfillment(t("ledger"))


@query("add_columns", "item_id:n discount_id:n sponsored_by:s sponsored_percentage:m")
def _(t):
    old = t("detail_discounts").drop("sponsored_by", "sponsored_percentage")
    grown = maintenance.add_columns(old, {"sponsored_by": "string", "sponsored_percentage": "double"})
    return maintenance.append_insert(grown, t("capture_discounts").withColumn("discount_id", F.col("position")))


@query("purge_by_predicate", "tran_id:n tran_sub_type_id:n")
def _(t):
    gone = (F.col("tran_sub_type_id") == 111) & F.col("fulfillment_tran_id").isNotNull() \
        & (F.col("tran_gl_date") < F.lit(PURGE_BEFORE).cast("date"))
    return maintenance.purge_by_predicate(t("ledger"), gone)


# =========================================================================== Q: queue

def staged(df, remainder, key):
    """Rows of a table that a former run left in staging (1), archive (2) or store (3)."""
    return df.filter(F.col(key) % 25 == remainder)


@query("dedupe_gift_card_adjustments", "id:n fate:s")
def _(t):
    moves = t("card_moves")
    return fates(*ingest.dedupe_gift_card_adjustments(t.queue("gca"), *[staged(moves, r, "event_id") for r in (1, 2, 3)]),
                 ("error", "queue"))


@query("dedupe_order_cancel", "id:n fate:s")
def _(t):
    return fates(*ingest.dedupe_order_cancel(t.queue("ocn"), staged(t("cancel_orders"), 1, "order_id"),
                                             staged(t("cancel_orders"), 2, "order_id"), t("order_header")), ("error", "queue"))


WORK_SOURCES = {"gca": "card_moves", "ocn": "cancel_orders", "ma": "orders_z", "gcf": "gift_sales", "oc": "capture",
                "mc": "membership", "oa": "assignments", "of": "ship_header", "cm": "credits"}


def work_staged(t, message_type):
    """(staging, archive) keys of one message type."""
    df = t(WORK_SOURCES[message_type])
    if message_type == "ma":
        df = df.select(F.col("k").alias("order_id"), F.expr("'ma-' || CAST(k AS STRING)").alias("message_uuid"))
    if message_type == "of":
        df = df.withColumn("message_uuid", F.concat("message_uuid", F.lit("-1")))
    number = {"gca": "event_id", "cm": "credit_id"}.get(message_type, "order_id")
    return staged(df, 1, number), staged(df, 2, number)


def known_keys(t):
    return ingest.known_keys({m: work_staged(t, m) for m in ingest.WORK_KEYS})


@query("new_message_worklist", "message_type:s work_key:s id:n")
def _(t):
    return ingest.work_lists(t.queue(), known_keys(t))


@query("parse_gift_card_adjustment", "message_uuid:s customer_id:s card_id:n card_amt:m card_delta:m action:s action_label:s"
       " reason_id:n reason_label:s group_code:s group_label:s updated_at:t subscription_start_date:t subscription_end_date:t expire_at:t")
def _(t):
    return ingest.parse_gift_card_adjustment(t.queue("gca"))


@query("parse_order_cancel", "message_uuid:s order_id:n increment_id:s customer_id:n updated_at:t total_order:m refunds:s ms_initiated:b is_fraud:b")
def _(t):
    return ingest.parse_order_cancel(t.queue("ocn"))


@query("explode_cancel_cash_earned", "order_id:n item_id:n rule_id:n earned_amt:m thrive_id:n message_uuid:s")
def _(t):
    return ingest.explode_cancel_cash_earned(t.queue("ocn"))


@query("parse_membership_adjustment", "message_uuid:s customer_id:s start_status:s end_status:s credit_memo_id:n updated_at:t")
def _(t):
    return ingest.parse_membership_adjustment(t.queue("ma"))


@query("parse_gift_card_fulfillment", "message_uuid:s order_id:n increment_id:n item_id:n card_id:n card_type:n card_amt:m sku:s group_code:s updated_at:t")
def _(t):
    return ingest.parse_gift_card_fulfillment(t.queue("gcf"))


HEADER_SPEC = ("message_uuid:s order_id:n increment_id:s order_type:s customer_id:n is_autoship:s created_at:t updated_at:t"
               " base_total_order:m base_total_product:m base_total_discount:m base_total_tax:m base_donations:m base_shipment:m"
               " base_shipment_tax:m grocery_base_shipment:m grocery_base_shipment_tax:m frozen_base_shipment:m"
               " frozen_base_shipment_tax:m wine_base_shipment:m wine_base_shipment_tax:m ppe_fee:m ppe_fee_tax:m total_order:m"
               " base_total_gift_cards:m billing_state:s billing_country:s")


@query("parse_order_capture", HEADER_SPEC)
def _(t):
    return ingest.parse_order_capture(t.queue("oc"))


ITEM_SPEC = ("order_id:n item_id:n parent_item_id:s product_id:n product_type:s sku:s qty_ordered:n base_price:m price:m"
             " base_tax_amt:m tax_amt:m discount_percent:m base_discount_amt:m discount_amt:m base_row_total:m is_gwp:s message_uuid:s")


@query("explode_order_items", ITEM_SPEC)
def _(t):
    return ingest.explode_order_items(t.queue("oc"))


@query("explode_item_discounts", "order_id:n item_id:n discount_id:n discount_type:s rule_id:n discount_amt:m units_applied:n"
       " base_amt_off_applied:m amt_off_applied:m rule_name:s rule_group:s sponsored_by:s sponsored_percentage:m message_uuid:s")
def _(t):
    return ingest.explode_item_discounts(t.queue("oc"))


PAY_SPEC = ("order_id:n payment_id:s payment_gateway:s cc_type:s base_pay_amt:m pay_amt:m gateway_tran_id:s cc_tran_id:s"
            " cc_last_four:s message_uuid:s")
GIFT_SPEC = "order_id:n gift_card_id:s gift_card_amt:m message_uuid:s"


@query("explode_order_payments", PAY_SPEC)
def _(t):
    return ingest.explode_order_payments(t.queue("oc"))


@query("explode_order_gift_cards", GIFT_SPEC)
def _(t):
    return ingest.explode_order_gift_cards(t.queue("oc"))


@query("explode_order_cash", "order_id:n tc_id:n tc_amt:m message_uuid:s")
def _(t):
    return ingest.explode_order_cash(t.queue("oc"))


@query("parse_membership_capture", "message_uuid:s order_id:n increment_id:n customer_id:n start_status:s membership_type:s"
       " updated_at:t base_total_tax:m total_tax:m total_order:m base_donations:m billing_state:s")
def _(t):
    return ingest.parse_membership_capture(t.queue("mc"))


@query("explode_membership_payments", PAY_SPEC)
def _(t):
    return ingest.explode_membership_payments(t.queue("mc"))


@query("explode_membership_gift_cards", GIFT_SPEC)
def _(t):
    return ingest.explode_membership_gift_cards(t.queue("mc"))


@query("explode_assignments", "message_uuid:s order_id:n customer_id:n item_id:n qty_ordered:n qty_assigned:n qty_short:n fc:n")
def _(t):
    return ingest.explode_assignments(t.queue("oa"))


@query("hold_partial_shipments", "id:n fate:s")
def _(t):
    return fates(*ingest.hold_partial_shipments(t.queue("of"), t("fc_xref")), ("unprocessed", "queue"))


@query("parse_fulfillment", "message_uuid:s order_id:n increment_id:n customer_id:n credit_memo_id:s is_last_shipment:b updated_at:t")
def _(t):
    return ingest.parse_fulfillment(t.queue("of"))


@query("explode_fulfillment_items", "order_id:n increment_id:n customer_id:n item_id:n parent_item_id:n product_id:n product_type:s sku:s"
       " units_shipped:n units_shorted:n fc:s shipment_id:s tracking_id:s message_uuid:s")
def _(t):
    return ingest.explode_fulfillment_items(t.queue("of"), staged(t("capture_items"), 1, "item_id"))


CREDIT_SPEC = ("message_uuid:s credit_id:n credit_increment_id:n order_id:n increment_id:s customer_id:n order_has_shipped:s updated_at:t"
               " base_total_product:m base_total_discount:m base_adjustment:m base_total_tax:m base_donations:m base_shipment:m"
               " base_shipment_tax:m base_frozen_shipment:m base_frozen_shipment_tax:m base_wine_shipment:m base_wine_shipment_tax:m"
               " base_total_gift_cards:m ppe_fee:m ppe_fee_tax:m billing_state:s")


@query("parse_credit_memo", CREDIT_SPEC)
def _(t):
    return ingest.parse_credit_memo(t.queue("cm"))


@query("explode_credit_items", "credit_id:n credit_item_id:n order_id:n order_item_id:n sku:s qty_refunded:n base_price:m base_tax_amt:m"
       " tax_amt:m base_discount_amt:m discount_amt:m message_uuid:s")
def _(t):
    return ingest.explode_credit_items(t.queue("cm"))


@query("credit_refunds", "credit_id:n payment_id:s payment_gateway:s cc_type:s base_pay_amt:m pay_amt:m gateway_tran_id:s cc_tran_id:s message_uuid:s")
def _(t):
    return ingest.credit_refunds(t.queue("cm"))


@query("credit_gift_cards", "credit_id:n gift_card_id:s gift_card_amt:m message_uuid:s")
def _(t):
    return ingest.credit_gift_cards(t.queue("cm"))


@query("credit_cash", "credit_id:n tc_id:n tc_amt:m message_uuid:s")
def _(t):
    return ingest.credit_cash(t.queue("cm"))


@query("queue_commit", "id:n message_type:s fate:s")
def _(t):
    return ingest.commit_fates(t.queue(), known_keys(t))


@query("queue_stream", "id:n message_type:s fate:s")
def _(t):
    from tallyloom.streaming.router import run_once
    return run_once(t.queue(), shared_dir(t.spark, "stream"), t("fc_xref"))


# =========================================================================== P: order and membership postings

@query("fix_zero_charge_discounts", "item_id:n discount_amt:m base_discount_amt:m discount_percent:m price:m")
def _(t):
    return postings.fix_zero_charge_discounts(t("capture_items"), t("capture_payments"))


@query("fix_gift_card_negative_discount", "item_id:n discount_amt:m base_discount_amt:m discount_percent:m product_type:s")
def _(t):
    return postings.fix_gift_card_negative_discount(t("capture_items"))


@query("reclassify_reshipment", "order_id:n order_type:s")
def _(t):
    return postings.reclassify_reshipment(t("capture"), t("capture_payments"))


POST = "tran_type:n tran_sub_type_id:n tran_sub_type:s tran_date:t order_type:s order_id:n increment_id:s customer_id:n tran_amt:m sale_date:d tran_gl_date:d"


@query("post_order_payment", POST + " cc_auth:s cc_last4:s cc_type:s cc_pay_amt:m message_uuid:s")
def _(t):
    return postings.post_order_payment(t("capture"), t("capture_payments"))


@query("post_order_gift_card", POST + " gc_sub_type:s gc_type:n gift_card_id:n")
def _(t):
    return postings.post_order_gift_card(*t.many("capture", "capture_gift_cards", "gift_cards", "gift_cards_legacy"))


for _name in ("product_tax", "shipping_tax", "fee_tax", "donation"):
    query(f"post_{_name}", POST + " message_uuid:s")(
        lambda t, _code=_name: postings.post_order_charges(t("capture"), _code))


@query("load_order_header", HEADER_SPEC + " ods_processed_at:t sale_date:d status:s status_date:t gaap_sale_date:d")
def _(t):
    return postings.load_order_header(t("capture"), AS_OF)


@query("load_order_detail", "order_id:n item_id:n sku:s qty_ordered:n base_price:m sale_date:d fulfillment_qty:n short_qty:n return_qty:n fulfillment_date:t")
def _(t):
    return postings.load_order_detail(t("capture_items"), t("capture"))


@query("load_order_discounts", "order_id:n item_id:n discount_type:s rule_id:n amt_off_applied:m sponsored_by:s sponsored_percentage:m")
def _(t):
    return postings.load_order_discounts(t("capture_discounts"), t("capture"))


@query("load_order_payments", "order_id:n payment_type:s payment_id:s payment_gateway:s gift_card_id:s pay_amt:m sale_date:d message_uuid:s")
def _(t):
    return postings.load_order_payments(*t.many("capture", "capture_payments", "capture_gift_cards", "capture_cash"))


@query("assignment_cost", "item_id:n fc_id:n qty_assigned:n ext_cost_amt:m")
def _(t):
    return postings.assignment_cost(*t.many("assignments", "capture_items", "fc_xref", "curr_items"))


@query("apply_assignment", "item_id:n assignment_fc:n assignment_qty:n ext_cost_amt:m")
def _(t):
    work = postings.assignment_cost(*t.many("assignments", "capture_items", "fc_xref", "curr_items"))
    return postings.apply_assignment(t("capture_items"), work)


@query("post_membership_payment", POST + " cc_auth:s cc_last4:s cc_type:s cc_pay_amt:m message_uuid:s")
def _(t):
    return postings.post_membership_payment(t("membership"), t("membership_payments"))


@query("post_membership_gift_card", POST + " gc_sub_type:s gc_type:n")
def _(t):
    return postings.post_membership_gift_card(t("membership"), t("membership_gift_cards"))


@query("post_membership_tax", POST + " message_uuid:s")
def _(t):
    return postings.post_membership_tax(t("membership"))


@query("load_membership_header", "order_id:n increment_id:n start_status:s total_order:m sale_date:d ods_processed_at:t status:s status_date:t")
def _(t):
    return postings.load_membership_header(t("membership"), AS_OF)


@query("load_membership_payments", "order_id:n payment_type:s payment_id:s gift_card_id:s pay_amt:m sale_date:d")
def _(t):
    return postings.load_membership_payments(*t.many("membership", "membership_payments", "membership_gift_cards"))


def order_cancels(t):
    return postings.cancel_worklist(t("cancels"), t("order_header"))


def member_cancels(t):
    return postings.cancel_worklist(t("cancels"), stored_members(t))


def stored_members(t):
    return postings.load_membership_header(t("membership"), AS_OF)


@query("cancel_worklist", "order_id:n message_uuid:s updated_at:t sale_date:d ms_initiated:b is_fraud:b is_voided:b")
def _(t):
    return order_cancels(t).unionByName(member_cancels(t))


REVERSAL = "tran_type:n tran_sub_type_id:n tran_sub_type:s tran_date:t order_id:n tran_amt:m cc_auth:s message_uuid:s sale_date:d tran_gl_date:d cancel_type:s"


@query("reverse_order_postings", REVERSAL)
def _(t):
    return postings.reverse_order_postings(t("order_ledger"), order_cancels(t), t("sub_types"))


@query("reverse_membership_postings", REVERSAL)
def _(t):
    return postings.reverse_membership_postings(t("membership_ledger"), member_cancels(t), t("sub_types"), t("member_refunds"))


@query("cancel_order_status", "order_id:n status:s status_date:t updated_at:t")
def _(t):
    return postings.cancel_order_status(t("order_header"), order_cancels(t))


@query("cancel_membership_status", "order_id:n status:s status_date:t updated_at:t")
def _(t):
    return postings.cancel_membership_status(stored_members(t), member_cancels(t))


# =========================================================================== F: fulfillment

def fulfil_work(t):
    return fulfillment.fulfillment_worklist(
        *t.many("ship_header", "ship_detail", "order_header", "order_detail", "ship_credits"), AS_OF, CUTOFF)


@query("fulfillment_worklist", "order_id:n credit_id:n tran_date:t sale_date:d")
def _(t):
    return fulfil_work(t)


@query("stage_fulfillment", "order_id:n increment_id:s item_id:n parent_item_id:n fc:n store_fc:n sku:s units_shipped:n qty_ordered:n"
       " units_shorted:n base_price:m base_discount_amt:m base_tax_amt:m base_row_total:m is_last_shipment:b cm_id:n qty_refunded:n"
       " credit_price:m credit_total_amt:m tpa_unit_amt:m tran_date:t sale_date:d fulfilled_at:t shipment_id:s tracking_id:s")
def _(t):
    return fulfillment.stage_fulfillment(
        t("ship_header"), fulfil_work(t),
        *t.many("ship_detail", "order_header", "order_detail", "detail_discounts", "ship_credit_items", "fc_xref"))


@query("retail_price_fallback", "item_id:n sku:s retail_price:m")
def _(t):
    return fulfillment.retail_price_fallback(*t.many("stage", "fc_xref", "curr_items"))


ALLOC = ("item_id:n parent_item_id:n order_id:n bundle_total_amt:m bundle_tax_amt:m bundle_discount_amt:m"
         " alloc_revenue_amt:m alloc_tax_amt:m alloc_discount_amt:m")


@query("allocate_bundle", ALLOC)
def _(t):
    return fulfillment.allocate_bundle(t("stage"))


@query("bundle_out_of_balance", "parent_item_id:n bundle_total_amt:m revenue_amt:m adj_revenue:n tax_amt:m adj_tax:n discount_amt:m adj_discount:n")
def _(t):
    return fulfillment.bundle_out_of_balance(fulfillment.allocate_bundle(t("stage")))


for _name in ("revenue", "tax", "discount"):
    query(f"penny_fix_{_name}", f"item_id:n parent_item_id:n alloc_{_name}_amt:m")(
        lambda t, _m=_name: getattr(fulfillment, f"penny_fix_{_m}")(fulfillment.allocate_bundle(t("stage"))))


def allocated(t):
    return fulfillment.apply_allocation(t("stage"), fulfillment.balanced_bundle(t("stage")))


@query("apply_allocation", "item_id:n parent_item_id:n allocated_price:m allocated_discount_amt:m allocated_tax_amt:m")
def _(t):
    return allocated(t)


@query("allocate_bundle_discounts", "item_id:n parent_item_id:n discount_id:n dsc_amt:m alloc_discount_amt:m rule_id:n discount_type:s")
def _(t):
    return fulfillment.allocate_bundle_discounts(t("stage"), t("detail_discounts"))


@query("discount_out_of_balance", "parent_item_id:n discount_id:n dsc_amt:m dtl_amt:m adj_discount:n")
def _(t):
    return fulfillment.discount_out_of_balance(fulfillment.allocate_bundle_discounts(t("stage"), t("detail_discounts")))


@query("penny_fix_rule_discount", "item_id:n parent_item_id:n discount_id:n alloc_discount_amt:m")
def _(t):
    return fulfillment.penny_fix_rule_discount(fulfillment.allocate_bundle_discounts(t("stage"), t("detail_discounts")))


def bundle_discounts(t):
    return fulfillment.bundle_discount_result(t("stage"), t("detail_discounts"))


@query("bundle_discount_result", "order_id:n item_id:n discount_id:n parent_item_id:n alloc_discount_amt:m rule_id:n rule_name:s rule_group:s discount_type:s")
def _(t):
    return bundle_discounts(t)


# =========================================================================== L: fulfillment postings

LINE = ("tran_type:n tran_sub_type_id:n tran_sub_type:s tran_date:t order_id:n increment_id:s order_line_id:n customer_id:n location_id:n"
        " magento_location_id:n sku:s parent_item_id:n group_id:n category_name:s class_id:n subclass_name:s tran_qty:n sale_date:d"
        " item_id:n tran_gl_date:d ship_date:d tran_amt:m")
RULE = " rule_id:n rule_name:s coupon_rule_name:s coupon_group_code:s"


@query("post_product_revenue", LINE + " tran_cost_amt:m")
def _(t):
    return fulfillment.post_product_revenue(allocated(t), t("fc_xref"), t("curr_items"))


for _name, _kind in (("coupon", "coupon"), ("tpa", "tpa"), ("tiered_pricing", "tiered_pricing")):
    query(f"post_{_name}", LINE + RULE)(
        lambda t, _k=_kind: fulfillment.post_line_discounts(*t.many("stage", "detail_discounts", "fc_xref", "curr_items"), _k))
for _name in ("coupon", "tpa"):
    query(f"post_{_name}_bundle", LINE + RULE)(
        lambda t, _k=_name: fulfillment.post_bundle_discounts(t("stage"), bundle_discounts(t), t("fc_xref"), t("curr_items"), _k))


@query("post_make_good", "tran_type:n tran_sub_type_id:n tran_sub_type:s tran_date:t tran_amt:m gift_card_id:n gc_type:n gc_sub_type:s order_id:n"
       " increment_id:s gc_reason_id:n gc_reason_name:s gc_group_code:s gc_group_name:s sale_date:d tran_gl_date:d")
def _(t):
    return fulfillment.post_make_good(*t.many("order_payments", "stage", "card_history", "gift_cards"), cutoff=CUTOFF)


@query("post_shipment_revenue", "tran_type:n tran_sub_type_id:n tran_sub_type:s tran_date:t order_id:n increment_id:s customer_id:n tran_amt:m sale_date:d tran_gl_date:d")
def _(t):
    return fulfillment.post_shipment_revenue(t("order_header"), t("stage"))


@query("post_cash_discount", "tran_type:n tran_sub_type_id:n tran_sub_type:s tran_date:t order_id:n increment_id:s customer_id:n tran_amt:m sale_date:d tran_gl_date:d")
def _(t):
    return fulfillment.post_cash_discount(t("stage"), t("order_payments"))


@query("update_detail_fulfillment", "item_id:n fulfillment_qty:n short_qty:n fulfillment_date:t ods_updated_at:t")
def _(t):
    return fulfillment.update_detail_fulfillment(t("order_detail"), t("stage"), AS_OF)


@query("update_header_shipped", "order_id:n status:s status_date:t gaap_sale_date:d updated_at:t")
def _(t):
    return fulfillment.update_header_shipped(t("order_header"), t("stage"), AS_OF)


@query("post_gift_card_sale", "tran_type:n tran_sub_type_id:n tran_date:t tran_amt:m tran_full_price:m tran_discount_amt:m gift_card_id:n gc_type:n"
       " order_id:n order_line_id:n increment_id:s sale_date:d tran_gl_date:d")
def _(t):
    return fulfillment.post_gift_card_sale(*t.many("gift_sales", "created_cards", "order_detail", "order_header"))


@query("gift_card_fulfillment_updates", "kind:s key:n value:s")
def _(t):
    detail, header, cards = fulfillment.gift_card_fulfillment_updates(*t.many("gift_sales", "order_detail", "order_header"), AS_OF)
    return R.union_all(
        detail.select(F.lit("detail").alias("kind"), F.col("item_id").alias("key"), F.concat_ws("/", F.col("fulfillment_qty").cast("string"), F.col("ods_updated_at").cast("string")).alias("value")),
        header.select(F.lit("header").alias("kind"), F.col("order_id").alias("key"), F.col("updated_at").cast("string").alias("value")),
        cards.select(F.lit("card").alias("kind"), F.col("card_id").alias("key"), F.concat_ws("/", "order_increment_id", "card_type", "source_uuid").alias("value")))


# =========================================================================== C: credits and card adjustments

def routed(t):
    return credits.credit_worklists(t("credits"), t("order_header"), stored_members(t), t("control"))


@query("credit_worklists", "credit_id:n order_id:n route:s sale_date:d")
def _(t):
    return routed(t)


@query("post_preship_items", "tran_type:n tran_sub_type_id:n tran_date:t order_id:n order_line_id:n increment_id:s tran_qty:n tran_amt:m tran_full_price:m"
       " tran_tax_amt:m tran_discount_amt:m group_id:n class_name:s sku:s item_id:n credit_memo_id:n sale_date:d tran_gl_date:d")
def _(t):
    return credits.post_preship_items(routed(t), *t.many("credit_items", "order_detail", "fc_xref", "curr_items"))


REFUND = ("tran_type:n tran_sub_type_id:n tran_sub_type:s tran_date:t order_id:n customer_id:n increment_id:s tran_amt:m tran_full_price:m"
          " tran_tax_amt:m credit_memo_id:n sale_date:d tran_gl_date:d")
for _name in ("preship", "postship", "membership"):
    query(f"post_{_name}_refund", REFUND + " cc_auth:s cc_type:s refund_reason:s")(
        lambda t, _f=getattr(credits, f"post_{_name}_refund"): _f(routed(t), t("credit_refunds")))
for _name, _func in (("post_preship_gift_card", credits.post_preship_gift_card), ("post_postship_gift_card", credits.post_postship_gift_card),
                     ("post_membership_refund_gift_card", credits.post_membership_refund_gift_card)):
    query(_name, REFUND + " gift_card_id:n gc_reason_id:n gc_reason_name:s gc_group_name:s gc_group_code:s gc_sub_type:s")(
        lambda t, _f=_func: _f(routed(t), t("credit_gift_cards"), t("created_cards")))


@query("new_refund_gift_cards", "card_id:n card_type:n initial_amount:m order_id:n order_increment_id:s created_at:t source_uuid:s")
def _(t):
    return credits.new_refund_gift_cards(routed(t), t("credit_gift_cards"), t("gift_cards"))


@query("load_credit_memo_tables", "table_name:s credit_id:n detail:s")
def _(t):
    tables = credits.load_credit_memo_tables(routed(t), *t.many("credits", "credit_items", "credit_refunds", "credit_gift_cards"))
    detail = {"credit_memo": "increment_id", "credit_memo_items": "order_item_id", "credit_memo_refunds": "payment_id",
              "credit_memo_gift_cards": "gift_card_id"}
    return R.union_all(*[df.select(F.lit(n).alias("table_name"), "credit_id", F.col(detail[n]).cast("string").alias("detail"))
                         for n, df in tables.items()])


@query("post_membership_redemption", "tran_type:n tran_sub_type_id:n tran_date:t customer_id:s tran_amt:m gift_card_id:n gc_reason_id:n gc_group_code:s"
       " tran_gl_date:d start_date:t end_date:t")
def _(t):
    return credits.post_membership_redemption(t("card_moves"))


@query("gift_card_adjustment_enrich", "card_id:n billing_state:s credit_id:n cm_increment_id:n increment_id:s updated_at:t expire_at:t action:s"
       " redeeming_increment_id:s redeeming_cust_id:n purchasing_increment_id:s customer_id:n issue_type:s group_code:s card_delta:m card_amt:m card_type:n")
def _(t):
    return credits.gift_card_adjustment_enrich(*t.many("card_moves", "card_types", "sold_cards", "credited_cards", "order_header", "redeem_orders"))


# =========================================================================== V: vendor funding

@query("rebate_agreement_extract", "rebate_agreement_id:n active_status:s billing_period:s rebate_type:s brand_records_name:s start_date:d percentage:m"
       " item_id:n billing_method_id:n billing_customer_id:n vendor_id:n brand_sku:s brandemail:s")
def _(t):
    return funding.rebate_agreement_extract(t("agreements"), t.erp())


@query("brand_extract", "brand_records_id:n brand_records_name:s billing_method:s vendor_id:n brand_email:s")
def _(t):
    return funding.brand_extract(t.erp())


@query("brand_marketing_extract", "bm_id:n asset_type:s mm_email:s mm_name:s jobtitle:s brand_records_name:s billing_customer_id:n billing_vendor_id:n"
       " companyname:s customer_email:s billing_method:s brandemail:s total_cost:m billing_month_id:s start_date:d vendor_funding_item:s ods_processed_date:t")
def _(t):
    return funding.brand_marketing_extract(t("brand_marketing"), t.erp(), AS_OF)


TERM_SPEC = " rebate_start_date:d rebate_end_date:d rebate_percentage:m rebate_dollar_amount:m rebate_billing_period:s rebate_type:s rebate_calc_type:s rebate_billing_method:n"


@query("rebate_waterfall", "order_line_id:n rebate_start_date:d rebate_end_date:d rebate_percentage:m rebate_dollar_amount:m rebate_billing_period:s"
       " rebate_brand_sku:s rebate_billing_method_id:n")
def _(t):
    rows = fulfillment.with_item(t("stage").withColumnRenamed("item_id", "order_line_id"), t("fc_xref"), t("curr_items")).withColumns(
        {"_erp": F.col("item.item_id"), "_maker": F.col("item.brand_id")})
    return funding.rebate_waterfall(rows, t("agreements"), funding.live_at(AS_OF), "_erp", "_maker", 8)


@query("post_vendor_rebate", LINE + " tran_cost_amt:m rebate_total:m" + TERM_SPEC)
def _(t):
    return funding.post_vendor_rebate(*t.many("stage", "fc_xref", "curr_items", "agreements"), AS_OF)


@query("backfill_rebates", "tran_sub_type_id:n tran_date:t order_line_id:n sku:s tran_qty:n tran_cogs_amt:m tran_amt:m fulfillment_tran_id:n order_id:n customer_id:n tran_gl_date:d magento_location_id:n group_id:n" + TERM_SPEC)
def _(t):
    return funding.backfill_rebates(*t.many("ledger", "fc_xref", "curr_items", "agreements"), START, END)


@query("rebate_cost_comparison", "sku:s quantity:n cogs:m pb_cogs:m fifo_rebate:m pb_rebate:m" + TERM_SPEC)
def _(t):
    return funding.rebate_cost_comparison(*t.many("ledger", "fc_xref", "curr_items", "agreements"), START, END)


@query("cost_adjustment_header", "transaction_id:n trandate:d status:s transaction_type:s create_date:t")
def _(t):
    return funding.cost_adjustment_header(t("adj_headers"), t("adj_lines"), START, END)


@query("cost_adjustment_detail", "transaction_id:n transaction_line_id:n account_id:n amount:m item_id:n location_id:n memo:s date_created:t")
def _(t):
    return funding.cost_adjustment_detail(t("adj_headers"), t("adj_lines"), START, END)


@query("post_cost_adjustment_rebate", "sku:s tran_sub_type_id:n tran_date:t tran_cogs_amt:m item_id:n location_id:n tran_amt:m rebate_total:m ns_tran_id:n" + TERM_SPEC)
def _(t):
    return funding.post_cost_adjustment_rebate(*t.many("adj_lines", "adj_headers", "ledger_adjusted", "fc_xref", "curr_items", "agreements"), AS_OF)


FUND = ("tran_sub_type_id:n tran_sub_type:s order_id:n order_line_id:n parent_item_id:n sku:s tran_qty:n tran_discount_amt:m rule_id:n item_id:n"
        " fulfillment_tran_id:n rebate_percentage:m rebate_billing_method:n rebate_total:m tran_amt:m tran_gl_date:d created_at:t magento_location_id:n group_name:s ship_date:d")
for _name in ("post_tpr_funding", "post_tpr_funding_bundle", "post_as_funding", "post_as_funding_bundle"):
    query(_name, FUND)(lambda t, _f=getattr(funding, _name): _f(*t.many("ledger", "detail_discounts", "fc_xref", "curr_items", "brand_records"), as_of=AS_OF))


@query("post_brand_marketing_fee", "tran_type:n tran_sub_type_id:n tran_sub_type:s tran_date:t created_at:t tran_gl_date:d tran_amt:m brand_marketing_id:n")
def _(t):
    return funding.post_brand_marketing_fee(t("brand_marketing"), t("ledger"))


# =========================================================================== R: reconciliation

@query("check_order_payment", "order_id:n increment_id:s sale_date:d expected_payment:m total_paid:m pay_amt:m gift_card_amt:m tc_amt:m total_order:m"
       " total_product:m product_tax:m ppe_fee:m order_type:s")
def _(t):
    return checks.check_order_payment(*t.many("capture", "capture_items", "capture_payments", "capture_gift_cards", "capture_cash"))


@query("check_membership_payment", "order_id:n increment_id:n sale_date:d expected_payment:m total_paid:m pay_amt:m total_order:m total_product:m product_tax:m"
       " gift_card_amt:m tc_amt:m grocery_base_shipment:m wine_base_shipment_tax:m base_donations:m ppe_fee:m order_type:s")
def _(t):
    return checks.check_membership_payment(t("membership"), t("membership_payments"))


DISC = ("order_id:n increment_id:s item_id:n sale_date:d base_discount_amt:m disc_tpa_amt:m disc_coupon_amt:m disc_tiered_pricing_amt:m"
        " disc_total_amt:m var:m product_type:s error_code:n")
for _name in ("check_discount_detail_over", "check_discount_item_over", "check_negative_discount"):
    query(_name, DISC)(lambda t, _f=getattr(checks, _name): _f(*t.many("capture", "capture_items", "capture_payments", "capture_discounts")))


@query("check_credit_memo", "credit_id:n credit_increment_id:n order_id:n increment_id:s credit_date:d gc_amt:m pay_amt:m calc_refund:m calc_credit:m"
       " base_total_credit:m base_total_refund:m base_total_gift_cards:m base_total_product:m base_total_discount:m base_adjustment:m base_total_tax:m"
       " base_donations:m base_shipment:m base_shipment_tax:m base_frozen_shipment:m base_frozen_shipment_tax:m base_wine_shipment:m"
       " base_wine_shipment_tax:m ppe_fee:m ppe_fee_tax:m")
def _(t):
    return checks.check_credit_memo(*t.many("credits", "credit_refunds", "credit_gift_cards"))


@query("ledger_duplicates", "tran_id:n tran_sub_type:s order_line_id:n tran_amt:m")
def _(t):
    return checks.ledger_duplicates(t("ledger"))


@query("duplicate_profile", "tran_sub_type:s duplicates:n")
def _(t):
    return checks.duplicate_profile(t("ledger"))


@query("ledger_dedupe", "tran_id:n tran_sub_type:s order_line_id:n tran_amt:m tran_gl_date:d")
def _(t):
    return checks.ledger_dedupe(t("ledger"))


@query("header_dedupe", "message_uuid:s order_id:n status:s ods_processed_at:t")
def _(t):
    return checks.header_dedupe(t("header_copies"))


@query("multi_posted_lines", "tran_id:n order_line_id:n tran_gl_date:d tran_amt:m")
def _(t):
    return checks.multi_posted_lines(t("ledger"))


@query("unmatched_brand_audit", "tran_id:n sku:s location_id:n tran_gl_date:d")
def _(t):
    return checks.unmatched_brand_audit(*t.many("ledger", "fc_xref", "curr_items"), START, END)


# =========================================================================== B: reports

@query("revenue_by_state", "order_month:s state:s prodrev:m memrev:m")
def _(t):
    return reports.revenue_by_state(*t.many("ledger", "journal_lines", "order_header", "membership"), START, END)


@query("crm_discounts", "order_id:n increment_id:s sale_date:d tran_gl_date:d coupon_rule_name:s coupon_group_code:s crm_discount:m pdgpr:m tpr:m astpr:m")
def _(t):
    return reports.crm_discounts(*t.many("ledger", "journal_lines", "gl_map", "manual_journals", "manual_lines", "erp_accounts"), START, END)


@query("vendor_funding_journal", "side:s acct:s debit:m credit:m memo:s line_memo:s je_date:d reversal_date:d")
def _(t):
    return reports.vendor_funding_journal(*t.many("ledger", "fc_xref", "curr_items", "brand_records", "brand_marketing"), START, END)


REPORT = ("brand_name:s rebate_billing_method:n sku:s description:s rebate_type:s rebate_billing_period:s rebate_start_date:d rebate_end_date:d"
          " tran_qty:n tran_cogs_amt:m rebate_percentage:m rebate_dollar_amount:m list_item_name:s cust_vend:n")


@query("vendor_rebate_report", REPORT + " tran_amt:m")
def _(t):
    return reports.vendor_rebate_report(*t.many("ledger", "fc_xref", "curr_items", "agreements", "billing_method"), START, END, cost_switch="1998-01-01")


@query("rebate_rollup", REPORT + " rebate_to_bill:m")
def _(t):
    return reports.rebate_rollup(*t.many("ledger", "fc_xref", "curr_items", "agreements", "billing_method"), START, END)


BILL_TABLES = ("ledger", "fc_xref", "curr_items", "agreements", "brand_marketing", "billing_method")


@query("invoice_upload", "tran_sub_type_id:n method:s cust_vend_id:n invoice_number:s month_end_date:d memo:s amount:m item:s line_text:s ns_location:n"
       " sku_info:s discount:m rate:m tran_qty:n")
def _(t):
    return reports.invoice_upload(*t.many(*BILL_TABLES), START, END)


@query("distributor_report", "brand:s invoice_number:s program:s billing_type:s month_end_date:d sku:s invoice_category:s sku_info:s qty:n discount:m"
       " percentage:m amount:m contact:s email:s suppress:s")
def _(t):
    return reports.distributor_report(*t.many(*BILL_TABLES), START, END, contact="billing@store.example")


@query("brand_marketing_report", "tran_gl_date:d brand_records_name:s billing_method:s vend_cust:n vendor_funding_item:s asset_description:s mm_email:s"
       " start_date:d end_date:d billing_month_id:s tran_amt:m")
def _(t):
    return reports.brand_marketing_report(t("ledger"), t("brand_marketing"), START, END)


# =========================================================================== whole pipelines

@query("order_capture_pipeline", "tran_type:n tran_sub_type_id:n tran_sub_type:s order_id:n tran_amt:m tran_gl_date:d cc_type:s gc_sub_type:s")
def _(t):
    staging = shared_dir(t.spark, "order_capture")
    return pipelines.order_capture(t.queue("oc"), *t.many("gift_cards", "gift_cards_legacy"), AS_OF, staging)["ledger"]


@query("fulfillment_pipeline", "tran_sub_type_id:n order_id:n order_line_id:n tran_amt:m tran_gl_date:d")
def _(t):
    staging = shared_dir(t.spark, "fulfillment")
    return pipelines.fulfillment_postings(t("stage"), *t.many("detail_discounts", "fc_xref", "curr_items", "order_header"), staging)


@query("ledger_append", "tran_type:n tran_sub_type_id:n order_id:n tran_amt:m tran_gl_date:d created_at:t")
def _(t):
    """Order charges posted to an empty ledger, then again with nothing new to post; the ledger's rows."""
    folder = shared_dir(t.spark, "ledger_append")
    rows = postings.post_order_charges(t("capture"))
    keys = ["tran_gl_date", "order_id", "tran_sub_type_id", "message_uuid"]
    for run in ("first", "again"):
        ledger.append(rows, f"{folder}/ledger", AS_OF, keys, f"{folder}/{run}")
    return ledger.read(t.spark, f"{folder}/ledger")


RUN = "table_name:s key:n code:n amount:m detail:s"


def tagged(name, df, key, detail, code=None, amount=None):
    """Rows of one result table of a run, under its name."""
    none = F.lit(None)
    return df.select(F.lit(name).alias("table_name"), F.col(key).cast("bigint").alias("key"), (F.col(code) if code else none).cast("bigint").alias("code"),
                     (F.col(amount) if amount else none).cast("decimal(12,2)").alias("amount"), F.col(detail).cast("string").alias("detail"))


@query("membership_run", RUN)
def _(t):
    out = pipelines.membership_run(t.queue("mc"), AS_OF, shared_dir(t.spark, "membership_run"))
    return R.union_all(
        tagged("ledger", out["ledger"], "order_id", "tran_gl_date", "tran_sub_type_id", "tran_amt"),
        tagged("membership_header", out["membership_header"], "order_id", "sale_date", amount="total_order"),
        tagged("membership_payments", out["membership_payments"], "order_id", "payment_type", amount="pay_amt"))


@query("cancel_run", RUN)
def _(t):
    store = {"ledger": R.union_all(t("order_ledger"), t("membership_ledger")), "order_header": t("order_header"), "membership_header": stored_members(t)}
    out = pipelines.cancel_run(t("cancels"), store, t("sub_types"), t("member_refunds"), shared_dir(t.spark, "cancel_run"))
    return R.union_all(
        tagged("ledger", out["ledger"], "order_id", "tran_gl_date", "tran_sub_type_id", "tran_amt"),
        tagged("order_header", out["order_header"], "order_id", "status"),
        tagged("membership_header", out["membership_header"], "order_id", "status"),
        tagged("archive", out["archive"], "order_id", "message_uuid"),
        tagged("waiting", out["waiting"], "order_id", "message_uuid"))


CREDIT_TABLES = {"credit_memo": ("credits", "increment_id"), "credit_memo_items": ("credit_items", "order_item_id"),
                 "credit_memo_refunds": ("credit_refunds", "payment_id"), "credit_memo_gift_cards": ("credit_gift_cards", "gift_card_id")}


@query("credit_memo_run", RUN)
def _(t):
    staged_rows = {name: t(source) for name, (source, _) in CREDIT_TABLES.items()}
    store = {"order_header": t("order_header"), "order_detail": t("order_detail"), "membership_header": stored_members(t),
             "cards": t("gift_cards"), "adjustments": t("created_cards")}
    dims = {"fc_xref": t("fc_xref"), "items": t("curr_items"), "control": t("control")}
    out = pipelines.credit_memo_run(staged_rows, store, dims, AS_OF, shared_dir(t.spark, "credit_memo_run"))
    return R.union_all(
        tagged("ledger", out["ledger"], "credit_memo_id", "tran_gl_date", "tran_sub_type_id", "tran_amt"),
        tagged("gift_cards", out["gift_cards"], "card_id", "order_increment_id", "card_type", "initial_amount"),
        *[tagged(name + part, out[name + part], "credit_id", detail) for name, (_, detail) in CREDIT_TABLES.items() for part in ("", "_processed", "_staging")])
