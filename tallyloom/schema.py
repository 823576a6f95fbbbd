"""Ledger columns and the code book of posting types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Ledger columns and their types.
LEDGER = {
    "tran_id": "bigint", "tran_type": "bigint", "tran_sub_type": "string", "tran_date": "timestamp_ntz",
    "order_type": "string", "order_id": "bigint", "order_line_id": "bigint", "company_id": "bigint",
    "location_id": "bigint", "customer_id": "string", "sku": "string", "parent_item_id": "bigint",
    "product_type": "string", "coupon_code": "string", "group_id": "bigint", "group_name": "string",
    "category_id": "bigint", "category_name": "string", "sub_category_id": "bigint", "sub_category_name": "string",
    "class_id": "bigint", "class_name": "string", "subclass_id": "bigint", "subclass_name": "string",
    "tran_qty": "bigint", "tran_amt": "decimal(12,2)", "tran_full_price": "decimal(12,2)",
    "tran_discount_amt": "decimal(12,2)", "tran_tax_amt": "decimal(12,2)", "billing_country": "string",
    "billing_state": "string", "billing_city": "string", "shipping_country": "string", "shipping_state": "string",
    "shipping_city": "string", "membership_type_id": "bigint", "membership_exp_date": "timestamp_ntz",
    "original_order_id": "string", "credit_memo_id": "string", "membership_start_date": "date",
    "je_batch_id": "bigint", "je_batch_date": "timestamp_ntz", "gift_card_id": "bigint", "item_type": "string",
    "discount_code": "string", "cancel_type": "string", "coupon_rule_name": "string", "membership_id": "bigint",
    "membership_cancel_date": "timestamp_ntz", "cc_auth": "string", "cc_last4": "string", "bank_date": "date",
    "deposit_date": "date", "created_at": "timestamp_ntz", "fee_amt": "decimal(12,2)", "cc_type": "string",
    "cc_recon_date": "timestamp_ntz", "cc_recon_amt": "decimal(12,2)", "cc_pay_amt": "decimal(12,2)",
    "cm_id": "bigint", "gc_id": "bigint", "gc_type": "bigint", "gc_sub_type": "string", "gc_reason_id": "bigint",
    "gc_reason_name": "string", "gc_group_code": "string", "gc_group_name": "string", "increment_id": "string",
    "reason_id": "bigint", "refund_reason": "string", "magento_location_id": "bigint", "coupon_group_code": "string",
    "rule_id": "bigint", "rule_name": "string", "source_uuid": "string", "source_line_num": "bigint",
    "gl_group_override": "string", "tran_cost_amt": "decimal(12,2)", "je_map_id": "bigint", "message_uuid": "string",
    "start_date": "timestamp_ntz", "end_date": "timestamp_ntz", "start_status": "string", "end_status": "string",
    "updated_at": "timestamp_ntz", "sale_date": "date", "item_id": "bigint", "tran_sub_type_id": "bigint",
    "tran_gl_date": "date", "ship_date": "date", "original_tran_id": "bigint", "fc_ship_date": "timestamp",
    "tran_cogs_amt": "decimal(14,4)", "rebate_start_date": "timestamp", "rebate_end_date": "timestamp",
    "rebate_percentage": "double", "rebate_dollar_amount": "double", "rebate_billing_period": "string",
    "rebate_type": "string", "rebate_calc_type": "string", "rebate_billing_method": "string",
    "fulfillment_tran_id": "bigint", "ns_tran_id": "bigint", "brand_marketing_id": "bigint",
    "rebate_total": "decimal(14,4)",
}

# Fixed values: (tran_type, tran_sub_type_id, tran_sub_type) of each posting.
CODES = {
    "order_payment": (100, 6, "Payment Capture"),
    "order_gift_card": (100, 9, "Gift Card Capture"),
    "product_tax": (105, 13, "Tax Capture"),
    "shipping_tax": (105, 28, "Shipping Tax Capture"),
    "fee_tax": (105, 95, "PPE Tax Capture"),
    "donation": (400, 5, "Donation"),
    "membership_payment": (150, 10, "Payment Capture"),
    "membership_gift_card": (150, 21, "Gift Card Capture"),
    "membership_tax": (155, 68, "Tax Capture"),
    "product": (300, 16, "Product"),
    "coupon": (300, 69, "Coupon"),
    "tpa": (300, 48, "TPA"),
    "tiered_pricing": (300, 98, "Tiered Pricing"),
    "make_good": (300, 64, "Make-Good Discount"),
    "grocery_shipment": (300, 17, "Grocery Shipment"),
    "frozen_shipment": (300, 70, "Frozen Shipment"),
    "wine_shipment": (300, 71, "Wine Shipment"),
    "fee_revenue": (300, 96, "PPE Revenue"),
    "vendor_rebate": (300, 111, "Vendor Rebates"),
    "brand_marketing": (300, 112, "Brand Marketing Fees"),
    "tpr_funding": (300, 113, "TPR Vendor Funding"),
    "as_funding": (300, 114, "A&S Vendor Funding"),
    "preship_product": (365, 82, "Product"),
    "membership_redemption": (500, 94, "Membership Redemption"),
}


# Ledger column and item-master column of the product hierarchy.
HIERARCHY = {
    "group_id": "group_id", "group_name": "group_name", "category_id": "item_category_id",
    "category_name": "item_category_name", "sub_category_id": "subcategory_id",
    "sub_category_name": "subcategory_name", "class_id": "class_id", "class_name": "class_name",
    "subclass_id": "subclass_id", "subclass_name": "subclass_name",
}


def coded(code: str):
    """The three code columns of a posting."""
    t, s, name = CODES[code]
    return [F.lit(t).alias("tran_type"), F.lit(s).alias("tran_sub_type_id"), F.lit(name).alias("tran_sub_type")]


def to_ledger(rows: DataFrame) -> DataFrame:
    """Postings widened to the whole ledger, absent columns NULL."""
    have = set(rows.columns)
    return rows.select(*[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in LEDGER.items()])
