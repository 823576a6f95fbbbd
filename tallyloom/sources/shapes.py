"""Reference-shaped input tables derived from the driver's parquet tables.

Each shape is a projection over one driver table or one other shape, written in
the SQL both Spark and DuckDB accept (integer ``%``, CASE, decimal casts, day and
hour arithmetic).  ``lines`` expands a row into ``n`` rows carrying a line number.
No shape joins, sorts or groups, so each stays a narrow map over its scan: nothing
shuffles, no key can become hot here, and column pruning reaches the parquet read.

``table(spark, sf_dir, name)`` gives a DataFrame, ``cte(name)`` the DuckDB text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.wire import CASH, ZERO_CHARGE

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@dataclass(frozen=True)
class Shape:
    base: str = ""
    cols: dict | None = None
    where: str | None = None
    lines: tuple | None = None  # (line column, row count expression)
    keep: bool = False  # keep the base's columns beside the new ones
    union: tuple = ()


SHAPES: dict[str, Shape] = {}


def shape(name, base, cols, where=None, lines=None, keep=False):
    SHAPES[name] = Shape(base, cols, where, lines, keep)


def union(name, *members):
    SHAPES[name] = Shape(union=members)


def cents(expr, p=12, s=4):
    return f"CAST(({expr}) * 0.01 AS DECIMAL({p},{s}))"


def days(start, n):
    return f"DATE '{start}' + CAST({n} AS INT)"


def hours(ts, n):
    return f"{ts} + ({n}) * INTERVAL '1' HOUR"


def text(expr):
    return f"CAST({expr} AS STRING)"


# --------------------------------------------------------------------------- orders and capture messages
shape("orders_x", "orders", {
    "k": "o_orderkey",
    "custkey": "o_custkey",
    "priority": "o_orderpriority",
    "created_at": hours("o_orderdate", "o_orderkey % 24"),
    "n": "o_orderkey % 4 + 1",
    "tri": "CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 6 ELSE 10 END",
    "qty": "o_orderkey % 3 + 1",
    "gro_c": "CASE o_orderkey % 3 WHEN 0 THEN 595 WHEN 1 THEN 0 END",
    "grot_c": "CASE o_orderkey % 3 WHEN 0 THEN 48 WHEN 1 THEN 0 END",
    "fro_c": "CASE o_orderkey % 7 WHEN 0 THEN 1200 WHEN 1 THEN 0 END",
    "frot_c": "CASE o_orderkey % 7 WHEN 0 THEN 96 END",
    "wine_c": "CASE WHEN o_orderkey % 17 = 0 THEN 950 END",
    "winet_c": "CASE WHEN o_orderkey % 17 = 0 THEN 76 ELSE 0 END",
    "don_c": "CASE o_orderkey % 19 WHEN 0 THEN 200 WHEN 1 THEN 0 END",
    "ppe_c": "CASE o_orderkey % 11 WHEN 0 THEN 150 WHEN 1 THEN 0 END",
    "ppet_c": "CASE o_orderkey % 11 WHEN 0 THEN 12 WHEN 1 THEN 0 END",
    "shipt_c": "CASE WHEN o_orderkey % 13 = 0 THEN 25 END",
})
shape("orders_y", "orders_x", {
    "prod_c": "qty * (n * (199 + k * 31 % 5000) + 17 * tri)",
    "tax_c": "CASE WHEN k % 31 = 0 THEN 0 ELSE n * (k % 90) + tri END",
    "inc": "CASE WHEN k % 10 = 0 THEN CAST(k AS STRING) ELSE CAST(100000000 + k AS STRING) END || '-1'",
    "state": "'S' || CAST(custkey % 50 AS STRING)",
}, keep=True)
shape("orders_z", "orders_y", {
    "expected_c": "prod_c + tax_c + coalesce(gro_c, 0) + coalesce(grot_c, 0) + coalesce(fro_c, 0) + coalesce(frot_c, 0)"
                  " + coalesce(wine_c, 0) + winet_c + coalesce(don_c, 0) + coalesce(ppe_c, 0) + coalesce(ppet_c, 0)",
    "alltax_c": "tax_c + coalesce(grot_c, 0) + coalesce(frot_c, 0) + winet_c + coalesce(ppet_c, 0) + coalesce(shipt_c, 0)",
    "gift_c": "CASE WHEN k % 3 = 1 THEN 1000 ELSE 0 END",
    "cash_c": "CASE WHEN k % 3 = 2 THEN 500 ELSE 0 END",
    "off_c": "CASE k % 50 WHEN 7 THEN 1 WHEN 9 THEN -125 ELSE 0 END",
}, keep=True)

shape("capture", "orders_z", {
    "message_type": "'oc'",
    "message_uuid": "'oc-' || CAST(k AS STRING)",
    "order_id": "k",
    "increment_id": "inc",
    "order_type": "'order'",
    "customer_id": "custkey",
    "is_autoship": "CASE WHEN k % 4 = 0 THEN 'true' ELSE 'false' END",
    "created_at": "created_at",
    "updated_at": hours("created_at", "1"),
    "base_currency_code": "'USD'",
    "base_total_order": cents("expected_c + coalesce(shipt_c, 0)", 10),
    "base_total_product": cents("prod_c", 10),
    "base_total_discount": cents("k % 700", 10),
    "base_total_tax": cents("alltax_c", 10),
    "base_donations": cents("don_c", 10),
    "base_shipment": cents("coalesce(gro_c, 0) + coalesce(fro_c, 0)", 10),
    "base_shipment_tax": cents("shipt_c", 10),
    "grocery_base_shipment": cents("gro_c", 10),
    "grocery_base_shipment_tax": cents("grot_c", 10),
    "frozen_base_shipment": cents("fro_c", 10),
    "frozen_base_shipment_tax": cents("frot_c", 10),
    "wine_base_shipment": cents("wine_c", 10),
    "wine_base_shipment_tax": cents("winet_c", 10),
    "ppe_fee": cents("ppe_c", 10),
    "ppe_fee_tax": cents("ppet_c", 10),
    "total_order": cents("expected_c", 10),
    "base_total_gift_cards": cents("gift_c", 10),
    "billing_state": "state",
    "billing_country": "'US'",
})
shape("capture_line", "orders_z", {
    "i": "i",
    "m": "CAST((k + i) % 3 AS BIGINT)",
    "unit_disc_c": "CASE WHEN (k + i) % 3 = 0 THEN 0 ELSE 5 * ((k * 3 + i) % 7) END",
}, lines=("i", "n"), keep=True)
shape("capture_items", "capture_line", {
    "order_id": "k",
    "item_id": "k * 8 + i",
    "parent_item_id": "CASE WHEN k % 5 = 0 AND n >= 3 AND i > 1 THEN CAST(k * 8 + 1 AS STRING) ELSE '0' END",
    "product_id": "k * 7 % 997 + i",
    "product_type": "CASE WHEN k % 5 = 0 AND n >= 3 AND i = 1 THEN 'bundle'"
                    " WHEN (k + i) % 29 = 0 THEN 'aw_giftcard' ELSE 'simple' END",
    "sku": text("(k * 7 + i * 13) % 2000"),
    "qty_ordered": "qty",
    "base_price": cents("199 + k * 31 % 5000 + i * 17"),
    "price": cents("CASE WHEN k % 41 = 0 AND i = 1 THEN 0 ELSE 199 + k * 31 % 5000 + i * 17 END"),
    "base_tax_amt": cents("CASE WHEN k % 31 = 0 THEN 0 ELSE k % 90 + i END"),
    "tax_amt": cents("CASE WHEN k % 31 = 0 THEN 0 ELSE k % 90 + i END"),
    "discount_percent": cents("unit_disc_c * 10"),
    "base_discount_amt": cents("CASE WHEN k % 61 = 3 THEN -25 ELSE unit_disc_c END"),
    "discount_amt": cents("CASE WHEN (k + i) % 29 = 0 AND k % 2 = 0 THEN -100 ELSE unit_disc_c END"),
    "base_row_total": cents("qty * (199 + k * 31 % 5000 + i * 17)", 12, 2),
    "is_gwp": "CASE WHEN (k + i) % 37 = 0 THEN 'true' ELSE 'false' END",
    "message_uuid": "'oc-' || CAST(k AS STRING)",
})
DISCOUNT_C = ("CASE WHEN m = 1 THEN qty * unit_disc_c WHEN j = 1 THEN qty * unit_disc_c - 10 ELSE 10 END"
              " + CASE WHEN j > 1 THEN 0 WHEN k % 50 = 11 THEN 150 WHEN k % 50 = 13 THEN -150"
              " WHEN k % 50 = 17 THEN 50 WHEN k % 50 = 19 THEN -50 ELSE 0 END")
shape("capture_discounts", "capture_line", {
    "order_id": "k",
    "item_id": "k * 8 + i",
    "position": "j",
    "discount_type": "CASE (k + i + j) % 3 WHEN 0 THEN 'tpa' WHEN 1 THEN 'coupon' ELSE 'tiered_pricing' END",
    "rule_id": "100 + (k + j) % 13",
    "discount_amt": cents("unit_disc_c"),
    "units_applied": "qty",
    "base_amt_off_applied": cents(DISCOUNT_C),
    "amt_off_applied": cents(DISCOUNT_C),
    "rule_name": "CASE WHEN (k + j) % 7 = 0 THEN 'A&S ' ELSE 'TPR ' END || CAST((k + j) % 13 AS STRING)",
    "rule_group": "'grp' || CAST(k % 5 AS STRING)",
    "sponsored_by": "CASE (k + i) % 5 WHEN 0 THEN 'Brand' WHEN 1 THEN 'Both' WHEN 2 THEN 'Store' END",
    "sponsored_percentage": "CAST(CASE k % 4 WHEN 0 THEN 10 WHEN 1 THEN 25 WHEN 2 THEN 50 ELSE 100 END AS DOUBLE)",
    "message_uuid": "'oc-' || CAST(k AS STRING)",
}, lines=("j", "m"))
GATEWAY = f"CASE WHEN k % 41 = 0 THEN '{ZERO_CHARGE}' WHEN k % 2 = 0 THEN 'braintree' ELSE 'paypal' END"
CC_TYPE = "CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN 'VISA' END"
shape("capture_payments", "orders_z", {
    "order_id": "k",
    "payment_id": "'p' || CAST(k AS STRING)",
    "payment_gateway": GATEWAY,
    "cc_type": CC_TYPE,
    "base_pay_amt": cents("expected_c + off_c - gift_c - cash_c", 12, 2),
    "pay_amt": cents("expected_c + off_c - gift_c - cash_c", 12, 2),
    "gateway_tran_id": "'g' || CAST(k AS STRING)",
    "cc_tran_id": "'t' || CAST(k AS STRING)",
    "cc_last_four": text("1000 + k % 9000"),
    "message_uuid": "'oc-' || CAST(k AS STRING)",
}, where="k % 29 <> 0")
shape("capture_gift_cards", "orders_z", {
    "order_id": "k",
    "gift_card_id": "CAST(custkey AS STRING)",
    "gift_card_amt": cents("gift_c", 12, 2),
    "message_uuid": "'oc-' || CAST(k AS STRING)",
}, where="gift_c > 0")
shape("capture_cash", "orders_z", {
    "order_id": "k",
    "tc_amt": cents("cash_c", 12, 2),
    "message_uuid": "'oc-' || CAST(k AS STRING)",
}, where="cash_c > 0")

# --------------------------------------------------------------------------- membership, cancel, assignment
shape("membership", "orders_z", {
    "message_uuid": "'mc-' || CAST(k AS STRING)",
    "order_id": "5000000000 + k",
    "increment_id": "700000000 + k",
    "customer_id": "custkey",
    "start_status": "CASE k % 4 WHEN 0 THEN 'member' WHEN 1 THEN 'canceled' WHEN 2 THEN 'new' END",
    "membership_type": "CASE WHEN k % 2 = 0 THEN 'annual' ELSE 'monthly' END",
    "updated_at": "created_at",
    "base_total_tax": cents("CASE WHEN k % 4 = 0 THEN 0 WHEN k % 4 = 1 THEN NULL ELSE 495 END", 10),
    "total_tax": cents("CASE WHEN k % 4 = 0 THEN 0 WHEN k % 4 = 1 THEN NULL ELSE 495 END", 10),
    "total_order": cents("CASE WHEN k % 43 = 0 THEN NULL ELSE 5995 + k % 3 * 100 END", 10),
    "base_donations": cents("k % 5", 10),
    "billing_state": "state",
}, where="priority = '1-URGENT'")
shape("membership_payments", "orders_z", {
    "order_id": "5000000000 + k",
    "payment_id": "'mp' || CAST(k AS STRING)",
    "payment_gateway": "'braintree'",
    "cc_type": CC_TYPE,
    "base_pay_amt": cents("5995 + k % 3 * 100 + off_c"),
    "pay_amt": cents("5995 + k % 3 * 100 + off_c"),
    "cc_tran_id": "'mt' || CAST(k AS STRING)",
    "cc_last_four": text("1000 + k % 9000"),
    "gateway_tran_id": "'mg' || CAST(k AS STRING)",
    "message_uuid": "'mc-' || CAST(k AS STRING)",
}, where="priority = '1-URGENT' AND k % 29 <> 0")
shape("membership_gift_cards", "orders_z", {
    "order_id": "5000000000 + k",
    "gift_card_id": "CAST(custkey AS STRING)",
    "gift_card_amt": cents("1500 + k % 100"),
    "message_uuid": "'mc-' || CAST(k AS STRING)",
}, where="priority = '1-URGENT' AND k % 3 = 1")
CANCEL = {
    "message_uuid": "'ocn-' || CAST(k AS STRING)",
    "increment_id": "inc",
    "customer_id": "custkey",
    "updated_at": hours("created_at", "5"),
    "total_order": cents("expected_c", 10),
    "refunds": "CASE WHEN k % 4 = 0 THEN '{\"payment_detail\":{\"voided\":true}}'"
               " WHEN k % 4 = 1 THEN '{\"payment_detail\":{\"voided\":false}}'"
               " WHEN k % 4 = 2 THEN '{\"payment_detail\":{}}' END",
    "ms_initiated": "CASE k % 3 WHEN 0 THEN true WHEN 1 THEN false END",
    "is_fraud": "CASE WHEN k % 9 = 0 THEN true END",
}
shape("cancel_orders", "orders_z", {"order_id": "k", **CANCEL}, where="k % 6 <> 1")
shape("cancel_members", "orders_z", {"order_id": "5000000000 + k", **CANCEL},
      where="priority = '1-URGENT' AND k % 6 = 1 OR priority = '1-URGENT' AND k % 4 = 0")
union("cancels", "cancel_orders", "cancel_members")
shape("assignment_line", "orders_z", {
    "order_id": "k",
    "increment_id": "100000000 + k",
    "item_id": "k * 8 + i",
    "i": "i",
    "qty_ordered": "qty",
}, lines=("i", "n"), keep=True)
shape("assignments", "assignment_line", {
    "message_uuid": "'oa-' || CAST(k AS STRING)",
    "order_id": "k",
    "customer_id": "custkey",
    "item_id": "k * 8 + i",
    "qty_ordered": "qty",
    "qty_assigned": "CASE WHEN a = 1 THEN qty ELSE k % 2 END",
    "qty_short": "qty - CASE WHEN a = 1 THEN qty ELSE k % 2 END",
    "fc": "100 + (k + a) % 6",
}, lines=("a", "(k + i) % 2 + 1"))

# --------------------------------------------------------------------------- store tables fed by capture
shape("order_header", "orders_z", {
    "message_uuid": "'oc-' || CAST(k AS STRING)",
    "order_id": "k",
    "increment_id": "inc",
    "customer_id": "custkey",
    "created_at": "created_at",
    "sale_date": "CAST(created_at AS DATE)",
    "status": "CASE k % 25 WHEN 5 THEN 'cancel' WHEN 6 THEN 'shipped' ELSE 'open' END",
    "gaap_sale_date": "CASE WHEN k % 25 = 6 THEN CAST(created_at AS DATE) END",
    "status_date": hours("created_at", "k % 25"),
    "grocery_base_shipment": cents("gro_c", 10),
    "frozen_base_shipment": cents("fro_c", 10),
    "wine_base_shipment": cents("wine_c", 10),
    "ppe_fee": cents("ppe_c", 10),
    "billing_state": "state",
    "ods_processed_at": hours("created_at", "9"),
    "updated_at": "CASE WHEN k % 3 <> 0 THEN " + hours("created_at", "10") + " END",
})
shape("header_copies", "orders_z", {
    "message_uuid": "'oc-' || CAST(k AS STRING)",
    "order_id": "k",
    "status": "CASE WHEN c = 1 THEN 'open' ELSE 'again' END",
    "ods_processed_at": hours("created_at", "9 + c"),
}, lines=("c", "CASE WHEN k % 20 = 0 THEN 3 ELSE 1 END"))
shape("gift_cards", "customer", {
    "card_id": "c_custkey",
    "issue_type": "CASE c_custkey % 4 WHEN 0 THEN 'other' WHEN 1 THEN 'purchased' WHEN 2 THEN 'make-good' END",
    "reason_id": "c_custkey % 7",
    "reason": "'card reason ' || CAST(c_custkey % 7 AS STRING)",
    "group_code": "CAST(c_custkey % 3 AS STRING)",
    "group_name": "'card group ' || CAST(c_custkey % 3 AS STRING)",
}, where="c_custkey % 3 <> 0")
shape("gift_cards_legacy", "customer", {
    "giftcard_id": "c_custkey",
    "issue_type": "CASE WHEN c_custkey % 2 = 0 THEN 'refund' ELSE 'other' END",
}, where="c_custkey % 2 = 0 OR c_custkey % 9 = 3")
shape("order_ledger", "orders_z", {
    "tran_id": "k * 8 + j",
    "tran_type": "CASE j WHEN 1 THEN 100 WHEN 2 THEN 105 WHEN 3 THEN 400 ELSE 300 END",
    "tran_sub_type_id": "CASE j WHEN 1 THEN 6 WHEN 2 THEN 13 WHEN 3 THEN 5 ELSE 16 END",
    "tran_sub_type": "CASE j WHEN 1 THEN 'Payment Capture' WHEN 2 THEN 'Tax Capture' WHEN 3 THEN 'Donation' ELSE 'Product' END",
    "order_type": "'order'",
    "order_id": "k",
    "increment_id": "inc",
    "customer_id": "custkey",
    "tran_amt": cents("expected_c + j", 12, 2),
    "cc_auth": "CASE WHEN j = 1 THEN 't' || CAST(k AS STRING) END",
    "cc_type": "CASE WHEN j = 1 THEN 'VISA' END",
}, lines=("j", "CAST(4 AS BIGINT)"))
shape("membership_ledger", "orders_z", {
    "tran_id": "5000000000 * 8 + k * 8 + j",
    "tran_type": "CASE j WHEN 1 THEN 150 ELSE 155 END",
    "tran_sub_type_id": "CASE j WHEN 1 THEN 10 ELSE 68 END",
    "tran_sub_type": "CASE j WHEN 1 THEN 'Payment Capture' ELSE 'Tax Capture' END",
    "order_type": "'Renewal'",
    "order_id": "5000000000 + k",
    "increment_id": "CAST(700000000 + k AS STRING)",
    "customer_id": "custkey",
    "tran_amt": cents("CASE WHEN j = 1 THEN 5995 + k % 3 * 100 ELSE 495 END", 12, 2),
    "cc_auth": "'mt' || CAST(k AS STRING)",
    "cc_type": "'VISA'",
}, where="priority = '1-URGENT'", lines=("j", "CAST(2 AS BIGINT)"))
shape("member_refunds", "orders_z", {
    "order_id": "5000000000 + k",
    "base_pay_amt": cents("CASE WHEN k % 8 = 0 THEN 5995 + k % 3 * 100 ELSE 100 END", 10),
    "gateway_tran_id": "'mr' || CAST(k AS STRING)",
}, where="priority = '1-URGENT' AND k % 2 = 0")
shape("sub_types", "nation", {
    "tran_type": "CASE n_nationkey WHEN 0 THEN 110 WHEN 1 THEN 115 WHEN 2 THEN 410 WHEN 3 THEN 160 ELSE 165 END",
    "tran_sub_type_id": "40 + n_nationkey",
    "tran_sub_type": "CASE n_nationkey WHEN 0 THEN 'Payment Capture' WHEN 1 THEN 'Tax Capture' WHEN 2 THEN 'Donation'"
                     " WHEN 3 THEN 'Payment Capture' ELSE 'Tax Capture' END || ' Cancel'",
}, where="n_nationkey < 5 AND n_nationkey <> 2")

# --------------------------------------------------------------------------- dimensions
shape("fc_xref", "region", {
    "fc_id": "r_regionkey + 1",
    "ns_fc_id": "100 + r_regionkey",
    "ods_fc_id": "CASE WHEN r_regionkey = 4 THEN NULL ELSE r_regionkey % 3 + 1 END",
    "is_hj": "r_regionkey = 1",
    "fc_type": "CASE r_regionkey WHEN 3 THEN 'drinks' WHEN 2 THEN 'frozen' ELSE 'dry' END",
})
shape("part_x", "part", {
    "brand_id": "CAST(replace(p_brand, 'Brand#', '') AS BIGINT)",
    "retail_c": "CAST(round(p_retailprice * 100) AS BIGINT) % 4000 + 199",
}, keep=True)
shape("curr_items", "part_x", {
    "item_id": "500000 + p_partkey",
    "item_name": text("p_partkey"),
    "fc_id": "f",
    "retail_price": cents("CASE p_partkey % 6 WHEN 0 THEN NULL WHEN 5 THEN 0 ELSE retail_c + f * 3 END"),
    "net_unit_cost": "CAST(CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE retail_c * 0.006 END AS DECIMAL(12,4))",
    "brand_id": "brand_id",
    "brand_name": "p_brand",
    "vendor_type": "CASE p_partkey % 8 WHEN 0 THEN 'Private Label' WHEN 1 THEN NULL ELSE 'National' END",
    "description": "p_name",
    "group_id": "CAST(p_size % 10 AS BIGINT)",
    "group_name": "p_type",
    "item_category_id": "CAST(p_size AS BIGINT)",
    "item_category_name": "'cat ' || CAST(p_size AS STRING)",
    "subcategory_id": "p_partkey % 50",
    "subcategory_name": "'sub ' || CAST(p_partkey % 50 AS STRING)",
    "class_id": "p_partkey % 70",
    "class_name": "'class ' || CAST(p_partkey % 70 AS STRING)",
    "subclass_id": "p_partkey % 90",
    "subclass_name": "'subclass ' || CAST(p_partkey % 90 AS STRING)",
}, where="(p_partkey + f) % 7 <> 0", lines=("f", "CAST(3 AS BIGINT)"))
shape("brand_records", "nation", {
    "brand_records_id": "CAST(n_nationkey + 1 AS BIGINT)",
    "brand_records_name": "'Brand#' || CAST(n_nationkey + 1 AS STRING)",
    "billing_method_id": "CAST(CASE WHEN n_nationkey % 5 = 4 THEN NULL ELSE n_nationkey % 4 + 1 END AS BIGINT)",
    "billing_customer_id": "CAST(CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_nationkey END AS BIGINT)",
    "category_manager_id": "CAST(n_nationkey % 6 AS BIGINT)",
})
shape("item_agreements", "part_x", {
    "rebate_agreement_id": "p_partkey * 2 + 1",
    "active_status_id": "CASE p_partkey / 10 % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 8 END",
    "billing_period_id": "p_partkey % 3 + 1",
    "billing_period": "CASE WHEN p_partkey % 20 = 0 THEN 'Monthly' ELSE 'Quarterly' END",
    "brand_id": "brand_id",
    "brand_records_name": "p_brand",
    "start_date": days("1995-03-01", "p_partkey % 900"),
    "end_date": f"CASE WHEN p_partkey % 70 = 0 THEN NULL ELSE {days('1999-09-01', 'p_partkey % 700')} END",
    "dollar_amount": cents("CASE WHEN p_partkey % 40 = 0 THEN 25 WHEN p_partkey % 60 = 0 THEN 10 END"),
    "percentage": cents("CASE WHEN p_partkey % 40 = 0 THEN NULL ELSE p_partkey % 17 * 100 + 50 END"),
    "item_id": "500000 + p_partkey",
    "billing_method_id": "p_partkey % 4 + 1",
    "billing_customer_id": "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_partkey % 1000 END",
    "vendor_id": "2000 + brand_id",
    "brand_sku": "'By SKU'",
    "type_id": "CASE WHEN p_partkey % 90 = 0 THEN 2 ELSE 1 END",
    "brandemail": "'sku' || CAST(p_partkey % 10 AS STRING) || '@brand.example'",
}, where="p_partkey % 10 = 0")
shape("brand_agreements", "nation", {
    "rebate_agreement_id": "CAST(n_nationkey * 2 + 2 AS BIGINT)",
    "active_status_id": "CASE n_nationkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 8 END",
    "billing_period_id": "CAST(n_nationkey % 3 + 1 AS BIGINT)",
    "billing_period": "'Annual'",
    "brand_id": "CAST(n_nationkey + 1 AS BIGINT)",
    "brand_records_name": "'Brand#' || CAST(n_nationkey + 1 AS STRING)",
    "start_date": days("1995-02-01", "n_nationkey * 20"),
    "end_date": days("2000-01-01", "n_nationkey * 10"),
    "dollar_amount": cents("CASE WHEN n_nationkey % 7 = 0 THEN 15 END"),
    "percentage": cents("CASE WHEN n_nationkey % 7 = 0 THEN NULL ELSE 300 + n_nationkey * 10 END"),
    "item_id": "CAST(NULL AS BIGINT)",
    "billing_method_id": "CAST(n_nationkey % 4 + 1 AS BIGINT)",
    "billing_customer_id": "CAST(CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_nationkey END AS BIGINT)",
    "vendor_id": "CAST(2001 + n_nationkey AS BIGINT)",
    "brand_sku": "'By Brand'",
    "type_id": "CASE WHEN n_nationkey % 11 = 0 THEN 2 ELSE 1 END",
    "brandemail": "'brand' || CAST(n_nationkey AS STRING) || '@brand.example'",
}, where="n_nationkey <> 24")
union("agreements", "item_agreements", "brand_agreements")
shape("brand_marketing", "part_x", {
    "bm_id": "p_partkey",
    "brand_id": "brand_id",
    "start_date": f"CASE WHEN p_partkey % 60 = 0 THEN NULL ELSE {days('1996-01-01', 'p_partkey % 1500')} END",
    "end_date": days("1998-01-01", "p_partkey % 1500"),
    "total_cost": cents("10000 + p_partkey % 700 * 100", 12, 2),
    "vendor_funding_item": "CASE p_partkey % 3 WHEN 0 THEN 'Reviews' WHEN 1 THEN 'Display' ELSE 'Review Incentives' END",
    "asset_type_id": "p_partkey % 5",
    "asset_description": "'asset ' || CAST(p_partkey % 40 AS STRING)",
    "billing_month_id": "CAST(p_partkey % 12 + 1 AS STRING)",
    "billing_method": "CASE p_partkey / 20 % 4 WHEN 0 THEN 'AP Credit' WHEN 1 THEN 'AR Invoice' WHEN 2 THEN 'UNFI Bill' END",
    "billing_customer_id": "CASE WHEN p_partkey % 80 = 0 THEN NULL ELSE p_partkey % 900 END",
    "billing_vendor_id": "2000 + brand_id",
    "brand_records_name": "p_brand",
    "merch_marketing_contact_id": "p_partkey % 15",
    "mm_email": "'mm' || CAST(p_partkey % 15 AS STRING) || '@store.example'",
    "brandemail": "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'bm@brand.example' END",
    "ods_processed_date": days("1996-02-01", "p_partkey % 1500"),
}, where="p_partkey % 20 = 0")
shape("billing_method", "region", {
    "list_id": "CAST(r_regionkey + 1 AS BIGINT)",
    "list_item_name": "CASE r_regionkey WHEN 0 THEN 'AP Credit' WHEN 1 THEN 'AR Invoice' WHEN 2 THEN 'UNFI Bill' ELSE 'Other' END",
})

# --------------------------------------------------------------------------- lines, details, discounts
shape("line_x", "lineitem", {
    "k": "l_orderkey",
    "pk": "l_partkey",
    "line_id": "(l_orderkey * 8 + l_linenumber) * 65536 + (l_partkey * 521 + l_suppkey) % 65536",
    "parent_id": "CASE WHEN l_orderkey % 5 = 0 THEN l_orderkey * 8 * 65536 END",
    "qty": "CAST(l_quantity AS BIGINT)",
    "short": "CASE WHEN l_partkey % 11 = 0 THEN 1 ELSE 0 END",
    "price_c": "CAST(floor(l_extendedprice * 100 / l_quantity) AS BIGINT)",
    "disc_c": "CAST(round(l_discount * 100) AS BIGINT) * 7",
    "taxl_c": "CAST(round(l_tax * 100) AS BIGINT) * 13",
    "flag": "l_returnflag",
    "shipped": "l_linestatus = 'F'",
    "ship_at": hours("l_shipdate", "l_partkey % 24"),
    "inc": "CASE WHEN l_orderkey % 10 = 0 THEN CAST(l_orderkey AS STRING) ELSE CAST(100000000 + l_orderkey AS STRING) END || '-1'",
})
shape("line_details", "line_x", {
    "order_id": "k",
    "item_id": "line_id",
    "parent_item_id": "parent_id",
    "product_type": "CASE WHEN pk % 29 = 0 THEN 'aw_giftcard' ELSE 'simple' END",
    "sku": text("pk"),
    "qty_ordered": "qty",
    "base_original_price": cents("price_c + 100"),
    "base_price": cents("price_c"),
    "base_discount_amt": cents("CASE WHEN pk % 19 = 0 THEN NULL ELSE disc_c END"),
    "base_tax_amt": cents("taxl_c"),
    "base_row_total": cents("qty * price_c", 14, 2),
    "is_gwp": "CASE WHEN pk % 23 = 0 THEN true WHEN pk % 23 = 1 THEN NULL ELSE false END",
    "sale_date": days("1995-06-01", "k % 2000"),
    "fulfillment_qty": "CASE WHEN pk % 47 = 0 THEN 1 WHEN pk % 2 = 0 THEN 0 END",
    "short_qty": "CASE WHEN pk % 53 = 0 THEN 1 ELSE 0 END",
    "fulfillment_date": "CASE WHEN pk % 47 = 0 THEN ship_at END",
    "assignment_fc": "CASE WHEN pk % 5 = 0 THEN NULL ELSE 100 + pk % 6 END",
})
shape("parent_details", "orders_x", {
    "order_id": "k",
    "item_id": "k * 8 * 65536",
    "parent_item_id": "CAST(NULL AS BIGINT)",
    "product_type": "'bundle'",
    "sku": "'bundle' || CAST(k % 100 AS STRING)",
    "qty_ordered": "k % 4",
    "base_original_price": cents("2000 + k * 37 % 9000"),
    "base_price": cents("CASE WHEN k % 35 = 0 THEN 0 ELSE 1000 + k * 37 % 9000 END"),
    "base_discount_amt": cents("k % 200"),
    "base_tax_amt": cents("k % 170"),
    "base_row_total": cents("k % 4 * (1000 + k * 37 % 9000)", 14, 2),
    "is_gwp": "false",
    "sale_date": days("1995-06-01", "k % 2000"),
    "fulfillment_qty": "CAST(NULL AS INT)",
    "short_qty": "0",
    "fulfillment_date": "created_at",
    "assignment_fc": "100 + k % 6",
}, where="k % 5 = 0")
union("order_detail", "line_details", "parent_details")
UNIT_OFF = "5 + pk % 50"
shape("line_discounts", "line_x", {
    "order_id": "k",
    "item_id": "line_id",
    "discount_id": "1",
    "discount_type": "CASE pk % 4 WHEN 0 THEN 'tpa' WHEN 1 THEN 'coupon' ELSE 'tiered_pricing' END",
    "rule_id": "1000 + pk % 13",
    "discount_amt": cents(UNIT_OFF),
    "units_applied": "qty",
    "base_amt_off_applied": cents(f"qty * ({UNIT_OFF})"),
    "amt_off_applied": cents(f"qty * ({UNIT_OFF})"),
    "rule_name": "CASE WHEN pk % 7 = 0 THEN 'A&S ' ELSE 'TPR ' END || CAST(pk % 13 AS STRING)",
    "rule_group": "'grp' || CAST(pk % 5 AS STRING)",
    "sponsored_by": "CASE pk % 3 WHEN 0 THEN 'Brand' WHEN 1 THEN 'Both' END",
    "sponsored_percentage": "CAST(CASE k % 4 WHEN 0 THEN 10 WHEN 1 THEN 25 WHEN 2 THEN 50 ELSE 100 END AS DOUBLE)",
}, where="pk % 4 <> 3 AND k % 5 <> 0")
shape("parent_discounts", "orders_x", {
    "order_id": "k",
    "item_id": "k * 8 * 65536",
    "discount_id": "d",
    "discount_type": "CASE WHEN d = 1 THEN 'tpa' ELSE 'coupon' END",
    "rule_id": "2000 + k % 7 * 2 + d",
    "discount_amt": cents("k % 300 + d"),
    "units_applied": "k % 4",
    "base_amt_off_applied": cents("k % 4 * (k % 300 + d)"),
    "amt_off_applied": cents("k % 4 * (k % 300 + d)"),
    "rule_name": "CASE WHEN k % 15 = 0 THEN 'A&S bundle' ELSE 'TPR bundle' END",
    "rule_group": "'grp' || CAST(k % 5 AS STRING)",
    "sponsored_by": "CASE WHEN k % 10 = 0 THEN 'Brand' ELSE 'Both' END",
    "sponsored_percentage": "CAST(CASE k % 3 WHEN 0 THEN 20 WHEN 1 THEN 40 ELSE 100 END AS DOUBLE)",
}, where="k % 5 = 0", lines=("d", "CAST(2 AS BIGINT)"))
union("detail_discounts", "line_discounts", "parent_discounts")

# --------------------------------------------------------------------------- fulfillment staging
TRAN_DATE = f"CAST({days('1996-01-10', 'k % 1500')} AS TIMESTAMP) + (k % 24) * INTERVAL '1' HOUR"
shape("ship_header", "orders_x", {
    "message_uuid": "'of-' || CAST(k AS STRING)",
    "order_id": "k",
    "updated_at": hours("created_at", "72"),
    "credit_memo_id": "CASE WHEN k % 4 = 1 THEN '[' || CAST(900000000 + k AS STRING) || ']' END",
    "is_last_shipment": "k % 4 <> 2",
})
shape("ship_detail", "line_x", {
    "message_uuid": "'of-' || CAST(k AS STRING)",
    "order_id": "k",
    "item_id": "line_id + CASE WHEN pk % 1999 = 7 THEN 262144000000 ELSE 0 END",
    "parent_item_id": "parent_id",
    "product_type": "CASE WHEN pk % 29 = 0 THEN 'aw_giftcard' ELSE 'simple' END",
    "units_shipped": "qty - short",
    "units_shorted": "short",
    "fc": "'[' || CAST(pk % 6 + 1 AS STRING) || ']'",
    "sku": text("pk"),
    "shipment_id": "CAST(k AS STRING)",
    "tracking_id": "'trk' || CAST(pk % 1000 AS STRING)",
}, where="shipped")
shape("ship_credits", "orders_x", {"credit_id": "900000000 + k"}, where="k % 4 = 1")
shape("ship_credit_items", "line_x", {
    "credit_id": "900000000 + k",
    "order_item_id": "line_id",
    "qty_refunded": "CASE WHEN flag = 'R' THEN 1 ELSE 0 END",
    "base_price": cents("price_c"),
    "base_tax_amt": cents("taxl_c"),
    "base_discount_amt": cents("disc_c"),
    "base_row_total_incl_tax": cents("price_c + taxl_c"),
}, where="k % 4 = 1 AND flag <> 'A'")
shape("stage_lines", "line_x", {
    "order_id": "k",
    "increment_id": "inc",
    "customer_id": "k % 1499 + 1",
    "fulfilled_at": "ship_at",
    "item_id": "line_id",
    "parent_item_id": "parent_id",
    "product_type": "CASE WHEN pk % 29 = 0 THEN 'aw_giftcard' ELSE 'simple' END",
    "fc": "CASE WHEN pk % 6 = 5 THEN NULL ELSE 100 + pk % 6 END",
    "store_fc": "pk % 6 + 1",
    "sku": text("pk"),
    "units_shipped": "qty - short",
    "qty_ordered": "qty",
    "units_shorted": "short",
    "base_price": cents("price_c"),
    "base_discount_amt": cents("CASE WHEN pk % 19 = 0 THEN NULL ELSE disc_c END"),
    "base_tax_amt": cents("taxl_c"),
    "is_last_shipment": "k % 4 <> 2",
    "qty_refunded": "CASE WHEN flag = 'R' THEN 1 END",
    "credit_price": cents("CASE WHEN flag = 'R' THEN price_c END"),
    "retail_price": cents("CASE WHEN pk % 31 = 0 THEN 0 ELSE 199 + pk % 50 * 35 END"),
    "tpa_unit_amt": cents(f"CASE WHEN pk % 4 = 0 AND k % 5 <> 0 THEN {UNIT_OFF} END"),
    "tran_date": TRAN_DATE,
    "sale_date": days("1995-12-20", "k % 1500"),
}, where="shipped")
shape("stage_parents", "orders_x", {
    "order_id": "k",
    "increment_id": "CASE WHEN k % 10 = 0 THEN CAST(k AS STRING) ELSE CAST(100000000 + k AS STRING) END || '-1'",
    "customer_id": "k % 1499 + 1",
    "fulfilled_at": hours("created_at", "80"),
    "item_id": "k * 8 * 65536",
    "parent_item_id": "CAST(NULL AS BIGINT)",
    "product_type": "'bundle'",
    "fc": "100",
    "store_fc": "1",
    "sku": "'bundle' || CAST(k % 100 AS STRING)",
    "units_shipped": "k % 4",
    "qty_ordered": "k % 4",
    "units_shorted": "0",
    "base_price": cents("CASE WHEN k % 35 = 0 THEN 0 ELSE 1000 + k * 37 % 9000 END"),
    "base_discount_amt": cents("k % 200"),
    "base_tax_amt": cents("k % 170"),
    "is_last_shipment": "k % 4 <> 2",
    "qty_refunded": "CAST(NULL AS INT)",
    "credit_price": "CAST(NULL AS DECIMAL(12,4))",
    "retail_price": "CAST(NULL AS DECIMAL(12,4))",
    "tpa_unit_amt": "CAST(NULL AS DECIMAL(12,4))",
    "tran_date": TRAN_DATE,
    "sale_date": days("1995-12-20", "k % 1500"),
}, where="k % 5 = 0")
union("stage", "stage_lines", "stage_parents")
shape("order_payments", "orders_z", {
    "order_id": "k",
    "payment_type": "CASE k % 3 WHEN 1 THEN 'gc' WHEN 2 THEN 'tc' ELSE 'cc' END",
    "gift_card_id": "CASE WHEN k % 3 = 1 THEN CAST(custkey AS STRING) END",
    "pay_amt": cents("CASE k % 3 WHEN 1 THEN gift_c WHEN 2 THEN CASE WHEN k % 6 = 2 THEN cash_c ELSE 0 END ELSE expected_c END", 12, 2),
    "sale_date": days("1995-06-01", "k % 2000"),
})
shape("card_history", "events", {
    "card_id": "user_id",
    "issue_type": "CASE event_type WHEN 'view' THEN 'Make-Good' WHEN 'click' THEN 'Make-Good' ELSE 'Purchased' END",
    "group_code": "event_type",
    "group_label": "upper(event_type)",
    "reason_id": "event_id % 6",
    "reason_label": "'reason ' || CAST(event_id % 6 AS STRING)",
})
shape("gift_sales", "orders_z", {
    "message_uuid": "'gcf-' || CAST(k AS STRING)",
    "item_id": "k * 8 * 65536",
    "order_id": "k",
    "increment_id": "100000000 + k",
    "card_id": "k % 1500",
    "card_type": "CASE WHEN k % 10 = 0 THEN 1 ELSE 2 END",
    "card_amt": cents("2500 + k % 50", 10),
    "updated_at": hours("created_at", "2"),
    "sku": "'gift' || CAST(k % 9 AS STRING)",
    "group_code": "'g' || CAST(k % 3 AS STRING)",
}, where="k % 5 = 0 OR k % 7 = 2")

# --------------------------------------------------------------------------- credit memos and card adjustments
shape("credits", "orders_z", {
    "credit_id": "900000000 + k",
    "credit_increment_id": "800000000 + k",
    "message_uuid": "'cm-' || CAST(k AS STRING)",
    "order_id": "CASE WHEN priority = '1-URGENT' AND k % 8 = 5 THEN 5000000000 + k ELSE k END",
    "increment_id": "inc",
    "customer_id": "custkey",
    "updated_at": hours("created_at", "200"),
    "order_has_shipped": "CASE WHEN k % 3 = 0 THEN 'false' ELSE 'true' END",
    "base_total_product": cents("CASE k % 16 WHEN 1 THEN 0 WHEN 9 THEN NULL ELSE prod_c END", 10),
    "base_total_discount": cents("0 - k % 40", 10),
    "base_adjustment": cents("k % 30", 10),
    "base_total_tax": cents("tax_c", 10),
    "base_donations": cents("don_c", 10),
    "base_shipment": cents("gro_c", 10),
    "base_shipment_tax": cents("coalesce(grot_c, 0)", 10),
    "base_frozen_shipment": cents("fro_c", 10),
    "base_frozen_shipment_tax": cents("frot_c", 10),
    "base_wine_shipment": cents("wine_c", 10),
    "base_wine_shipment_tax": cents("winet_c", 10),
    "base_total_gift_cards": cents("CASE WHEN k % 3 = 1 THEN 500 ELSE 0 END", 10),
    "base_total_credit": cents("prod_c + tax_c", 10),
    "base_total_refund": cents("prod_c", 10),
    f"total_{CASH}": cents("CASE WHEN k % 7 = 3 THEN 300 ELSE 0 END", 10),
    "ppe_fee": cents("coalesce(ppe_c, 0)", 10),
    "ppe_fee_tax": cents("ppet_c", 10),
    "billing_state": "state",
}, where="k % 4 = 1")
CREDIT_C = ("(CASE k % 16 WHEN 1 THEN 0 WHEN 9 THEN 0 ELSE prod_c END - k % 40 + k % 30 + tax_c + coalesce(don_c, 0)"
            " + coalesce(gro_c, 0) + coalesce(fro_c, 0) + coalesce(wine_c, 0) + coalesce(ppe_c, 0)"
            " - CASE WHEN k % 7 = 3 THEN 300 ELSE 0 END)")
shape("credit_items", "orders_z", {
    "credit_id": "900000000 + k",
    "credit_item_id": "k * 8 + i",
    "order_id": "k",
    "order_item_id": "k * 8 + i",
    "sku": text("(k * 7 + i * 13) % 2000"),
    "qty_refunded": "CASE WHEN i = 1 THEN qty ELSE 1 END",
    "base_price": cents("199 + k * 31 % 5000 + i * 17", 10),
    "base_tax_amt": cents("CASE WHEN k % 6 = 0 THEN NULL ELSE k % 90 + i END", 10),
    "tax_amt": cents("CASE WHEN k % 6 = 0 THEN NULL ELSE k % 90 + i END", 10),
    "base_discount_amt": cents("CASE WHEN k % 6 = 1 THEN NULL ELSE k % 20 END", 10),
    "discount_amt": cents("CASE WHEN k % 6 = 1 THEN NULL ELSE k % 20 END", 10),
    "message_uuid": "'cm-' || CAST(k AS STRING)",
}, where="k % 4 = 1", lines=("i", "k % 2 + 1"))
shape("credit_refunds", "orders_z", {
    "credit_id": "900000000 + k",
    "order_id": "k",
    "payment_id": "'r' || CAST(k AS STRING)",
    "payment_gateway": "'braintree'",
    "cc_type": CC_TYPE,
    "base_pay_amt": cents(f"CASE WHEN k % 12 = 9 THEN {CREDIT_C} - 250 ELSE {CREDIT_C} + off_c END", 10),
    "pay_amt": cents(f"CASE WHEN k % 12 = 9 THEN {CREDIT_C} - 250 ELSE {CREDIT_C} + off_c END", 10),
    "gateway_tran_id": "'rg' || CAST(k AS STRING)",
    "cc_tran_id": "'rt' || CAST(k AS STRING)",
    "message_uuid": "'cm-' || CAST(k AS STRING)",
}, where="k % 4 = 1 AND k % 3 <> 1")
shape("credit_gift_cards", "orders_z", {
    "credit_id": "900000000 + k",
    "order_id": "k",
    "gift_card_id": "CASE WHEN k % 60 = 1 THEN '0' ELSE CAST(k % 1500 AS STRING) END",
    "gift_card_amt": cents(f"CASE WHEN k % 12 = 9 THEN 250 ELSE {CREDIT_C} END", 10),
    "message_uuid": "'cm-' || CAST(k AS STRING)",
}, where="k % 4 = 1 AND (k % 3 = 1 OR k % 12 = 9)")
shape("control", "region", {"control_name": "'pre_ods_order_id'", "int_value": "CAST(3000 AS BIGINT)"}, where="r_regionkey = 0")
shape("card_moves", "events", {
    "event_id": "event_id",
    "message_uuid": "'gca-' || CAST(event_id AS STRING)",
    "customer_id": "CAST(user_id AS STRING)",
    "updated_at": "date_trunc('second', ts)",
    "card_id": "user_id",
    "card_amt": "value + 10",
    "card_delta": "CASE WHEN event_id % 3 = 0 THEN -value ELSE value END",
    "action": "CASE WHEN event_id % 3 = 0 THEN '2' ELSE '1' END",
    "action_label": "CASE WHEN event_type = 'signup' THEN 'Created' ELSE 'Updated' END",
    "reason_id": "event_id % 6",
    "reason_label": "'reason ' || CAST(event_id % 6 AS STRING)",
    "group_code": "CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END",
    "group_label": "upper(event_type)",
    "subscription_start_date": "CASE WHEN event_id % 6 = 0 THEN date_trunc('day', ts) END",
    "subscription_end_date": "CASE WHEN event_id % 12 = 0 THEN date_trunc('day', ts) + 30 * INTERVAL '1' DAY END",
    "expire_at": "CASE WHEN event_id % 5 <> 0 THEN date_trunc('second', ts) + (event_id % 5 * 10) * INTERVAL '1' DAY END",
})
shape("created_cards", "customer", {
    "card_id": "c_custkey",
    "action_label": "CASE WHEN c_custkey % 8 = 0 THEN 'Updated' ELSE 'Created' END",
    "reason_id": "c_custkey % 6",
    "reason_label": "'reason ' || CAST(c_custkey % 6 AS STRING)",
    "group_label": "'label ' || CAST(c_custkey % 4 AS STRING)",
    "group_code": "'g' || CAST(c_custkey % 4 AS STRING)",
}, where="c_custkey % 5 <> 2")
shape("card_types", "region", {
    "group_code": "CASE r_regionkey WHEN 0 THEN 'view' WHEN 1 THEN 'click' WHEN 2 THEN 'purchase' WHEN 3 THEN 'error' ELSE '' END",
    "issue_type": "CASE r_regionkey WHEN 0 THEN 'Make-Good' WHEN 1 THEN 'Purchased' ELSE 'Refund' END",
})
shape("redeem_orders", "events", {
    "order_id": "7000000000 + event_id",
    "gift_card_id": "user_id",
    "created_at": "date_trunc('second', ts) - (CASE event_id % 8 WHEN 0 THEN 0 WHEN 2 THEN 30 WHEN 4 THEN 31 ELSE 12 END) * INTERVAL '1' SECOND",
    "pay_amt": "CASE WHEN event_id % 3 = 0 THEN -value ELSE value END",
    "customer_id": "user_id + 1",
    "increment_id": "CAST(event_id AS STRING)",
}, where="event_id % 2 = 0")
shape("sold_cards", "orders_z", {
    "card_id": "custkey",
    "card_type": "CASE WHEN k % 3 = 0 THEN 1 ELSE 2 END",
    "increment_id": "inc",
}, where="k % 97 = 3")
shape("credited_cards", "orders_z", {
    "gift_card_id": "custkey",
    "credit_id": "900000000 + k",
    "credit_increment_id": "800000000 + k",
    "order_id": "k",
    "increment_id": "inc",
}, where="k % 53 = 5")

# --------------------------------------------------------------------------- ledger, journals, cost adjustments
LEDGER_NULLS = {
    "brand_marketing_id": "CAST(NULL AS BIGINT)",
    "ns_tran_id": "CAST(NULL AS BIGINT)",
}
SUB = "CASE j WHEN 1 THEN 16 WHEN 2 THEN 48 WHEN 3 THEN 111 WHEN 4 THEN 113 ELSE 69 END"
shape("ledger_line", "line_x", {"j": "j"}, where="shipped AND (j <> 3 OR pk % 3 = 0) AND (j <> 4 OR pk % 16 = 0)"
      " AND (j <> 2 OR pk % 4 = 0) AND (j <> 5 OR pk % 4 = 1)", lines=("j", "CAST(5 AS BIGINT)"), keep=True)
shape("ledger_lines", "ledger_line", {
    "tran_id": "line_id * 16 + j * 2 + c",
    "tran_type": "300",
    "tran_sub_type_id": SUB,
    "tran_sub_type": "CASE j WHEN 1 THEN 'Product' WHEN 2 THEN 'TPA' WHEN 3 THEN 'Vendor Rebates' WHEN 4 THEN 'TPR Vendor Funding' ELSE 'Coupon' END",
    "tran_date": TRAN_DATE,
    "order_id": "k",
    "order_line_id": "line_id",
    "parent_item_id": "parent_id",
    "location_id": "CASE WHEN pk % 6 = 5 THEN NULL ELSE 100 + pk % 6 END",
    "magento_location_id": "pk % 6 + 1",
    "customer_id": "k % 1499 + 1",
    "increment_id": "inc",
    "sku": text("pk"),
    "item_id": "CASE WHEN pk % 37 = 0 THEN NULL ELSE 500000 + pk END",
    "group_id": "CASE WHEN pk % 37 = 0 THEN NULL ELSE pk % 10 END",
    "tran_qty": "qty - short",
    "tran_amt": cents("CASE j WHEN 1 THEN qty * price_c WHEN 2 THEN qty * (5 + pk % 50) ELSE (qty - short) * (pk % 300) END", 14, 2),
    "tran_cost_amt": cents("CASE WHEN pk % 9 = 0 THEN NULL ELSE qty * (pk % 900) END", 14, 2),
    "tran_cogs_amt": "CAST(CASE WHEN pk % 13 = 0 THEN NULL ELSE qty * (pk % 910) * 0.0125 END AS DECIMAL(14,4))",
    "rebate_total": "CAST(CASE WHEN j = 3 AND pk % 7 <> 0 OR j = 4 THEN (qty - short) * (pk % 300) * 0.0101 END AS DECIMAL(14,4))",
    "rebate_start_date": f"CASE WHEN j = 3 THEN {days('1996-01-01', 'pk % 30')} END",
    "rebate_end_date": f"CASE WHEN j = 3 THEN {days('2000-01-01', 'pk % 30')} END",
    "rebate_percentage": cents("CASE WHEN j = 3 THEN pk % 17 * 100 END"),
    "rebate_dollar_amount": cents("CASE WHEN j = 3 AND pk % 2 = 0 THEN 25 END"),
    "rebate_billing_period": "CASE WHEN j = 3 THEN 'Monthly' END",
    "rebate_type": "CASE WHEN j = 3 THEN CASE WHEN pk % 2 = 0 THEN 'By SKU' ELSE 'By Brand' END END",
    "rebate_billing_method": "CASE WHEN j = 3 THEN pk % 4 + 1 END",
    "rule_id": "CASE WHEN j IN (2, 4) THEN CASE WHEN k % 5 = 0 THEN 2000 + k % 7 * 2 + 1 ELSE 1000 + pk % 13 END END",
    "rule_name": "CASE WHEN j IN (2, 4) THEN 'rule ' || CAST(pk % 13 AS STRING) END",
    "coupon_rule_name": "CASE WHEN j = 5 THEN 'coupon ' || CAST(pk % 11 AS STRING) END",
    "coupon_group_code": "CASE WHEN j = 5 THEN 'grp' || CAST(pk % 5 AS STRING) END",
    "sale_date": days("1995-12-20", "k % 1500"),
    "tran_gl_date": days("1996-01-10", "k % 1500"),
    "je_map_id": "CASE pk % 7 WHEN 0 THEN 80 WHEN 1 THEN 85 WHEN 2 THEN 90 WHEN 3 THEN 35 WHEN 4 THEN 36 WHEN 5 THEN 100 ELSE 999 END",
    "cancel_type": "CASE WHEN pk % 59 = 0 THEN 'void' END",
    "fulfillment_tran_id": "CASE WHEN j = 3 AND pk % 5 = 0 THEN line_id END",
    **LEDGER_NULLS,
}, lines=("c", "CASE WHEN pk % 101 = 0 THEN 2 ELSE 1 END"))
MEMBER_MAPS = "CASE k % 9 WHEN 0 THEN 63 WHEN 1 THEN 145 WHEN 2 THEN 124 WHEN 3 THEN 10 WHEN 4 THEN 8 WHEN 5 THEN 64 WHEN 6 THEN 62 WHEN 7 THEN 79 ELSE 123 END"
ledger_null = {name: "CAST(NULL AS " + kind + ")" for name, kind in {
    "order_line_id": "BIGINT", "parent_item_id": "BIGINT", "location_id": "BIGINT", "magento_location_id": "BIGINT",
    "sku": "STRING", "item_id": "BIGINT", "group_id": "BIGINT", "tran_qty": "BIGINT", "tran_cost_amt": "DECIMAL(14,2)",
    "tran_cogs_amt": "DECIMAL(14,4)", "rebate_total": "DECIMAL(14,4)", "rebate_start_date": "DATE",
    "rebate_end_date": "DATE", "rebate_percentage": "DECIMAL(12,4)", "rebate_dollar_amount": "DECIMAL(12,4)",
    "rebate_billing_period": "STRING", "rebate_type": "STRING", "rebate_billing_method": "BIGINT", "rule_id": "BIGINT",
    "rule_name": "STRING", "coupon_rule_name": "STRING", "coupon_group_code": "STRING", "cancel_type": "STRING",
    "fulfillment_tran_id": "BIGINT"}.items()}
shape("ledger_members", "orders_z", {
    "tran_id": "4000000000000000000 + k",
    "tran_type": "150",
    "tran_sub_type_id": "10",
    "tran_sub_type": "'Payment Capture'",
    "tran_date": TRAN_DATE,
    "order_id": "5000000000 + k",
    **{c: ledger_null[c] for c in ("order_line_id", "parent_item_id", "location_id", "magento_location_id")},
    "customer_id": "custkey",
    "increment_id": "CAST(700000000 + k AS STRING)",
    **{c: ledger_null[c] for c in ("sku", "item_id", "group_id", "tran_qty")},
    "tran_amt": cents("5995 + k % 300", 14, 2),
    **{c: ledger_null[c] for c in ("tran_cost_amt", "tran_cogs_amt", "rebate_total", "rebate_start_date", "rebate_end_date",
                                   "rebate_percentage", "rebate_dollar_amount", "rebate_billing_period", "rebate_type",
                                   "rebate_billing_method", "rule_id", "rule_name", "coupon_rule_name", "coupon_group_code")},
    "sale_date": days("1995-12-20", "k % 1500"),
    "tran_gl_date": days("1996-01-10", "k % 1500"),
    "je_map_id": MEMBER_MAPS,
    "cancel_type": ledger_null["cancel_type"],
    "fulfillment_tran_id": ledger_null["fulfillment_tran_id"],
    **LEDGER_NULLS,
}, where="priority = '1-URGENT'")
shape("ledger_marketing", "part_x", {
    "tran_id": "4500000000000000000 + p_partkey",
    "tran_type": "300",
    "tran_sub_type_id": "112",
    "tran_sub_type": "'Brand Marketing Fees'",
    "tran_date": f"CAST({days('1996-01-10', 'p_partkey % 1500')} AS TIMESTAMP)",
    "order_id": "CAST(NULL AS BIGINT)",
    **{c: ledger_null[c] for c in ("order_line_id", "parent_item_id", "location_id", "magento_location_id")},
    "customer_id": "CAST(NULL AS BIGINT)",
    "increment_id": "CAST(NULL AS STRING)",
    **{c: ledger_null[c] for c in ("sku", "item_id", "group_id", "tran_qty")},
    "tran_amt": cents("10000 + p_partkey % 700 * 100", 14, 2),
    **{c: ledger_null[c] for c in ("tran_cost_amt", "tran_cogs_amt", "rebate_total", "rebate_start_date", "rebate_end_date",
                                   "rebate_percentage", "rebate_dollar_amount", "rebate_billing_period", "rebate_type",
                                   "rebate_billing_method", "rule_id", "rule_name", "coupon_rule_name", "coupon_group_code")},
    "sale_date": "CAST(NULL AS DATE)",
    "tran_gl_date": days("1996-01-10", "p_partkey % 1500"),
    "je_map_id": "CAST(NULL AS INT)",
    "cancel_type": ledger_null["cancel_type"],
    "fulfillment_tran_id": ledger_null["fulfillment_tran_id"],
    "brand_marketing_id": "p_partkey",
    "ns_tran_id": "CAST(NULL AS BIGINT)",
}, where="p_partkey % 20 = 0 AND p_partkey % 100 <> 0")
shape("ledger_adjusted", "orders_z", {
    "ns_tran_id": "k",
}, where="k % 100 = 3")
union("ledger", "ledger_lines", "ledger_members", "ledger_marketing")
shape("journal_lines", "ledger", {
    "tran_id": "tran_id",
    "acct_number": "CASE WHEN tran_sub_type_id = 69 THEN '41107' WHEN order_id % 10 = 9 THEN '40105' WHEN order_id % 10 = 8 THEN '50000' ELSE '40100' END",
    "tran_date": "tran_gl_date",
}, lines=("c", "CASE WHEN tran_id % 4 = 0 THEN 2 ELSE 1 END"))
shape("gl_map", "nation", {
    "map_id": "CASE n_nationkey WHEN 0 THEN 80 WHEN 1 THEN 85 WHEN 2 THEN 90 WHEN 3 THEN 35 WHEN 4 THEN 36 ELSE 100 END",
    "debit_account_number": "CASE n_nationkey % 3 WHEN 0 THEN '40100' WHEN 1 THEN '41113' ELSE '12010' END",
    "credit_account_number": "CASE n_nationkey % 3 WHEN 0 THEN '12010' WHEN 1 THEN '40100' ELSE '41104' END",
}, where="n_nationkey < 6")
shape("manual_journals", "orders_z", {
    "transaction_id": "k",
    "trandate": "CAST(created_at AS DATE)",
    "is_from_ods": "k % 2 = 0",
}, where="k % 15 = 1")
shape("manual_lines", "orders_z", {
    "transaction_id": "k",
    "account_id": "CASE WHEN k % 4 = 1 THEN 8 ELSE 7 END",
    "debit_amount": cents("CASE WHEN d = 1 THEN k % 5000 END", 12, 2),
    "credit_amount": cents("CASE WHEN d = 2 THEN k % 3000 END", 12, 2),
}, where="k % 15 = 1", lines=("d", "CAST(2 AS BIGINT)"))
shape("erp_accounts", "region", {"account_id": "r_regionkey + 6", "accountnumber": "CASE WHEN r_regionkey = 1 THEN '41107' ELSE '40000' END"})
shape("adj_headers", "orders_x", {
    "transaction_id": "k",
    "trandate": "CAST(created_at AS DATE)",
    "status": "'Approved'",
    "transaction_type": "'Inventory Cost Revaluation'",
    "create_date": "created_at",
}, where="k % 10 = 3")
shape("adj_lines", "line_x", {
    "transaction_id": "k",
    "transaction_line_id": "line_id",
    "account_id": "CASE WHEN pk % 5 = 0 THEN 280 ELSE 279 END",
    "amount": cents("price_c % 10000 - 2500", 12, 2),
    "item_id": "500000 + pk",
    "location_id": "100 + pk % 6",
    "memo": "CASE WHEN pk % 4 = 3 THEN 'Freight' ELSE 'Cost of Sales Adjustment' END",
    "date_created": "ship_at",
}, where="k % 10 = 3")

# --------------------------------------------------------------------------- ERP lookup tables
shape("vendor_map", "nation", {"brand_records_id": "CAST(n_nationkey + 1 AS BIGINT)", "vendor_id": "CAST(2001 + n_nationkey AS BIGINT)"}, where="n_nationkey % 6 <> 5")
shape("contact_map", "customer", {"brand_records_id": "c_custkey % 25 + 1", "contact_id": "c_custkey"}, where="c_custkey % 25 <> 3 AND c_custkey % 25 <> 10")
shape("contacts", "customer", {"contact_id": "c_custkey", "email": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'contact' || CAST(c_custkey AS STRING) || '@mail.example' END"})
shape("erp_customers", "customer", {
    "customer_id": "c_custkey",
    "name": "CASE WHEN c_custkey < 20 THEN 'Brand#' || CAST(c_custkey + 1 AS STRING) ELSE c_name END",
    "email": "CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE 'cust' || CAST(c_custkey AS STRING) || '@mail.example' END",
    "companyname": "c_name",
})
shape("erp_vendors", "supplier", {
    "vendor_id": "2001 + s_suppkey",
    "name": "'Brand#' || CAST(s_suppkey + 1 AS STRING)",
    "email": "CASE WHEN s_suppkey % 2 = 1 THEN NULL ELSE 'vend' || CAST(s_suppkey AS STRING) || '@mail.example' END",
})
shape("employees", "customer", {"employee_id": "c_custkey", "email": "'emp' || CAST(c_custkey AS STRING) || '@store.example'", "full_name": "c_name", "jobtitle": "c_mktsegment"}, where="c_custkey % 3 <> 1")
shape("asset_types", "region", {"list_id": "CAST(r_regionkey AS BIGINT)", "list_item_name": "r_name"})
shape("period_list", "region", {"list_id": "CAST(r_regionkey + 1 AS BIGINT)", "list_item_name": "'period ' || CAST(r_regionkey AS STRING)"})
shape("status_list", "region", {"list_id": "r_regionkey + 1", "list_item_name": "'status ' || CAST(r_regionkey AS STRING)"})
shape("rebate_types", "region", {"list_id": "r_regionkey + 1", "list_item_name": "'type ' || CAST(r_regionkey AS STRING)"})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The shape (or driver table) as a DataFrame."""
    if name not in SHAPES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    s = SHAPES[name]
    if s.union:
        frames = [table(spark, sf_dir, m) for m in s.union]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out
    df = table(spark, sf_dir, s.base)
    if s.lines:
        col, count = s.lines
        size = f"CAST({count} AS BIGINT)"
        df = df.filter(f"{size} > 0").withColumn(
            col, F.explode(F.expr(f"sequence(CAST(1 AS BIGINT), {size})")))
    if s.where:
        df = df.filter(s.where)
    cols = [F.expr(e).alias(c) for c, e in s.cols.items()]
    if s.keep:
        new = set(s.cols)
        cols = [F.col(c) for c in df.columns if c not in new] + cols
    df = df.select(*cols)
    stamps = [c for c, t in df.dtypes if t == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps}) if stamps else df


def needs(name: str) -> list[str]:
    """Shapes that ``name`` is derived from, deepest first, itself last."""
    if name not in SHAPES:
        return []
    s = SHAPES[name]
    out: list[str] = []
    for base in s.union or (s.base,):
        out += [n for n in needs(base) if n not in out]
    return out + [name]


def cte(name: str) -> str:
    """DuckDB text of one shape, for use as a CTE body."""
    s = SHAPES[name]
    if s.union:
        cols = ", ".join(SHAPES[s.union[0]].cols)
        return " UNION ALL ".join(f"SELECT {cols} FROM {m}" for m in s.union)
    source = s.base
    if s.lines:
        col, count = s.lines
        source = (f"(SELECT *, unnest(generate_series(CAST(1 AS BIGINT), CAST({count} AS BIGINT))) AS {col}"
                  f" FROM {s.base})")
    picked = ", ".join(f"{e} AS {c}" for c, e in s.cols.items() if not (s.keep and s.lines and c == e == s.lines[0]))
    star = "*, " if s.keep else ""
    picked = (star + picked).rstrip(", ")
    return f"SELECT {picked} FROM {source}" + (f" WHERE {s.where}" if s.where else "")


__all__ = ["SHAPES", "table", "cte", "needs", "CASH"]
