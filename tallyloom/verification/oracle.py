"""DuckDB SQL for every registered query, on the driver's tables.

The input tables come in as CTEs (:mod:`tallyloom.sources.shapes`); each operator's logic
is written again here, set-wise and without the library's detours (windows instead of
histograms, whole ranges instead of time steps), so the two sides check each other.
"""

from __future__ import annotations

import re

from tallyloom.plans import registry as G
from tallyloom.sources import shapes
from tallyloom.wire import CASH, CASH_DISCOUNT, ZERO_CHARGE

SQL: dict[str, str] = {}
LOCAL: dict[str, str] = {}
ORACLE_TYPES = {"n": "BIGINT", "m": "DOUBLE", "s": "VARCHAR", "d": "VARCHAR", "t": "VARCHAR", "b": "BIGINT"}
AS_OF, START, END = f"TIMESTAMP '{G.AS_OF} 00:00:00'", f"DATE '{G.START}'", f"DATE '{G.END}'"


def loc(ts):
    return f"((({ts}) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles')"


def pac(ts):
    return f"CAST({loc(ts)} AS DATE)"


def nz(x):
    return f"coalesce({x}, 0)"


# --------------------------------------------------------------------------- S
SQL["queue_source"] = """SELECT (k * 4 + 1) * 16 + 1 AS id, 'oc-' || CAST(k AS VARCHAR) AS message_uuid, k AS order_id,
 TIMESTAMP '2024-02-01 01:00:00' AS s3_updated_at FROM orders_z"""
SQL["erp_snapshot_load"] = "SELECT * FROM erp_customers"
LOCAL["charges"] = " UNION ALL ".join(
    f"SELECT {t} AS tran_type, {s} AS tran_sub_type_id, '{n}' AS tran_sub_type, created_at AS tran_date, order_type, order_id, increment_id,"
    f" customer_id, {e} AS tran_amt, {pac('created_at')} AS sale_date, {pac('created_at')} AS tran_gl_date, message_uuid FROM capture WHERE {e} > 0"
    for t, s, n, e in (
        (105, 13, "Tax Capture", "(coalesce(base_total_tax, 0) - coalesce(ppe_fee_tax, 0) - ship_tax)"),
        (105, 28, "Shipping Tax Capture", "ship_tax"),
        (105, 95, "PPE Tax Capture", "coalesce(ppe_fee_tax, 0)"),
        (400, 5, "Donation", "coalesce(base_donations, 0)"))).replace(
    "ship_tax", "(coalesce(base_shipment_tax, 0) + coalesce(grocery_base_shipment_tax, 0) + coalesce(frozen_base_shipment_tax, 0)"
                " + coalesce(wine_base_shipment_tax, 0))")
SQL["append_insert"] = """SELECT order_id, tran_type, tran_sub_type_id, tran_amt FROM order_ledger
 UNION ALL SELECT order_id, tran_type, tran_sub_type_id, tran_amt FROM charges"""
SQL["insert_if_absent"] = """SELECT transaction_id, transaction_line_id, item_id,
 CASE WHEN item_id % 2 = 0 THEN 0 ELSE amount END AS amount FROM adj_lines a
 WHERE item_id % 2 = 0 OR NOT EXISTS (SELECT 1 FROM adj_lines b WHERE b.item_id % 2 = 0 AND b.item_id = a.item_id
  AND b.transaction_id = a.transaction_id AND b.transaction_line_id = a.transaction_line_id)"""
SQL["update_from"] = """SELECT rebate_agreement_id, billing_period,
 CASE WHEN rebate_agreement_id % 3 = 0 THEN percentage + 1 ELSE percentage END AS percentage,
 CASE WHEN rebate_agreement_id % 3 = 0 THEN upper(brandemail) ELSE brandemail END AS brandemail FROM agreements"""
SQL["upsert_dimension"] = """SELECT rebate_agreement_id, item_id,
 CASE WHEN fresh THEN percentage + 1 ELSE percentage END AS percentage, dollar_amount,
 CASE WHEN fresh THEN upper(brandemail) ELSE brandemail END AS brandemail,
 CASE WHEN known THEN 'old' ELSE billing_period END AS billing_period
 FROM (SELECT *, rebate_agreement_id % 4 <> 1 AS known, rebate_agreement_id % 5 <> 2 AS fresh FROM agreements) WHERE known OR fresh"""
SQL["semi_delete"] = "SELECT order_id, message_uuid FROM capture c WHERE NOT EXISTS (SELECT 1 FROM cancel_orders x WHERE x.order_id = c.order_id)"
LOCAL["done_items"] = "SELECT item_id FROM order_detail WHERE coalesce(fulfillment_qty, 0) + coalesce(short_qty, 0) <> 0"
SQL["in_delete"] = """SELECT item_id, order_id FROM ship_detail
 WHERE item_id NOT IN (SELECT item_id FROM order_detail WHERE fulfillment_qty + short_qty <> 0)"""
SQL["archive_move"] = """SELECT c.order_id, c.message_uuid,
 CASE WHEN c.order_id IN (SELECT order_id FROM membership) THEN 'processed' ELSE 'staging' END AS fate FROM cancels c"""
SQL["quarantine_already_done"] = """SELECT item_id, order_id,
 CASE WHEN item_id IN (SELECT item_id FROM done_items) THEN 'error' ELSE 'staging' END AS fate FROM ship_detail"""
SQL["null_fill_from_dimension"] = """SELECT l.tran_id, l.tran_sub_type_id,
 CASE WHEN i.item_id IS NOT NULL THEN i.group_id ELSE l.group_id END AS group_id,
 i.group_name, i.item_category_id AS category_id, i.item_category_name AS category_name, i.subcategory_id AS sub_category_id, i.subcategory_name AS sub_category_name,
 i.class_id, i.class_name, i.subclass_id, i.subclass_name, CASE WHEN i.item_id IS NOT NULL THEN i.item_id ELSE l.item_id END AS item_id,
 CASE WHEN i.item_id IS NOT NULL THEN round(CAST(l.tran_amt * i.net_unit_cost AS DECIMAL(30,6)), 2) ELSE l.tran_cost_amt END AS tran_cost_amt
 FROM ledger l LEFT JOIN curr_items i ON i.fc_id = 2 AND i.item_name = l.sku AND l.tran_type = 300 AND l.group_id IS NULL"""
SQL["link_rebate_to_fulfillment"] = """SELECT l.tran_id, l.tran_sub_type_id, l.order_line_id,
 CASE WHEN l.tran_sub_type_id = 111 THEN coalesce(l.fulfillment_tran_id, p.tran_id) ELSE l.fulfillment_tran_id END AS fulfillment_tran_id
 FROM ledger l LEFT JOIN (SELECT order_line_id, min(tran_id) AS tran_id FROM ledger WHERE tran_sub_type_id = 16 GROUP BY 1) p
 ON p.order_line_id = l.order_line_id"""
SQL["add_columns"] = """SELECT item_id, discount_id, CAST(NULL AS VARCHAR) AS sponsored_by, CAST(NULL AS DOUBLE) AS sponsored_percentage FROM detail_discounts
 UNION ALL SELECT item_id, position, sponsored_by, sponsored_percentage FROM capture_discounts"""
SQL["purge_by_predicate"] = f"""SELECT tran_id, tran_sub_type_id FROM ledger
 WHERE tran_sub_type_id <> 111 OR fulfillment_tran_id IS NULL OR tran_gl_date >= DATE '{G.PURGE_BEFORE}'"""

# --------------------------------------------------------------------------- Q
LOCAL["q_gca"] = """SELECT *, (event_id * 4 + copy) * 16 + 8 AS id, CAST(card_id AS VARCHAR) || '|' || CAST(updated_at AS VARCHAR) || '|'
 || CAST(round(CAST(card_delta AS DECIMAL(18,6)), 2) AS VARCHAR) AS dup_key
 FROM (SELECT *, unnest(generate_series(1, CASE WHEN event_id % 60 = 0 THEN 3 WHEN event_id % 20 = 0 THEN 2 ELSE 1 END)) AS copy FROM card_moves)"""
LOCAL["q_ocn"] = """SELECT *, (k * 4 + copy) * 16 + 6 AS id FROM (SELECT *, unnest(generate_series(1, CASE WHEN k % 12 = 2 THEN 2 ELSE 1 END)) AS copy
 FROM orders_z WHERE k % 6 <> 1)"""
LOCAL["q_of"] = """SELECT *, (k * 4 + copy) * 16 + 4 AS id, 'of-' || CAST(k AS VARCHAR) || '-' || CAST(copy AS VARCHAR) AS uuid
 FROM (SELECT *, unnest(generate_series(1, CASE WHEN k % 15 = 3 THEN 2 ELSE 1 END)) AS copy FROM orders_z)"""
SQL["dedupe_gift_card_adjustments"] = """SELECT id, CASE WHEN rn > 1 OR dup_key IN (SELECT dup_key FROM q_gca WHERE event_id % 25 IN (1, 2, 3))
 THEN 'error' ELSE 'queue' END AS fate FROM (SELECT id, dup_key, row_number() OVER (PARTITION BY dup_key ORDER BY copy, id) AS rn FROM q_gca)"""
SQL["dedupe_order_cancel"] = """SELECT id, CASE WHEN copy > 1 OR k % 25 IN (1, 2) OR k IN (SELECT order_id FROM order_header WHERE status = 'cancel')
 THEN 'error' ELSE 'queue' END AS fate FROM q_ocn"""
_work = {
    "oc": ("orders_z", "k", "(k * 4 + 1) * 16 + 1", "k % 25"),
    "mc": ("membership", "order_id", "((order_id - 5000000000) * 4 + 1) * 16 + 2", "order_id % 25"),
    "oa": ("orders_z", "k", "(k * 4 + 1) * 16 + 3", "k % 25"),
    "of": ("q_of", "uuid", "id", "CASE WHEN copy = 1 THEN k % 25 ELSE 0 END"),
    "cm": ("credits", "credit_id", "((credit_id - 900000000) * 4 + 1) * 16 + 5", "credit_id % 25"),
    "ocn": ("q_ocn", "k", "id", "k % 25"),
    "ma": ("orders_z", "'ma-' || CAST(k AS VARCHAR)", "(k * 4 + 1) * 16 + 7", "CASE WHEN k % 8 = 2 THEN k % 25 ELSE 1 END"),
    "gca": ("q_gca", "message_uuid", "id", "event_id % 25"),
    "gcf": ("gift_sales", "message_uuid", "(order_id * 4 + 1) * 16 + 9", "order_id % 25"),
}
SQL["new_message_worklist"] = " UNION ALL ".join(
    f"SELECT '{m}' AS message_type, CAST({key} AS VARCHAR) AS work_key, {i} AS id FROM {src} WHERE ({rest}) NOT IN (1, 2)"
    for m, (src, key, i, rest) in _work.items())
SQL["parse_gift_card_adjustment"] = "SELECT * FROM q_gca"
SQL["parse_order_cancel"] = f"""SELECT 'ocn-' || CAST(k AS VARCHAR) || '-' || CAST(copy AS VARCHAR) AS message_uuid, k AS order_id, inc AS increment_id,
 custkey AS customer_id, created_at + INTERVAL 5 HOUR AS updated_at, expected_c * 0.01 AS total_order,
 CASE k % 4 WHEN 0 THEN '{{"payment_detail":{{"voided":true}}}}' END AS refunds, CASE k % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS ms_initiated,
 CASE WHEN k % 9 = 0 THEN 1 END AS is_fraud FROM q_ocn"""
SQL["explode_cancel_cash_earned"] = """SELECT k AS order_id, k * 8 + i AS item_id, k % 9 AS rule_id, (k + i) % 500 * 0.01 AS earned_amt, k * 2 AS thrive_id,
 'ocn-' || CAST(k AS VARCHAR) || '-' || CAST(copy AS VARCHAR) AS message_uuid
 FROM (SELECT *, unnest(generate_series(1, k % 3)) AS i FROM q_ocn WHERE k % 3 > 0)"""
SQL["parse_membership_adjustment"] = """SELECT 'ma-' || CAST(k AS VARCHAR) AS message_uuid, custkey AS customer_id, 'member' AS start_status,
 CASE WHEN k % 3 = 0 THEN 'canceled' ELSE 'member' END AS end_status, CASE WHEN k % 5 = 0 THEN 900000000 + k END AS credit_memo_id, created_at AS updated_at
 FROM orders_z WHERE k % 8 = 2"""
SQL["parse_gift_card_fulfillment"] = "SELECT * FROM gift_sales"
SQL["parse_order_capture"] = "SELECT * FROM capture"
SQL["explode_order_items"] = "SELECT * FROM capture_items"
SQL["explode_item_discounts"] = "SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY item_id, position) AS discount_id FROM capture_discounts"
SQL["explode_order_payments"] = "SELECT * FROM capture_payments"
SQL["explode_order_gift_cards"] = "SELECT * FROM capture_gift_cards"
SQL["explode_order_cash"] = """SELECT k AS order_id, 1 AS tc_id, CASE WHEN k % 2 = 0 THEN 5.00 END AS tc_amt, 'oc-' || CAST(k AS VARCHAR) AS message_uuid
 FROM orders_z WHERE cash_c > 0 UNION ALL SELECT k, 2, NULL, 'oc-' || CAST(k AS VARCHAR) FROM orders_z WHERE cash_c > 0 AND k % 2 = 1"""
SQL["parse_membership_capture"] = "SELECT * FROM membership"
SQL["explode_membership_payments"] = "SELECT * FROM membership_payments"
SQL["explode_membership_gift_cards"] = "SELECT * FROM membership_gift_cards"
SQL["explode_assignments"] = "SELECT * FROM assignments"
LOCAL["held_parts"] = """SELECT id, CASE WHEN (CASE WHEN k % 8 = 3 THEN NULL ELSE k % 3 <> 0 END) = false AND EXISTS
 (SELECT 1 FROM capture_items c JOIN fc_xref f ON f.is_hj AND f.fc_id = (q.k + c.item_id - q.k * 8) % 6 + 1 WHERE c.order_id = q.k)
 THEN 'unprocessed' ELSE 'queue' END AS fate FROM q_of q"""
SQL["hold_partial_shipments"] = "SELECT * FROM held_parts"
SQL["parse_fulfillment"] = """SELECT uuid AS message_uuid, k AS order_id, 100000000 + k AS increment_id, custkey AS customer_id,
 CASE WHEN k % 4 = 1 THEN '[' || CAST(900000000 + k AS VARCHAR) || ']' END AS credit_memo_id, k % 4 <> 2 AS is_last_shipment,
 created_at + INTERVAL 72 HOUR AS updated_at FROM q_of"""
SQL["explode_fulfillment_items"] = """SELECT c.order_id, 100000000 + k AS increment_id, custkey AS customer_id, c.item_id,
 CASE WHEN k % 5 = 0 AND c.item_id > k * 8 + 1 THEN k * 8 + 1 END AS parent_item_id, k + c.item_id - k * 8 AS product_id, 'simple' AS product_type, c.sku,
 qty AS units_shipped, 0 AS units_shorted, '["' || CAST((k + c.item_id - k * 8) % 6 + 1 AS VARCHAR) || '"]' AS fc, CAST(k AS VARCHAR) AS shipment_id,
 'trk' || CAST(k AS VARCHAR) AS tracking_id, uuid AS message_uuid
 FROM q_of JOIN capture_items c ON c.order_id = k WHERE copy = 1 AND c.item_id % 25 <> 1"""
SQL["parse_credit_memo"] = "SELECT * FROM credits"
SQL["explode_credit_items"] = """SELECT i.* EXCLUDE (order_id), c.order_id FROM credit_items i JOIN credits c ON c.credit_id = i.credit_id"""
SQL["credit_refunds"] = "SELECT * FROM credit_refunds"
SQL["credit_gift_cards"] = "SELECT * FROM credit_gift_cards"
SQL["credit_cash"] = f"""SELECT credit_id, 1 AS tc_id, total_{CASH} AS tc_amt, message_uuid FROM credits WHERE total_{CASH} <> 0"""
_sent = {"ma": "WHERE k % 8 = 2"}
SQL["queue_commit"] = " UNION ALL ".join(
    f"SELECT {i} AS id, '{m}' AS message_type, CASE WHEN ({rest}) IN (1, 2) THEN 'queue' ELSE 'processed' END AS fate FROM {src} {_sent.get(m, '')}"
    for m, (src, _, i, rest) in _work.items())
SQL["queue_stream"] = """SELECT id, 'gca' AS message_type, CASE WHEN row_number() OVER (PARTITION BY dup_key ORDER BY copy, id) > 1 THEN 'error' ELSE 'queue' END AS fate FROM q_gca
 UNION ALL SELECT id, 'ocn', CASE WHEN copy > 1 THEN 'error' ELSE 'queue' END FROM q_ocn
 UNION ALL SELECT id, 'of', fate FROM held_parts""" + "".join(
    f" UNION ALL SELECT {i}, '{m}', 'queue' FROM {src} {_sent.get(m, '')}" for m, (src, _, i, rest) in _work.items() if m not in ("gca", "ocn", "of"))

# --------------------------------------------------------------------------- P
LOCAL["free_orders"] = f"SELECT DISTINCT order_id FROM capture_payments WHERE payment_gateway = '{ZERO_CHARGE}'"


def _cleared(condition):
    return "SELECT item_id, price, product_type, " + ", ".join(
        f"CASE WHEN {condition} THEN 0 ELSE {c} END AS {c}" for c in ("discount_amt", "base_discount_amt", "discount_percent")) + " FROM capture_items"


SQL["fix_zero_charge_discounts"] = _cleared("price = 0 AND order_id IN (SELECT order_id FROM free_orders)")
SQL["fix_gift_card_negative_discount"] = _cleared("coalesce(discount_amt, 0) < 0 AND product_type = 'aw_giftcard'")
SQL["reclassify_reshipment"] = """SELECT order_id, CASE WHEN order_id IN (SELECT order_id FROM free_orders) THEN 'Reshipment' ELSE order_type END AS order_type FROM capture"""
_label = "CASE WHEN coalesce(p.cc_type, '') <> '' THEN p.cc_type ELSE p.payment_gateway END"


def _post(source, moment, t, s, name, amount, order_type="h.order_type", extra="", tail=""):
    return f"""SELECT {t} AS tran_type, {s} AS tran_sub_type_id, '{name}' AS tran_sub_type, h.{moment} AS tran_date, {order_type} AS order_type, h.order_id,
 h.increment_id, h.customer_id, {amount} AS tran_amt, {pac('h.' + moment)} AS sale_date, {pac('h.' + moment)} AS tran_gl_date {extra}
 FROM {source} h {tail}"""


_card = f", p.cc_tran_id AS cc_auth, p.cc_last_four AS cc_last4, {_label} AS cc_type, coalesce(p.base_pay_amt, 0) AS cc_pay_amt, h.message_uuid"
SQL["post_order_payment"] = _post("capture", "created_at", 100, 6, "Payment Capture", "p.base_pay_amt", extra=_card,
                                  tail="LEFT JOIN capture_payments p ON p.order_id = h.order_id")
SQL["post_order_gift_card"] = _post(
    "capture", "created_at", 100, 9, "Gift Card Capture", "g.gift_card_amt",
    extra=""", 1 AS gc_type, CAST(g.gift_card_id AS BIGINT) AS gift_card_id,
 CASE coalesce(c.issue_type, l.issue_type) WHEN 'other' THEN 'Make-Good' WHEN 'make-good' THEN 'Make-Good' WHEN 'purchased' THEN 'Purchased'
  WHEN 'refund' THEN 'Refund' END AS gc_sub_type""",
    tail="""JOIN capture_gift_cards g ON g.order_id = h.order_id LEFT JOIN gift_cards c ON c.card_id = CAST(g.gift_card_id AS BIGINT)
 LEFT JOIN gift_cards_legacy l ON CAST(l.giftcard_id AS VARCHAR) = g.gift_card_id""")
for _n, _t, _s in (("product_tax", 105, 13), ("shipping_tax", 105, 28), ("fee_tax", 105, 95), ("donation", 400, 5)):
    SQL[f"post_{_n}"] = f"SELECT * FROM charges WHERE tran_sub_type_id = {_s}"
SQL["load_order_header"] = f"SELECT *, {AS_OF} AS ods_processed_at, {pac('created_at')} AS sale_date, 'open' AS status, {AS_OF} AS status_date, NULL AS gaap_sale_date FROM capture"
SQL["load_order_detail"] = f"SELECT i.*, {pac('c.created_at')} AS sale_date, NULL AS fulfillment_qty, NULL AS short_qty, NULL AS return_qty, NULL AS fulfillment_date FROM capture_items i JOIN capture c ON c.order_id = i.order_id"
SQL["load_order_discounts"] = "SELECT d.* FROM capture_discounts d JOIN capture c ON c.order_id = d.order_id"
SQL["load_order_payments"] = f"""SELECT p.*, {pac('c.created_at')} AS sale_date FROM (
 SELECT order_id, 'cc' AS payment_type, payment_id, payment_gateway, NULL AS gift_card_id, pay_amt, message_uuid FROM capture_payments
 UNION ALL SELECT order_id, 'gc', NULL, NULL, gift_card_id, gift_card_amt, message_uuid FROM capture_gift_cards
 UNION ALL SELECT order_id, 'tc', NULL, NULL, NULL, tc_amt, message_uuid FROM capture_cash) p JOIN capture c ON c.order_id = p.order_id"""
LOCAL["assigned_cost"] = """SELECT a.item_id, a.fc AS fc_id, a.qty_assigned, ci.net_unit_cost * i.qty_ordered AS ext_cost_amt
 FROM assignments a JOIN capture_items i ON i.item_id = a.item_id LEFT JOIN fc_xref f ON f.ns_fc_id = a.fc
 LEFT JOIN curr_items ci ON ci.item_name = i.sku AND ci.fc_id = coalesce(f.ods_fc_id, 2)"""
SQL["assignment_cost"] = "SELECT * FROM assigned_cost"
SQL["apply_assignment"] = """SELECT i.item_id, w.fc_id AS assignment_fc, w.qty_assigned AS assignment_qty, w.ext_cost_amt FROM capture_items i
 LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY fc_id, qty_assigned) AS rn FROM assigned_cost) w ON w.item_id = i.item_id AND w.rn = 1"""
_kind = "CASE start_status WHEN 'member' THEN 'Renewal' WHEN 'canceled' THEN 'Re-Activation' ELSE 'New Member' END"
SQL["post_membership_payment"] = _post("membership", "updated_at", 150, 10, "Payment Capture", "p.base_pay_amt", _kind, _card,
                                       "LEFT JOIN membership_payments p ON p.order_id = h.order_id")
SQL["post_membership_gift_card"] = _post("membership", "updated_at", 150, 21, "Gift Card Capture", "g.gift_card_amt", _kind,
                                         ", 'Purchased' AS gc_sub_type, 2 AS gc_type", "JOIN membership_gift_cards g ON g.order_id = h.order_id")
SQL["post_membership_tax"] = _post("membership", "updated_at", 155, 68, "Tax Capture", "h.base_total_tax", _kind, ", h.message_uuid",
                                   "WHERE h.base_total_tax > 0")
LOCAL["members"] = f"SELECT *, {pac('updated_at')} AS sale_date FROM membership"
SQL["load_membership_header"] = f"SELECT *, {AS_OF} AS ods_processed_at, NULL AS status, NULL AS status_date FROM members"
SQL["load_membership_payments"] = """SELECT p.*, m.sale_date FROM (SELECT order_id, 'cc' AS payment_type, payment_id, NULL AS gift_card_id, pay_amt FROM membership_payments
 UNION ALL SELECT order_id, 'gc', NULL, gift_card_id, gift_card_amt FROM membership_gift_cards) p JOIN members m ON m.order_id = p.order_id"""


def _cancels(headers):
    return f"""SELECT c.order_id, c.message_uuid, c.updated_at, h.sale_date, coalesce(c.ms_initiated, false) AS ms_initiated,
 coalesce(c.is_fraud, false) AS is_fraud, CASE WHEN c.refunds LIKE '%true%' THEN true WHEN c.refunds LIKE '%false%' THEN false END AS is_voided
 FROM cancels c JOIN {headers} h ON h.order_id = c.order_id"""


LOCAL["order_cancel_work"] = _cancels("order_header")
LOCAL["member_cancel_work"] = _cancels("members")
SQL["cancel_worklist"] = "SELECT * FROM order_cancel_work UNION ALL SELECT * FROM member_cancel_work"


def _reversal(ledger, work, types, auth="l.cc_auth", tail=""):
    return f"""SELECT l.tran_type + 10 AS tran_type, s.tran_sub_type_id, l.tran_sub_type || ' Cancel' AS tran_sub_type, w.updated_at AS tran_date, l.order_id,
 l.tran_amt, {auth} AS cc_auth, w.message_uuid, w.sale_date, {pac('w.updated_at')} AS tran_gl_date, 'void' AS cancel_type
 FROM {ledger} l JOIN {work} w ON w.order_id = l.order_id AND w.is_voided
 LEFT JOIN sub_types s ON s.tran_type = l.tran_type + 10 AND s.tran_sub_type = l.tran_sub_type || ' Cancel' {tail} WHERE l.tran_type IN ({types})"""


SQL["reverse_order_postings"] = _reversal("order_ledger", "order_cancel_work", "100, 105, 400")
SQL["reverse_membership_postings"] = _reversal("membership_ledger", "member_cancel_work", "150, 155", "coalesce(r.gateway_tran_id, l.cc_auth)",
                                               "LEFT JOIN member_refunds r ON r.order_id = l.order_id AND r.base_pay_amt = l.tran_amt")
SQL["cancel_order_status"] = """SELECT h.order_id, CASE WHEN w.order_id IS NULL THEN h.status WHEN w.is_voided THEN 'void' ELSE 'cancel' END AS status,
 coalesce(w.updated_at, h.status_date) AS status_date, coalesce(w.updated_at, h.updated_at) AS updated_at
 FROM order_header h LEFT JOIN order_cancel_work w ON w.order_id = h.order_id"""
SQL["cancel_membership_status"] = """SELECT m.order_id, CASE WHEN w.at IS NOT NULL THEN 'cancel' END AS status, w.at AS status_date, coalesce(w.at, m.updated_at) AS updated_at FROM members m
 LEFT JOIN (SELECT order_id, min(updated_at) AS at FROM member_cancel_work WHERE is_voided GROUP BY 1) w ON w.order_id = m.order_id"""

# --------------------------------------------------------------------------- F
LOCAL["fulfil_work"] = f"""SELECT h.order_id, max(c.credit_id) AS credit_id, max(h.updated_at) AS tran_date, max(o.sale_date) AS sale_date
 FROM ship_header h LEFT JOIN ship_detail d ON d.order_id = h.order_id AND d.message_uuid = h.message_uuid
 LEFT JOIN order_detail i ON i.item_id = d.item_id AND i.sale_date >= DATE '{G.CUTOFF}'
 LEFT JOIN ship_credits c ON '[' || CAST(c.credit_id AS VARCHAR) || ']' = h.credit_memo_id
 LEFT JOIN order_header o ON o.order_id = h.order_id GROUP BY h.order_id
 HAVING count(*) = count(i.item_id) AND (bool_or(h.is_last_shipment OR CAST(h.updated_at AS DATE) < CAST({AS_OF} AS DATE) - 7) OR max(o.gaap_sale_date) IS NOT NULL)"""
SQL["fulfillment_worklist"] = "SELECT * FROM fulfil_work"
SQL["stage_fulfillment"] = """SELECT h.order_id, o.increment_id, d.item_id, d.parent_item_id, f.ns_fc_id AS fc, CAST(trim(d.fc, '[]') AS BIGINT) AS store_fc, d.sku,
 d.units_shipped, i.qty_ordered, d.units_shorted, i.base_price, CASE WHEN coalesce(i.is_gwp, false) THEN 0 ELSE i.base_discount_amt END AS base_discount_amt,
 i.base_tax_amt, i.base_row_total, h.is_last_shipment, CASE WHEN c.qty_refunded > 0 THEN CAST(trim(h.credit_memo_id, '[]') AS BIGINT) END AS cm_id,
 c.qty_refunded, c.base_price AS credit_price, c.base_row_total_incl_tax - c.base_discount_amt AS credit_total_amt, t.tpa AS tpa_unit_amt, w.tran_date,
 o.sale_date, h.updated_at AS fulfilled_at, d.shipment_id, d.tracking_id
 FROM ship_header h JOIN fulfil_work w ON w.order_id = h.order_id JOIN ship_detail d ON d.order_id = h.order_id AND d.message_uuid = h.message_uuid
 JOIN order_header o ON o.order_id = h.order_id JOIN order_detail i ON i.item_id = d.item_id
 LEFT JOIN (SELECT item_id, sum(discount_amt) AS tpa FROM detail_discounts WHERE discount_type = 'tpa' AND discount_amt > 0 GROUP BY 1) t ON t.item_id = d.item_id
 LEFT JOIN ship_credit_items c ON c.credit_id = w.credit_id AND c.order_item_id = d.item_id
 LEFT JOIN fc_xref f ON f.fc_id = CAST(trim(d.fc, '[]') AS BIGINT)"""
SQL["retail_price_fallback"] = """SELECT s.item_id, s.sku, CASE WHEN coalesce(a.retail_price, b.retail_price, 0) > 0 THEN coalesce(a.retail_price, b.retail_price, 0)
 ELSE coalesce(a.net_unit_cost, b.net_unit_cost, 0) * 1.3 END::DECIMAL(12,4) AS retail_price
 FROM stage s LEFT JOIN fc_xref f ON f.fc_id = s.store_fc LEFT JOIN curr_items a ON a.item_name = s.sku AND a.fc_id = coalesce(f.ods_fc_id, 2)
 LEFT JOIN curr_items b ON b.item_name = s.sku AND b.fc_id = 2"""
# share to ten digits in whole-number arithmetic, as DuckDB divides decimals in floating point
LOCAL["parts"] = """SELECT s.item_id, s.parent_item_id, s.order_id, s.sku, s.fc, p.units_shipped * (p.base_price + p.base_discount_amt) AS bundle_total_amt,
 p.base_tax_amt AS bundle_tax_amt, p.base_discount_amt AS bundle_discount_amt,
 CAST(CASE WHEN w.w = 0 THEN 0 ELSE (2 * 10000000000::HUGEINT * CAST(s.units_shipped * s.retail_price * 10000 AS HUGEINT) + CAST(w.w * 10000 AS HUGEINT))
   // (2 * CAST(w.w * 10000 AS HUGEINT)) END AS DECIMAL(22,0)) * 0.0000000001 AS share
 FROM stage s JOIN stage p ON p.item_id = s.parent_item_id AND p.base_price > 0 AND p.units_shipped > 0
 JOIN (SELECT parent_item_id, sum(units_shipped * retail_price) AS w FROM stage WHERE parent_item_id IS NOT NULL GROUP BY 1) w ON w.parent_item_id = s.parent_item_id"""


def _part(amount):
    return f"CAST(round(CAST({amount} AS DECIMAL(14,4)) * CAST(share AS DECIMAL(12,10)), 2) AS DECIMAL(12,2))"


LOCAL["alloc"] = f"""SELECT *, {_part('bundle_total_amt')} AS alloc_revenue_amt, {_part('bundle_tax_amt')} AS alloc_tax_amt,
 {_part('bundle_discount_amt')} AS alloc_discount_amt FROM parts"""
SQL["allocate_bundle"] = "SELECT * FROM alloc"
_measures = {"revenue": "bundle_total_amt", "tax": "bundle_tax_amt", "discount": "bundle_discount_amt"}
LOCAL["oob"] = "SELECT parent_item_id, " + ", ".join(
    f"max({a}) AS {a}, sum(alloc_{m}_amt) AS {m}_amt, CAST(round((coalesce(max({a}), 0) - coalesce(sum(alloc_{m}_amt), 0)) * 100, 0) AS BIGINT) AS adj_{m}"
    for m, a in _measures.items()) + " FROM alloc GROUP BY 1"
SQL["bundle_out_of_balance"] = "SELECT * FROM oob"


def _fix(m):
    return f"""a.alloc_{m}_amt + CASE WHEN a.alloc_{m}_amt > 0 AND a.rn_{m} <= abs(o.adj_{m}) THEN sign(o.adj_{m}) * 0.01 ELSE 0 END"""


def _rank(group, amount, alias):
    return f"""sum(CASE WHEN {amount} > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY {group} ORDER BY {amount} DESC, item_id % 64, item_id
 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {alias}"""


LOCAL["balanced"] = ("SELECT a.item_id, a.parent_item_id, " + ", ".join(f"{_fix(m)} AS alloc_{m}_amt" for m in _measures)
                     + " FROM (SELECT *, " + ", ".join(_rank("parent_item_id", f"alloc_{m}_amt", f"rn_{m}") for m in _measures)
                     + " FROM alloc) a JOIN oob o ON o.parent_item_id = a.parent_item_id")
for _m in _measures:
    SQL[f"penny_fix_{_m}"] = "SELECT * FROM balanced"
LOCAL["stage_alloc"] = """SELECT s.*, b.alloc_revenue_amt AS allocated_price, b.alloc_discount_amt AS allocated_discount_amt, b.alloc_tax_amt AS allocated_tax_amt
 FROM stage s LEFT JOIN balanced b ON b.item_id = s.item_id"""
SQL["apply_allocation"] = "SELECT * FROM stage_alloc"
LOCAL["dsc_alloc"] = f"""SELECT p.item_id, p.parent_item_id, p.order_id, d.discount_id, d.base_amt_off_applied AS dsc_amt, d.rule_id, d.rule_name, d.rule_group, d.discount_type,
 {_part('d.base_amt_off_applied')} AS alloc_discount_amt
 FROM parts p JOIN detail_discounts d ON d.item_id = p.parent_item_id JOIN stage b ON b.item_id = d.item_id AND b.product_type = 'bundle'"""
SQL["allocate_bundle_discounts"] = "SELECT * FROM dsc_alloc"
LOCAL["dsc_oob"] = """SELECT parent_item_id, discount_id, max(dsc_amt) AS dsc_amt, sum(alloc_discount_amt) AS dtl_amt,
 CAST(round((coalesce(max(dsc_amt), 0) - sum(alloc_discount_amt)) * 100, 0) AS BIGINT) AS adj_discount FROM dsc_alloc GROUP BY 1, 2"""
SQL["discount_out_of_balance"] = "SELECT * FROM dsc_oob"
LOCAL["dsc_fixed"] = f"""SELECT a.* EXCLUDE (alloc_discount_amt), a.alloc_discount_amt + CASE WHEN a.alloc_discount_amt > 0 AND a.rn <= abs(o.adj_discount)
 THEN sign(o.adj_discount) * 0.01 ELSE 0 END AS alloc_discount_amt
 FROM (SELECT *, {_rank('parent_item_id, discount_id', 'alloc_discount_amt', 'rn')} FROM dsc_alloc) a
 JOIN dsc_oob o ON o.parent_item_id = a.parent_item_id AND o.discount_id = a.discount_id"""
SQL["penny_fix_rule_discount"] = SQL["bundle_discount_result"] = "SELECT * FROM dsc_fixed"

# --------------------------------------------------------------------------- L
_line = f"""s.tran_date, s.order_id, s.increment_id, s.item_id AS order_line_id, s.customer_id, s.fc AS location_id, s.store_fc AS magento_location_id, s.sku,
 s.parent_item_id, i.group_id, i.item_category_name AS category_name, i.class_id, i.subclass_name, s.units_shipped AS tran_qty, s.sale_date, i.item_id AS item_id,
 {pac('s.tran_date')} AS tran_gl_date, {pac('s.fulfilled_at')} AS ship_date"""
_item = "LEFT JOIN fc_xref f ON f.ns_fc_id = s.fc LEFT JOIN curr_items i ON i.item_name = s.sku AND i.fc_id = coalesce(f.ods_fc_id, 2)"
_out = "s.units_shipped > 0 AND s.product_type <> 'bundle'"
LOCAL["product_rows"] = f"""SELECT 300 AS tran_type, 16 AS tran_sub_type_id, 'Product' AS tran_sub_type, {_line},
 round(CAST(coalesce(s.allocated_price, s.qty_ordered * (s.base_price + coalesce(s.base_discount_amt, 0)) - coalesce(s.qty_refunded, 0) * coalesce(s.credit_price, 0))
  - (s.qty_ordered - s.units_shipped) * coalesce(s.tpa_unit_amt, 0) AS DECIMAL(30,6)), 2) AS tran_amt, s.qty_ordered * i.net_unit_cost AS tran_cost_amt
 FROM stage_alloc s {_item} WHERE {_out}"""
SQL["post_product_revenue"] = "SELECT * FROM product_rows"


def _discount(code, name, kind, amount, where, source="detail_discounts"):
    rule = "NULL AS rule_name, d.rule_name AS coupon_rule_name, d.rule_group AS coupon_group_code" if kind == "coupon" else \
        "d.rule_name, NULL AS coupon_rule_name, NULL AS coupon_group_code"
    return f"""SELECT 300 AS tran_type, {code} AS tran_sub_type_id, '{name}' AS tran_sub_type, {_line}, {amount} AS tran_amt, d.rule_id, {rule}
 FROM stage s JOIN {source} d ON d.item_id = s.item_id AND d.discount_type = '{kind}' {_item} WHERE {_out} {where}"""


_unit = "CASE WHEN s.units_shipped = d.units_applied THEN d.amt_off_applied ELSE round(CAST(s.units_shipped * d.discount_amt AS DECIMAL(24,6)), 2) END"
LOCAL["coupon_rows"] = _discount(69, "Coupon", "coupon", "d.amt_off_applied", "")
LOCAL["tpa_rows"] = _discount(48, "TPA", "tpa", _unit, "AND s.base_price > 0")
LOCAL["tiered_rows"] = _discount(98, "Tiered Pricing", "tiered_pricing", _unit, "AND s.base_price > 0")
LOCAL["coupon_bundle_rows"] = _discount(69, "Coupon", "coupon", "d.alloc_discount_amt", "", "dsc_fixed")
LOCAL["tpa_bundle_rows"] = _discount(48, "TPA", "tpa", "d.alloc_discount_amt", "", "dsc_fixed")
for _n, _c in (("coupon", "coupon_rows"), ("tpa", "tpa_rows"), ("tiered_pricing", "tiered_rows"), ("coupon_bundle", "coupon_bundle_rows"), ("tpa_bundle", "tpa_bundle_rows")):
    SQL[f"post_{_n}"] = f"SELECT * FROM {_c}"
LOCAL["last_out"] = "SELECT DISTINCT order_id, increment_id, customer_id, tran_date, sale_date FROM stage WHERE is_last_shipment"
SQL["post_make_good"] = f"""SELECT 300 AS tran_type, 64 AS tran_sub_type_id, 'Make-Good Discount' AS tran_sub_type, s.tran_date, p.pay_amt AS tran_amt,
 CAST(p.gift_card_id AS BIGINT) AS gift_card_id, 99 AS gc_type, 'Make-Good' AS gc_sub_type, s.order_id, s.increment_id,
 coalesce(h.reason_id, c.reason_id) AS gc_reason_id, coalesce(h.reason, c.reason) AS gc_reason_name, coalesce(h.group_code, c.group_code) AS gc_group_code,
 coalesce(h.group_name, c.group_name) AS gc_group_name, s.sale_date, {pac('s.tran_date')} AS tran_gl_date
 FROM order_payments p JOIN (SELECT DISTINCT order_id, increment_id, tran_date, sale_date FROM last_out) s ON s.order_id = p.order_id
 LEFT JOIN (SELECT card_id, issue_type, max(group_code) AS group_code, max(group_label) AS group_name, max(reason_id) AS reason_id, max(reason_label) AS reason
  FROM card_history GROUP BY 1, 2) h ON h.card_id = CAST(p.gift_card_id AS BIGINT)
 LEFT JOIN gift_cards c ON c.card_id = CAST(p.gift_card_id AS BIGINT)
 WHERE p.payment_type = 'gc' AND h.issue_type = 'Make-Good' AND p.sale_date >= DATE '{G.CUTOFF}'"""
LOCAL["ship_rows"] = " UNION ALL ".join(
    f"""SELECT 300 AS tran_type, {s} AS tran_sub_type_id, '{n}' AS tran_sub_type, l.tran_date, o.order_id, o.increment_id, o.customer_id, o.{a} AS tran_amt, l.sale_date,
 {pac('l.tran_date')} AS tran_gl_date FROM order_header o JOIN (SELECT DISTINCT order_id, tran_date, sale_date FROM last_out) l ON l.order_id = o.order_id WHERE o.{a} > 0"""
    for s, n, a in ((17, "Grocery Shipment", "grocery_base_shipment"), (70, "Frozen Shipment", "frozen_base_shipment"),
                    (71, "Wine Shipment", "wine_base_shipment"), (96, "PPE Revenue", "ppe_fee")))
SQL["post_shipment_revenue"] = "SELECT * FROM ship_rows"
SQL["post_cash_discount"] = f"""SELECT 300 AS tran_type, 62 AS tran_sub_type_id, '{CASH_DISCOUNT}' AS tran_sub_type, l.tran_date, l.order_id, l.increment_id, l.customer_id,
 p.pay_amt AS tran_amt, l.sale_date, {pac('l.tran_date')} AS tran_gl_date FROM last_out l JOIN order_payments p ON p.order_id = l.order_id AND p.payment_type = 'tc' AND p.pay_amt > 0"""
SQL["update_detail_fulfillment"] = f"""SELECT i.item_id, CASE WHEN s.item_id IS NOT NULL THEN {AS_OF} END AS ods_updated_at, CASE WHEN s.item_id IS NULL THEN i.fulfillment_qty ELSE s.units_shipped END AS fulfillment_qty,
 CASE WHEN s.item_id IS NULL THEN i.short_qty ELSE s.units_shorted END AS short_qty,
 CASE WHEN s.item_id IS NULL THEN i.fulfillment_date ELSE s.fulfilled_at END AS fulfillment_date FROM order_detail i
 LEFT JOIN (SELECT item_id, units_shipped, units_shorted, fulfilled_at FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY units_shipped, units_shorted, fulfilled_at) AS rn FROM stage)
  WHERE rn = 1) s ON s.item_id = i.item_id"""
SQL["update_header_shipped"] = f"""SELECT o.order_id, CASE WHEN d.at IS NOT NULL AND o.gaap_sale_date IS NULL THEN 'shipped' ELSE o.status END AS status,
 CASE WHEN d.at IS NOT NULL AND o.gaap_sale_date IS NULL THEN d.at ELSE o.status_date END AS status_date, CASE WHEN o.gaap_sale_date IS NULL THEN {pac('d.at')} ELSE o.gaap_sale_date END AS gaap_sale_date,
 CASE WHEN d.at IS NOT NULL AND o.gaap_sale_date IS NULL THEN {AS_OF} ELSE o.updated_at END AS updated_at
 FROM order_header o LEFT JOIN (SELECT order_id, max(fulfilled_at) AS at FROM stage WHERE is_last_shipment GROUP BY 1) d ON d.order_id = o.order_id"""
SQL["post_gift_card_sale"] = f"""SELECT CASE WHEN g.card_type = 1 THEN 310 ELSE 320 END AS tran_type, CASE WHEN g.card_type = 1 THEN 30 ELSE 32 END AS tran_sub_type_id,
 g.updated_at AS tran_date, i.base_price AS tran_amt, i.base_original_price AS tran_full_price, i.base_discount_amt AS tran_discount_amt, g.card_id AS gift_card_id,
 g.card_type AS gc_type, i.order_id, g.item_id AS order_line_id, o.increment_id, o.sale_date, {pac('g.updated_at')} AS tran_gl_date
 FROM gift_sales g JOIN created_cards c ON c.card_id = g.card_id AND c.action_label = 'Created' JOIN order_detail i ON i.item_id = g.item_id
 JOIN order_header o ON o.order_id = i.order_id"""
SQL["gift_card_fulfillment_updates"] = f"""SELECT 'detail' AS kind, item_id AS key, CASE WHEN item_id IN (SELECT item_id FROM gift_sales) THEN '1/' || CAST({AS_OF} AS VARCHAR)
 ELSE coalesce(CAST(fulfillment_qty AS VARCHAR), '') END AS value FROM order_detail UNION ALL SELECT 'header', order_id, CASE WHEN order_id IN (SELECT g.order_id FROM gift_sales g JOIN order_detail i ON i.item_id = g.item_id)
 THEN CAST({AS_OF} AS VARCHAR) ELSE CAST(updated_at AS VARCHAR) END FROM order_header
 UNION ALL SELECT 'card', card_id, CAST(increment_id AS VARCHAR) || '/' || CAST(card_type AS VARCHAR) || '/' || message_uuid FROM gift_sales
 WHERE item_id IN (SELECT item_id FROM order_detail)"""

# --------------------------------------------------------------------------- C
_cut = "(SELECT int_value FROM control WHERE control_name = 'pre_ods_order_id')"
_pre = "c.order_has_shipped = 'false' AND coalesce(c.base_total_product, 0) > 0"
_after = "(c.order_has_shipped = 'true' OR coalesce(c.base_total_product, 0) = 0)"
_legacy = "SELECT c.*, '{0}' AS route, DATE '2021-01-01' AS sale_date, c.customer_id AS owner, c.increment_id AS owner_inc FROM credits c WHERE {1} AND c.order_id < " + _cut
_now = "SELECT c.*, '{0}' AS route, o.sale_date, o.customer_id AS owner, o.increment_id AS owner_inc FROM credits c JOIN order_header o ON o.order_id = c.order_id WHERE {1} AND c.order_id >= " + _cut
LOCAL["routed"] = " UNION ALL ".join((
    _legacy.format("legacy_preship", _pre), _legacy.format("legacy_postship", _after), _now.format("preship", _pre), _now.format("postship", _after),
    "SELECT c.*, 'membership' AS route, m.sale_date, m.customer_id AS owner, CAST(m.increment_id AS VARCHAR) AS owner_inc FROM credits c"
    f" JOIN members m ON m.order_id = c.order_id WHERE c.order_id >= {_cut}"))
SQL["credit_worklists"] = "SELECT * FROM routed"
SQL["post_preship_items"] = f"""SELECT 365 AS tran_type, 82 AS tran_sub_type_id, r.updated_at AS tran_date, r.order_id, l.order_item_id AS order_line_id, r.increment_id,
 l.qty_refunded AS tran_qty, l.qty_refunded * l.base_price - coalesce(l.base_discount_amt, 0) + coalesce(l.base_tax_amt, 0) AS tran_amt,
 CASE WHEN r.route = 'preship' THEN l.qty_refunded * l.base_price - coalesce(l.discount_amt, 0) ELSE l.qty_refunded * l.base_price END AS tran_full_price,
 coalesce(l.tax_amt, 0) AS tran_tax_amt, CASE WHEN r.route = 'legacy_preship' THEN coalesce(l.discount_amt, 0) END AS tran_discount_amt, i.group_id, i.class_name,
 d.sku, i.item_id, r.credit_id AS credit_memo_id, r.sale_date, {pac('r.updated_at')} AS tran_gl_date
 FROM routed r LEFT JOIN credit_items l ON l.credit_id = r.credit_id LEFT JOIN order_detail d ON d.item_id = l.order_item_id
 LEFT JOIN fc_xref f ON f.ns_fc_id = d.assignment_fc LEFT JOIN curr_items i ON i.item_name = l.sku AND i.fc_id = coalesce(f.ods_fc_id, 2)
 WHERE r.route IN ('preship', 'legacy_preship')"""
_number = "CAST(split_part(r.increment_id, '-', 1) AS BIGINT)"
_prod = "r.base_total_product > 0"
_refund_head = f"r.updated_at AS tran_date, r.order_id, r.credit_id AS credit_memo_id, r.sale_date, {pac('r.updated_at')} AS tran_gl_date, r.base_total_tax AS tran_tax_amt"
_goods = f"""r.base_total_product - r.base_total_gift_cards + r.base_donations + r.ppe_fee + (r.base_shipment {{0}} - coalesce(r.base_frozen_shipment, 0) {{1}}
 - coalesce(r.base_wine_shipment, 0) {{2}}) + r.base_total_discount + r.base_adjustment - r.total_{CASH}"""


def _money_back(route, kind, sub, name, full, who, reason="NULL"):
    return f"""SELECT {kind} AS tran_type, {sub} AS tran_sub_type_id, {name} AS tran_sub_type, {_refund_head}, r.{'owner' if who else 'customer_id'} AS customer_id,
 r.{'owner_inc' if who else 'increment_id'} AS increment_id, p.base_pay_amt AS tran_amt, {full} AS tran_full_price, p.gateway_tran_id AS cc_auth, p.cc_type, {reason} AS refund_reason
 FROM routed r JOIN credit_refunds p ON p.credit_id = r.credit_id AND p.base_pay_amt > 0 WHERE r.route = '{route}'"""


_refunded = f"CASE WHEN {_prod} THEN 'Refund Capture' ELSE 'Appeasement Capture' END"
_old = f"{_number} > 99999999"
SQL["post_preship_refund"] = _money_back("preship", 365, 38, "'Refund Capture'", _goods.format("", "", ""), False, "'Short Shipment'") + " UNION ALL " + _money_back(
    "legacy_preship", f"CASE WHEN {_old} THEN 365 ELSE 380 END", f"CASE WHEN {_old} THEN 38 ELSE 84 END", "'Refund Capture'",
    _goods.format("- r.base_shipment_tax", "- coalesce(r.base_frozen_shipment_tax, 0)", "- coalesce(r.base_wine_shipment_tax, 0)"), False, "'Short Shipment'")
SQL["post_postship_refund"] = _money_back(
    "postship", 360, f"CASE WHEN {_prod} THEN 81 ELSE 78 END", _refunded, "p.base_pay_amt - coalesce(r.base_total_tax, 0)", True) + " UNION ALL " + _money_back(
    "legacy_postship", f"CASE WHEN {_old} THEN 360 ELSE 380 END",
    f"CASE WHEN {_old} AND {_prod} THEN 81 WHEN {_old} THEN 78 WHEN {_prod} THEN 84 ELSE 83 END", _refunded, "p.base_pay_amt - r.base_total_tax", False)
SQL["post_membership_refund"] = _money_back(
    "membership", 380, f"CASE WHEN {_prod} THEN 84 ELSE 83 END", _refunded,
    "p.base_pay_amt - coalesce(r.base_total_tax, 0) - coalesce(r.base_total_gift_cards, 0) + r.base_donations + r.base_shipment", True)


def _card_back(route, kind, sub, name, full):
    return f"""SELECT {kind} AS tran_type, {sub} AS tran_sub_type_id, {name} AS tran_sub_type, {_refund_head}, r.owner AS customer_id, r.owner_inc AS increment_id,
 g.gift_card_amt AS tran_amt, {full} AS tran_full_price, CAST(g.gift_card_id AS BIGINT) AS gift_card_id, a.reason_id AS gc_reason_id, a.reason_label AS gc_reason_name,
 a.group_label AS gc_group_name, a.group_code AS gc_group_code, 'refund' AS gc_sub_type
 FROM routed r JOIN credit_gift_cards g ON g.credit_id = r.credit_id AND CAST(g.gift_card_id AS BIGINT) > 0 AND g.gift_card_amt > 0
 LEFT JOIN created_cards a ON a.card_id = CAST(g.gift_card_id AS BIGINT) AND a.action_label = 'Created' WHERE r.route = '{route}'"""


_carded = f"CASE WHEN {_prod} THEN 'Gift Card' ELSE 'Gift Card Appeasement' END"
_after_tax, _raw_tax = "g.gift_card_amt - coalesce(r.base_total_tax, 0)", "g.gift_card_amt - r.base_total_tax"
SQL["post_preship_gift_card"] = _card_back("preship", 365, 36, "'Gift Card'", _after_tax) + " UNION ALL " + _card_back(
    "legacy_preship", f"CASE WHEN {_old} THEN 360 ELSE 380 END", f"CASE WHEN {_old} THEN 79 ELSE 23 END", "'Gift Card'", _raw_tax)
SQL["post_postship_gift_card"] = _card_back("postship", 360, f"CASE WHEN {_prod} THEN 79 ELSE 80 END", _carded, _after_tax) + " UNION ALL " + _card_back(
    "legacy_postship", f"CASE WHEN {_old} THEN 360 ELSE 380 END",
    f"CASE WHEN {_old} AND {_prod} THEN 79 WHEN {_old} THEN 80 WHEN {_prod} THEN 23 ELSE 92 END", _carded, _raw_tax)
SQL["post_membership_refund_gift_card"] = _card_back("membership", 380, f"CASE WHEN {_prod} THEN 23 ELSE 92 END", _carded, _after_tax)
SQL["new_refund_gift_cards"] = """SELECT CAST(g.gift_card_id AS BIGINT) AS card_id, CASE WHEN r.route = 'membership' THEN 2 ELSE 1 END AS card_type, g.gift_card_amt AS initial_amount,
 r.order_id, r.increment_id AS order_increment_id, r.updated_at AS created_at, r.message_uuid AS source_uuid
 FROM routed r JOIN credit_gift_cards g ON g.credit_id = r.credit_id WHERE r.route IN ('legacy_postship', 'postship', 'membership')
 AND CAST(g.gift_card_id AS BIGINT) > 0 AND g.gift_card_amt > 0 AND CAST(g.gift_card_id AS BIGINT) NOT IN (SELECT card_id FROM gift_cards)"""
SQL["load_credit_memo_tables"] = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, credit_id, CAST({d} AS VARCHAR) AS detail FROM {t} WHERE credit_id IN (SELECT credit_id FROM routed)"
    for n, t, d in (("credit_memo", "credits", "increment_id"), ("credit_memo_items", "credit_items", "order_item_id"),
                    ("credit_memo_refunds", "credit_refunds", "payment_id"), ("credit_memo_gift_cards", "credit_gift_cards", "gift_card_id")))
SQL["post_membership_redemption"] = f"""SELECT 500 AS tran_type, 94 AS tran_sub_type_id, updated_at AS tran_date, customer_id, -card_delta AS tran_amt, card_id AS gift_card_id,
 reason_id AS gc_reason_id, group_code AS gc_group_code, {pac('updated_at')} AS tran_gl_date, subscription_start_date AS start_date, subscription_end_date AS end_date
 FROM card_moves WHERE CAST(action AS INT) = 2 AND subscription_start_date IS NOT NULL"""
SQL["gift_card_adjustment_enrich"] = """SELECT a.card_id, h.billing_state, m.credit_id, m.credit_increment_id AS cm_increment_id, m.increment_id, a.updated_at,
 CASE WHEN CAST(a.updated_at AS DATE) + 20 < CAST(a.expire_at AS DATE) THEN a.expire_at END AS expire_at, a.action, o.increment_id AS redeeming_increment_id,
 o.customer_id AS redeeming_cust_id, s.increment_id AS purchasing_increment_id, h.customer_id, t.issue_type, a.group_code, a.card_delta, a.card_amt,
 CASE WHEN m.gift_card_id IS NOT NULL THEN 1 ELSE s.card_type END AS card_type
 FROM card_moves a LEFT JOIN card_types t ON t.group_code = coalesce(a.group_code, '') LEFT JOIN sold_cards s ON s.card_id = a.card_id
 LEFT JOIN (SELECT gift_card_id, min(credit_id) AS credit_id, min(credit_increment_id) AS credit_increment_id, min(increment_id) AS increment_id
  FROM credited_cards GROUP BY 1) m ON m.gift_card_id = a.card_id
 LEFT JOIN order_header h ON h.increment_id = coalesce(s.increment_id, m.increment_id)
 LEFT JOIN redeem_orders o ON o.gift_card_id = a.card_id AND a.updated_at BETWEEN o.created_at AND o.created_at + INTERVAL 30 SECOND
  AND round(CAST(a.card_delta AS DECIMAL(14,4)), 2) = round(CAST(o.pay_amt AS DECIMAL(14,4)), 2)"""

# --------------------------------------------------------------------------- V
LOCAL["newest_contact"] = "SELECT brand_records_id, max(contact_id) AS contact_id FROM contact_map GROUP BY 1"


def _mail(brand):
    return f"""LEFT JOIN vendor_map vm ON vm.brand_records_id = {brand} LEFT JOIN newest_contact nc ON nc.brand_records_id = {brand}
 LEFT JOIN contacts ct ON ct.contact_id = nc.contact_id LEFT JOIN erp_customers cu ON cu.customer_id = b.billing_customer_id
 LEFT JOIN erp_vendors ve ON ve.vendor_id = vm.vendor_id"""


_named = "LEFT JOIN erp_customers cn ON cn.name = b.brand_records_name LEFT JOIN erp_vendors vn ON vn.name = b.brand_records_name"
SQL["rebate_agreement_extract"] = f"""SELECT a.rebate_agreement_id, st.list_item_name AS active_status, bp.list_item_name AS billing_period, rt.list_item_name AS rebate_type,
 b.brand_records_name, a.start_date, a.percentage, a.item_id, b.billing_method_id, b.billing_customer_id, vm.vendor_id,
 CASE WHEN a.item_id IS NULL THEN 'By Brand' ELSE 'By SKU' END AS brand_sku, coalesce(ct.email, cu.email, ve.email, cn.email, vn.email) AS brandemail
 FROM agreements a LEFT JOIN period_list bp ON bp.list_id = a.billing_period_id LEFT JOIN status_list st ON st.list_id = a.active_status_id
 LEFT JOIN rebate_types rt ON rt.list_id = a.type_id LEFT JOIN brand_records b ON b.brand_records_id = a.brand_id {_mail('a.brand_id')} {_named} WHERE a.type_id = 1"""
SQL["brand_extract"] = f"""SELECT b.brand_records_id, b.brand_records_name, bm.list_item_name AS billing_method, vm.vendor_id,
 coalesce(ct.email, cu.email, ve.email, cn.email, vn.email) AS brand_email
 FROM brand_records b LEFT JOIN billing_method bm ON bm.list_id = b.billing_method_id {_mail('b.brand_records_id')} {_named}"""
SQL["brand_marketing_extract"] = f"""SELECT m.bm_id, ty.list_item_name AS asset_type, em.email AS mm_email, em.full_name AS mm_name, em.jobtitle, b.brand_records_name,
 b.billing_customer_id, vm.vendor_id AS billing_vendor_id, cu.companyname, cu.email AS customer_email, bl.list_item_name AS billing_method,
 coalesce(ct.email, cu.email, ve.email) AS brandemail, m.total_cost, m.billing_month_id, m.start_date, m.vendor_funding_item, {AS_OF} AS ods_processed_date
 FROM brand_marketing m LEFT JOIN employees em ON em.employee_id = m.merch_marketing_contact_id LEFT JOIN brand_records b ON b.brand_records_id = m.brand_id
 LEFT JOIN billing_method bl ON bl.list_id = b.billing_method_id LEFT JOIN asset_types ty ON ty.list_id = m.asset_type_id {_mail('m.brand_id')}"""
_terms = ("start_date", "end_date", "percentage", "dollar_amount", "billing_period", "brand_sku", "billing_method_id")


def _fall(live, item, brand, inactive):
    """(joins, columns) of the four levels."""
    terms = ", ".join(("item_id", "brand_id", *_terms))
    levels = (("v1", "item_id IS NOT NULL", 1, f"v1.item_id = {item}"), ("v2", "item_id IS NOT NULL", inactive, f"v2.item_id = {item}"),
              ("v3", "item_id IS NULL", 1, f"v3.brand_id = {brand}"), ("v4", "item_id IS NULL", inactive, f"v4.brand_id = {brand}"))
    # an active level keeps agreements with equal terms apart
    joins = " ".join(f"LEFT JOIN (SELECT DISTINCT {terms}{', rebate_agreement_id' if status == 1 else ''} FROM agreements WHERE {scope} AND active_status_id = {status} AND {live}) {v} ON {on}"
                     for v, scope, status, on in levels)
    cols = {c: f"coalesce(v1.{c}, v2.{c}, v3.{c}, v4.{c})" for c in _terms}
    return joins, cols


def _term_columns(c):
    return f"""{c['start_date']} AS rebate_start_date, {c['end_date']} AS rebate_end_date, {c['percentage']} AS rebate_percentage, {c['dollar_amount']} AS rebate_dollar_amount,
 {c['billing_period']} AS rebate_billing_period, {c['brand_sku']} AS rebate_type, {c['billing_method_id']} AS rebate_billing_method,
 CASE WHEN {c['dollar_amount']} IS NOT NULL THEN 'Dollar Amount (unit)' WHEN {c['percentage']} IS NOT NULL THEN 'Percentage of COGS' END AS rebate_calc_type"""


def _rebate(c, moment, cost, units):
    inside = f"{moment} >= {c['start_date']} AND ({moment} <= {c['end_date']} OR {c['end_date']} IS NULL)"
    return f"""CASE WHEN {inside} AND {c['percentage']} IS NOT NULL THEN round(CAST({c['percentage']} * 0.01 AS DECIMAL(14,6)) * CAST({cost} AS DECIMAL(16,4)), 4)
 WHEN {inside} AND {c['dollar_amount']} IS NOT NULL THEN round(CAST({c['dollar_amount']} * {units} AS DECIMAL(30,6)), 4) END"""


_live_strict = f"start_date < {AS_OF} AND end_date > {AS_OF}"
_live_first = f"start_date <= {AS_OF} AND end_date > {AS_OF}"
_live_range = f"start_date < {END} AND end_date > {START}"
_j, _c = _fall(_live_strict, "i.item_id", "i.brand_id", 8)
SQL["rebate_waterfall"] = f"""SELECT s.item_id AS order_line_id, {_term_columns(_c)}, {_c['brand_sku']} AS rebate_brand_sku, {_c['billing_method_id']} AS rebate_billing_method_id
 FROM stage s {_item} {_j}"""
SQL["post_vendor_rebate"] = f"""SELECT * FROM (SELECT 300 AS tran_type, 111 AS tran_sub_type_id, 'Vendor Rebates' AS tran_sub_type, {_line},
 {_rebate(_c, loc('s.tran_date'), 's.units_shipped * i.net_unit_cost', 's.units_shipped')} AS rebate_total, s.units_shipped * i.net_unit_cost AS tran_cost_amt,
 {_term_columns(_c)} FROM stage s {_item} {_j} WHERE {_out}), LATERAL (SELECT rebate_total AS tran_amt) WHERE rebate_start_date IS NOT NULL AND rebate_total IS NOT NULL"""
_j6, _c6 = _fall(_live_range, "l.item_id", "i.brand_id", 2)
_posted = f"""FROM ledger l LEFT JOIN fc_xref f ON f.ns_fc_id = l.location_id LEFT JOIN curr_items i ON i.item_id = l.item_id AND i.fc_id = f.ods_fc_id {_j6}
 WHERE l.tran_gl_date BETWEEN {START} AND {END} AND l.tran_sub_type_id = 16 AND l.tran_type = 300 AND f.fc_type <> 'drinks' AND {_c6['start_date']} IS NOT NULL"""
SQL["backfill_rebates"] = f"""SELECT 111 AS tran_sub_type_id, l.tran_date, l.order_line_id, l.sku, l.tran_qty, round(l.tran_cogs_amt, 2) AS tran_cogs_amt,
 {_rebate(_c6, 'l.tran_date', 'round(l.tran_cogs_amt, 2)', 'l.tran_qty')} AS tran_amt, l.tran_id AS fulfillment_tran_id, l.order_id, l.customer_id, l.tran_gl_date, l.magento_location_id, l.group_id, {_term_columns(_c6)} {_posted}"""
SQL["rebate_cost_comparison"] = f"""SELECT sku, sum(tran_qty) AS quantity, sum(tran_cogs_amt) AS cogs, sum(tran_cost_amt) AS pb_cogs, sum(actual) AS fifo_rebate, sum(book) AS pb_rebate,
 rebate_start_date, rebate_end_date, rebate_percentage, rebate_dollar_amount, rebate_billing_period, rebate_type, rebate_calc_type, rebate_billing_method
 FROM (SELECT l.sku, l.tran_qty, l.tran_cogs_amt, l.tran_cost_amt, {_rebate(_c6, 'l.tran_date', 'l.tran_cogs_amt', 'l.tran_qty')} AS actual,
  {_rebate(_c6, 'l.tran_date', 'l.tran_cost_amt', 'l.tran_qty')} AS book, {_term_columns(_c6)} {_posted}) GROUP BY ALL"""
SQL["cost_adjustment_header"] = f"""SELECT * FROM adj_headers WHERE trandate BETWEEN {START} AND {END}
 AND transaction_id IN (SELECT transaction_id FROM adj_lines WHERE memo = 'Cost of Sales Adjustment')"""
SQL["cost_adjustment_detail"] = f"""SELECT l.* FROM adj_lines l JOIN adj_headers h ON h.transaction_id = l.transaction_id
 WHERE l.memo = 'Cost of Sales Adjustment' AND h.trandate BETWEEN {START} AND {END}"""
_j9, _c9 = _fall(_live_first, "d.item_id", "i.brand_id", 2)
_value9 = _rebate(_c9, "CAST(h.trandate AS TIMESTAMP)", "d.amount", "0")
SQL["post_cost_adjustment_rebate"] = f"""SELECT i.item_name AS sku, 111 AS tran_sub_type_id, CAST(h.trandate AS TIMESTAMP) AS tran_date, d.amount AS tran_cogs_amt, d.item_id, d.location_id,
 {_value9} AS tran_amt, {_value9} AS rebate_total, h.transaction_id AS ns_tran_id, {_term_columns(_c9)}
 FROM adj_lines d JOIN adj_headers h ON h.transaction_id = d.transaction_id LEFT JOIN fc_xref f ON f.ns_fc_id = d.location_id
 LEFT JOIN curr_items i ON i.item_id = d.item_id AND i.fc_id = f.ods_fc_id {_j9}
 WHERE d.account_id = 279 AND {_c9['percentage']} IS NOT NULL AND h.trandate < {AS_OF} AND NOT EXISTS (SELECT 1 FROM ledger_adjusted x WHERE x.ns_tran_id = d.transaction_id)"""


def _funding(code, name, like, key):
    return f"""SELECT {code} AS tran_sub_type_id, '{name}' AS tran_sub_type, l.order_id, l.order_line_id, l.parent_item_id, l.sku, l.tran_qty, l.tran_amt AS tran_discount_amt,
 l.rule_id, l.item_id, l.tran_id AS fulfillment_tran_id, d.sponsored_percentage AS rebate_percentage, b.billing_method_id AS rebate_billing_method,
 {AS_OF} AS created_at, l.magento_location_id, NULL AS group_name, NULL AS ship_date, l.tran_amt * CAST(CAST(d.sponsored_percentage AS DECIMAL(9,4)) * 0.01 AS DECIMAL(11,6)) AS rebate_total,
 l.tran_amt * CAST(CAST(d.sponsored_percentage AS DECIMAL(9,4)) * 0.01 AS DECIMAL(11,6)) AS tran_amt, l.tran_gl_date
 FROM ledger l JOIN detail_discounts d ON d.item_id = l.{key} AND d.rule_id = l.rule_id LEFT JOIN fc_xref f ON f.fc_id = l.magento_location_id
 LEFT JOIN curr_items i ON i.item_name = l.sku AND i.fc_id = coalesce(f.ods_fc_id, 2) LEFT JOIN brand_records b ON b.brand_records_id = i.brand_id
 WHERE l.tran_sub_type_id = 48 AND d.sponsored_by IN ('Brand', 'Both') AND d.discount_type = 'tpa' AND d.rule_name {like} 'A&S%' AND b.billing_method_id IN (1, 2, 3)
 AND i.vendor_type <> 'Private Label' AND NOT EXISTS (SELECT 1 FROM ledger x WHERE x.tran_sub_type_id = {code} AND x.order_id = l.order_id AND x.order_line_id = l.order_line_id)"""


SQL["post_tpr_funding"] = _funding(113, "TPR Vendor Funding", "NOT LIKE", "order_line_id")
SQL["post_tpr_funding_bundle"] = _funding(113, "TPR Vendor Funding", "NOT LIKE", "parent_item_id")
SQL["post_as_funding"] = _funding(114, "A&S Vendor Funding", "LIKE", "order_line_id")
SQL["post_as_funding_bundle"] = _funding(114, "A&S Vendor Funding", "LIKE", "parent_item_id")
SQL["post_brand_marketing_fee"] = """SELECT 300 AS tran_type, 112 AS tran_sub_type_id, 'Brand Marketing Fees' AS tran_sub_type, CAST(start_date AS TIMESTAMP) AS tran_date,
 CAST(ods_processed_date AS TIMESTAMP) AS created_at, start_date AS tran_gl_date, total_cost AS tran_amt, bm_id AS brand_marketing_id
 FROM brand_marketing WHERE start_date IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ledger l WHERE l.brand_marketing_id = bm_id)"""

# --------------------------------------------------------------------------- R
_parts1 = ("total_product grocery_base_shipment frozen_base_shipment wine_base_shipment grocery_base_shipment_tax frozen_base_shipment_tax"
           " wine_base_shipment_tax base_donations ppe_fee ppe_fee_tax product_tax").split()
SQL["check_order_payment"] = f"""SELECT order_id, increment_id, {pac('created_at')} AS sale_date, expected_payment, total_paid, coalesce(pay_amt, 0) AS pay_amt,
 coalesce(gift_card_amt, 0) AS gift_card_amt, coalesce(tc_amt, 0) AS tc_amt, coalesce(total_order, 0) AS total_order, total_product, coalesce(product_tax, 0) AS product_tax,
 coalesce(ppe_fee, 0) AS ppe_fee, 'order' AS order_type FROM (SELECT h.*, i.total_product, i.product_tax, p.pay_amt, g.gift_card_amt, c.tc_amt,
 {' + '.join(nz(x) for x in _parts1)} AS expected_payment, coalesce(pay_amt, 0) + coalesce(gift_card_amt, 0) + coalesce(tc_amt, 0) AS total_paid
 FROM capture h JOIN (SELECT order_id, sum(base_row_total) AS total_product, sum(tax_amt) AS product_tax FROM capture_items GROUP BY 1) i ON i.order_id = h.order_id
 LEFT JOIN capture_payments p ON p.order_id = h.order_id LEFT JOIN (SELECT order_id, sum(gift_card_amt) AS gift_card_amt FROM capture_gift_cards GROUP BY 1) g ON g.order_id = h.order_id
 LEFT JOIN (SELECT order_id, sum(tc_amt) AS tc_amt FROM capture_cash WHERE tc_amt > 0 GROUP BY 1) c ON c.order_id = h.order_id) WHERE expected_payment <> total_paid"""
SQL["check_membership_payment"] = f"""SELECT h.order_id, h.increment_id, {pac('h.updated_at')} AS sale_date, coalesce(h.total_order, 0) AS expected_payment, coalesce(p.pay_amt, 0) AS total_paid,
 coalesce(p.pay_amt, 0) AS pay_amt, coalesce(h.total_order, 0) AS total_order, 0 AS gift_card_amt, 0 AS tc_amt, 0 AS grocery_base_shipment, 0 AS wine_base_shipment_tax,
 0 AS base_donations, 0 AS ppe_fee, coalesce(h.total_order, 0) - coalesce(h.total_tax, 0) AS total_product, coalesce(h.total_tax, 0) AS product_tax, 'membership' AS order_type
 FROM membership h LEFT JOIN membership_payments p ON p.order_id = h.order_id WHERE coalesce(h.total_order, 0) <> coalesce(p.pay_amt, 0)"""
LOCAL["disc"] = f"""SELECT i.order_id, h.increment_id, i.item_id, {pac('h.created_at')} AS sale_date, i.base_price, round(CAST(i.base_discount_amt * i.qty_ordered AS DECIMAL(24,6)), 2) AS base_discount_amt,
 coalesce(d.tpa, 0) AS disc_tpa_amt, coalesce(d.coupon, 0) AS disc_coupon_amt, coalesce(d.tiered, 0) AS disc_tiered_pricing_amt, coalesce(d.total, 0) AS disc_total_amt,
 coalesce(d.total, 0) - round(CAST(i.base_discount_amt * i.qty_ordered AS DECIMAL(24,6)), 2) AS var,
 CASE WHEN coalesce(i.parent_item_id, '0') <> '0' THEN 'component' ELSE i.product_type END AS product_type
 FROM capture_items i JOIN capture h ON h.order_id = i.order_id LEFT JOIN capture_payments p ON p.order_id = i.order_id
 LEFT JOIN (SELECT item_id, sum(CASE WHEN discount_type = 'tpa' THEN base_amt_off_applied ELSE 0 END) AS tpa, sum(CASE WHEN discount_type = 'coupon' THEN base_amt_off_applied ELSE 0 END) AS coupon,
  sum(CASE WHEN discount_type = 'tiered_pricing' THEN base_amt_off_applied ELSE 0 END) AS tiered, sum(coalesce(amt_off_applied, 0)) AS total FROM capture_discounts GROUP BY 1) d ON d.item_id = i.item_id
 WHERE i.is_gwp = 'false' AND p.payment_gateway <> '{ZERO_CHARGE}'"""
SQL["check_discount_detail_over"] = "SELECT *, 1 AS error_code FROM disc WHERE round(var, 0) > 0 AND base_discount_amt >= 0"
SQL["check_discount_item_over"] = "SELECT *, 2 AS error_code FROM disc WHERE round(-var, 0) > 0 AND base_discount_amt >= 0 AND base_price <> 0"
SQL["check_negative_discount"] = "SELECT *, 3 AS error_code FROM disc WHERE base_discount_amt < 0"
_parts6 = "base_total_product base_total_discount base_adjustment base_total_tax base_donations base_shipment base_frozen_shipment base_wine_shipment ppe_fee".split()
_shown6 = ("base_total_credit base_total_refund base_total_gift_cards base_total_product base_total_discount base_adjustment base_total_tax base_donations base_shipment"
           " base_shipment_tax base_frozen_shipment base_frozen_shipment_tax base_wine_shipment base_wine_shipment_tax ppe_fee ppe_fee_tax").split()
SQL["check_credit_memo"] = f"""SELECT * FROM (SELECT c.credit_id, c.credit_increment_id, c.order_id, c.increment_id, {pac('c.updated_at')} AS credit_date, coalesce(g.gc_amt, 0) AS gc_amt,
 coalesce(p.pay_amt, 0) AS pay_amt, {' + '.join(nz('c.' + x) for x in _parts6)} AS calc_refund, coalesce(g.gc_amt, 0) + coalesce(p.pay_amt, 0) + coalesce(c.total_{CASH}, 0) AS calc_credit,
 {', '.join(nz('c.' + x) + ' AS ' + x for x in _shown6)}
 FROM credits c LEFT JOIN credit_refunds p ON p.credit_id = c.credit_id LEFT JOIN (SELECT credit_id, sum(gift_card_amt) AS gc_amt FROM credit_gift_cards GROUP BY 1) g
 ON g.credit_id = c.credit_id) WHERE calc_credit <> calc_refund"""
_business = ", ".join(c for c in shapes.SHAPES["ledger_lines"].cols if c != "tran_id")
LOCAL["numbered"] = f"SELECT *, row_number() OVER (PARTITION BY {_business} ORDER BY tran_id) AS rn FROM ledger"
SQL["ledger_duplicates"] = "SELECT * FROM numbered WHERE rn > 1"
SQL["duplicate_profile"] = "SELECT tran_sub_type, count(*) AS duplicates FROM numbered WHERE rn > 1 GROUP BY 1"
SQL["ledger_dedupe"] = "SELECT * FROM numbered WHERE rn = 1"
SQL["header_dedupe"] = """SELECT message_uuid, order_id, status, ods_processed_at FROM (SELECT *, row_number() OVER (PARTITION BY message_uuid ORDER BY ods_processed_at DESC) AS rn FROM header_copies)
 WHERE rn = 1"""
SQL["multi_posted_lines"] = """SELECT tran_id, order_line_id, tran_gl_date, tran_amt FROM (SELECT *, count(*) OVER (PARTITION BY order_line_id, tran_gl_date) AS n FROM ledger
 WHERE tran_sub_type_id = 16) WHERE n > 1"""
_goods_at = "LEFT JOIN fc_xref f ON f.ns_fc_id = l.location_id LEFT JOIN curr_items i ON i.item_name = l.sku AND coalesce(i.fc_id, 2) = f.ods_fc_id"
SQL["unmatched_brand_audit"] = f"""SELECT l.tran_id, l.sku, l.location_id, l.tran_gl_date FROM ledger l {_goods_at}
 WHERE l.tran_sub_type_id = 111 AND l.tran_gl_date BETWEEN {START} AND {END} AND i.brand_name IS NULL"""

# --------------------------------------------------------------------------- B
SQL["revenue_by_state"] = f"""SELECT order_month, state, sum(prod) AS prodrev, sum(mem) AS memrev FROM (
 SELECT strftime(l.tran_gl_date, '%b') || '-' || CAST(year(l.tran_gl_date) AS VARCHAR) AS order_month, coalesce(o.billing_state, m.billing_state) AS state,
 sum(CASE WHEN l.je_map_id IN (80, 85, 90, 100, 37, 36) THEN l.tran_amt WHEN l.je_map_id = 35 THEN -l.tran_amt ELSE 0 END) AS prod,
 sum(CASE WHEN l.je_map_id IN (63, 145, 124, 10, 8) THEN l.tran_amt WHEN l.je_map_id IN (64, 62, 79, 123) THEN -l.tran_amt ELSE 0 END) AS mem
 FROM ledger l LEFT JOIN (SELECT DISTINCT CAST(increment_id AS VARCHAR) AS increment_id, billing_state FROM membership) m ON m.increment_id = l.increment_id
 LEFT JOIN (SELECT DISTINCT increment_id, billing_state FROM order_header) o ON o.increment_id = l.increment_id
 WHERE l.tran_gl_date BETWEEN {START} AND {END} AND l.tran_id IN (SELECT tran_id FROM journal_lines WHERE acct_number IN ('40100', '40105') AND tran_date BETWEEN {START} AND {END})
 GROUP BY 1, 2, l.tran_sub_type, l.je_map_id HAVING prod <> 0 OR mem <> 0) GROUP BY 1, 2"""
SQL["crm_discounts"] = f"""SELECT c.*, p.pdgpr, p.tpr, p.astpr FROM (SELECT order_id, increment_id, sale_date, tran_gl_date, coupon_rule_name, rule_id, coupon_group_code, -sum(tran_amt) AS crm_discount
 FROM ledger WHERE tran_gl_date BETWEEN {START} AND {END} AND tran_id IN (SELECT tran_id FROM journal_lines WHERE acct_number = '41107') GROUP BY ALL) c
 LEFT JOIN (SELECT l.order_id, """ + ", ".join(
    f"sum(CASE WHEN g.debit_account_number = '{a}' THEN -coalesce(l.tran_amt, 0) WHEN g.credit_account_number = '{a}' THEN coalesce(l.tran_amt, 0) ELSE 0 END) AS {n}"
    for n, a in (("pdgpr", "40100"), ("tpr", "41113"), ("astpr", "41104"))) + f""" FROM ledger l JOIN gl_map g ON g.map_id = l.je_map_id GROUP BY 1) p ON p.order_id = c.order_id
 UNION ALL SELECT 0, NULL, NULL, NULL, 'Account Activity', NULL, NULL, -sum(coalesce(d.debit_amount, 0) - coalesce(d.credit_amount, 0)), NULL, NULL, NULL
 FROM manual_journals h JOIN manual_lines d ON d.transaction_id = h.transaction_id JOIN erp_accounts a ON a.account_id = d.account_id
 WHERE a.accountnumber = '41107' AND h.trandate BETWEEN {START} AND {END} AND NOT h.is_from_ods GROUP BY 1"""
_month = "strftime(l.tran_gl_date, '%b')"
_year = "CAST(year(l.tran_gl_date) AS VARCHAR)"
LOCAL["vfi"] = f"""SELECT l.*, b.billing_method_id, m.billing_method, m.vendor_funding_item, {_month} || ' ' || {_year} AS mon, last_day(l.tran_gl_date) AS month_end,
 CASE WHEN l.tran_sub_type_id = 111 THEN l.rebate_total WHEN l.tran_sub_type_id = 112 THEN round(l.tran_amt, 2) ELSE round(l.rebate_total, 2) END AS amount
 FROM ledger l {_goods_at} LEFT JOIN brand_records b ON b.brand_records_id = i.brand_id LEFT JOIN brand_marketing m ON m.bm_id = l.brand_marketing_id
 WHERE l.tran_sub_type_id IN (111, 112, 113, 114) AND l.tran_gl_date BETWEEN {START} AND {END} AND l.cancel_type IS NULL
 AND (b.billing_method_id IN (1, 2, 3) OR m.billing_method IN ('UNFI Bill', 'AP Credit', 'AR Invoice'))"""
_vfi_tail = """, mon || ' Vendor Funding Accrual' AS memo, mon || ' ' || tran_sub_type || ' Accrual' AS line_memo, month_end AS je_date, month_end + 1 AS reversal_date FROM vfi GROUP BY ALL"""
SQL["vendor_funding_journal"] = f"""SELECT 'credit' AS side, CASE WHEN tran_sub_type_id = 111 THEN '51035 Cost of Goods Sold : Rebates from Vendors'
 WHEN tran_sub_type_id = 112 AND vendor_funding_item IN ('Reviews', 'Review Incentives') THEN '43105 - Referral Credit - Vendor Funds Earned'
 WHEN tran_sub_type_id = 112 THEN '51041 - Brand Marketing Fees' WHEN tran_sub_type_id = 113 THEN '43113 Marketplace Revenue : TPA - Vendor Funds Earned'
 WHEN tran_sub_type_id = 114 THEN '43114 Marketplace Revenue : TPA - Autoship & Save - Vendor funds earned' END AS acct, NULL AS debit, sum(amount) AS credit {_vfi_tail}
 UNION ALL SELECT 'debit', CASE WHEN billing_method_id = 1 OR billing_method = 'AP Credit' THEN '20103 Accounts Payable : Vendor Funding Credits'
 WHEN billing_method_id IN (2, 3) OR billing_method IN ('AR Invoice', 'UNFI Bill') THEN '12010 Unbilled Accounts Receivable' END AS acct, sum(amount), NULL {_vfi_tail}"""
_keys = "brand_name, rebate_billing_method, sku, description, rebate_type, rebate_billing_period, rebate_start_date, rebate_end_date, rebate_percentage, rebate_dollar_amount"


def _report(qty, cogs, rebate, where, out):
    return f"""SELECT {_keys}, list_item_name, cust_vend, sum(qty) AS tran_qty, sum(cogs) AS tran_cogs_amt, sum(rebate) AS {out} FROM (
 SELECT i.brand_name, i.description, l.* , {qty} AS qty, {cogs} AS cogs, {rebate} AS rebate, m.list_item_name, coalesce(p.billing_customer_id, p.vendor_id) AS cust_vend
 FROM ledger l {_goods_at} LEFT JOIN (SELECT DISTINCT brand_id, brand_records_name, billing_customer_id, vendor_id FROM agreements) p ON p.brand_records_name = i.brand_name
 LEFT JOIN billing_method m ON m.list_id = l.rebate_billing_method
 WHERE l.tran_sub_type_id IN (16, 111) AND l.tran_gl_date BETWEEN {START} AND {END} {where}) GROUP BY ALL"""


SQL["vendor_rebate_report"] = _report(
    "l.tran_qty", "CASE WHEN l.tran_gl_date >= DATE '1998-01-01' THEN l.tran_cost_amt ELSE l.tran_cogs_amt END", "coalesce(l.rebate_total, l.tran_amt)",
    "AND l.cancel_type IS NULL AND l.rebate_start_date IS NOT NULL", "tran_amt")
_first = _report("CASE WHEN l.tran_sub_type_id = 16 THEN l.tran_qty END", "CASE WHEN l.tran_sub_type_id = 16 THEN l.tran_cogs_amt END", "l.rebate_total", "", "rebate_to_bill")
SQL["rebate_rollup"] = "SELECT brand_name, sku, description, " + ", ".join(
    f"max({c}) AS {c}" for c in "rebate_billing_method rebate_type rebate_billing_period rebate_start_date rebate_end_date rebate_percentage rebate_dollar_amount list_item_name cust_vend".split()
) + f", sum(tran_qty) AS tran_qty, sum(tran_cogs_amt) AS tran_cogs_amt, sum(rebate_to_bill) AS rebate_to_bill FROM ({_first}) GROUP BY 1, 2, 3"


def _bills(payer):
    how = "coalesce(t.list_item_name, m.billing_method)"
    return f"""SELECT l.tran_sub_type_id, l.sku, l.tran_qty, l.tran_cogs_amt, l.tran_cost_amt, {how} AS method, m.billing_method AS bm_method,
 CASE {how} WHEN 'AR Invoice' THEN coalesce(p.billing_customer_id, m.billing_customer_id) WHEN 'AP Credit' THEN coalesce(p.vendor_id, m.billing_vendor_id) END AS cust_vend_id,
 {_month} AS mon, {_year} AS yr, last_day(l.tran_gl_date) AS month_end_date, CASE WHEN l.tran_sub_type_id = 111 THEN coalesce(l.rebate_total, 0) ELSE coalesce(l.tran_amt, 0) END AS amount,
 CASE WHEN {how} = 'AR Invoice' THEN CASE l.tran_sub_type_id WHEN 111 THEN '31091' ELSE '7735' END WHEN {how} = 'AP Credit' THEN CASE l.tran_sub_type_id WHEN 111 THEN '149998' ELSE '150002' END END AS item,
 i.description, i.brand_name, i.brand_id AS item_brand, m.brand_id AS bm_brand, m.brand_records_name, m.asset_description, m.brandemail AS bm_email {', p.brandemail AS payer_email' if 'brandemail' in payer else ''}
 FROM ledger l {_goods_at} LEFT JOIN (SELECT DISTINCT brand_records_name, {payer} FROM agreements) p ON p.brand_records_name = i.brand_name
 LEFT JOIN brand_marketing m ON m.bm_id = l.brand_marketing_id LEFT JOIN billing_method t ON t.list_id = p.billing_method_id
 WHERE l.tran_sub_type_id IN (111, 112) AND l.tran_gl_date BETWEEN {START} AND {END}"""


LOCAL["upload"] = _bills("billing_customer_id, vendor_id, billing_method_id")
LOCAL["distributor"] = _bills("billing_customer_id, vendor_id, billing_method_id, brandemail")
SQL["invoice_upload"] = """SELECT tran_sub_type_id, method, cust_vend_id, invoice_number, month_end_date, memo, sum(amount) AS amount, item, line_text, 1 AS ns_location, sku_info,
 CASE WHEN tran_sub_type_id = 111 THEN sum(tran_cogs_amt) ELSE sum(amount) END AS discount,
 CASE WHEN tran_sub_type_id = 111 THEN round(CAST(sum(amount) AS DOUBLE) / nullif(CAST(sum(tran_cogs_amt) AS DOUBLE), 0), 8) ELSE 1 END AS rate, coalesce(sum(tran_qty), 1) AS tran_qty
 FROM (SELECT *, 'TMVF-' || mon || yr || '-' || CAST(cust_vend_id AS VARCHAR) AS invoice_number, mon || ' ' || yr || ' Brand Funding Participation' AS memo,
  CASE WHEN tran_sub_type_id = 111 THEN mon || ' ' || yr || ' Rebates' ELSE asset_description END AS line_text,
  CASE WHEN tran_sub_type_id = 111 THEN sku || ' - ' || description ELSE asset_description END AS sku_info FROM upload WHERE bm_method <> 'UNFI Bill')
 GROUP BY tran_sub_type_id, method, cust_vend_id, invoice_number, month_end_date, memo, item, line_text, sku_info"""
SQL["distributor_report"] = """SELECT brand, invoice_number, program, billing_type, month_end_date, sku, invoice_category, description AS sku_info, sum(coalesce(tran_qty, 1)) AS qty,
 sum(coalesce(base, amount)) AS discount, coalesce(round(CAST(sum(amount) AS DOUBLE) / nullif(CAST(sum(base) AS DOUBLE), 0), 8), 1) AS percentage, sum(amount) AS amount,
 'billing@store.example' AS contact, email, suppress FROM (SELECT * EXCLUDE (sku), coalesce(brand_name, brand_records_name) AS brand,
  'TMVF-' || mon || yr || '-' || CAST(coalesce(item_brand, bm_brand) AS VARCHAR) AS invoice_number, CASE tran_sub_type_id WHEN 111 THEN 'Rebates' ELSE 'Ads' END AS program,
  CASE tran_sub_type_id WHEN 111 THEN 'Rebates' ELSE 'Brand Marketing' END AS billing_type, coalesce(sku, '00000000000') AS sku, coalesce(bm_email, payer_email) AS email,
  coalesce(brand_records_name || ' - ' || asset_description, 'Vendor Rebates') AS invoice_category, CASE WHEN tran_sub_type_id = 112 THEN 'x' END AS suppress,
  coalesce(tran_cogs_amt, tran_cost_amt) AS base FROM distributor WHERE method = 'UNFI Bill')
 GROUP BY brand, invoice_number, program, billing_type, month_end_date, sku, invoice_category, description, email, suppress, cust_vend_id, item_brand"""
SQL["brand_marketing_report"] = f"""SELECT l.tran_gl_date, m.brand_records_name, m.billing_method, coalesce(m.billing_customer_id, m.billing_vendor_id) AS vend_cust, m.vendor_funding_item,
 m.asset_description, m.mm_email, m.start_date, m.end_date, m.billing_month_id, l.tran_amt FROM ledger l LEFT JOIN brand_marketing m ON m.bm_id = l.brand_marketing_id
 WHERE l.tran_sub_type_id = 112 AND l.tran_gl_date BETWEEN {START} AND {END}"""

# --------------------------------------------------------------------------- pipelines
LOCAL["retyped"] = """SELECT * EXCLUDE (order_type), CASE WHEN order_id IN (SELECT order_id FROM free_orders) THEN 'Reshipment' ELSE order_type END AS order_type FROM capture"""
SQL["order_capture_pipeline"] = f"""SELECT tran_type, tran_sub_type_id, tran_sub_type, order_id, CAST(round(tran_amt, 2) AS DECIMAL(12,2)) AS tran_amt, tran_gl_date, cc_type, NULL AS gc_sub_type
 FROM ({SQL['post_order_payment']}) UNION ALL SELECT tran_type, tran_sub_type_id, tran_sub_type, order_id, round(tran_amt, 2), tran_gl_date, NULL, gc_sub_type FROM ({SQL['post_order_gift_card']})
 UNION ALL SELECT tran_type, tran_sub_type_id, tran_sub_type, order_id, round(tran_amt, 2), tran_gl_date, NULL, NULL FROM charges"""
SQL["fulfillment_pipeline"] = " UNION ALL ".join(
    f"SELECT tran_sub_type_id, order_id, {line} AS order_line_id, round(tran_amt, 2) AS tran_amt, tran_gl_date FROM {t}"
    for t, line in (("product_rows", "order_line_id"), ("coupon_rows", "order_line_id"), ("tpa_rows", "order_line_id"), ("tiered_rows", "order_line_id"),
                    ("coupon_bundle_rows", "order_line_id"), ("tpa_bundle_rows", "order_line_id"), ("ship_rows", "NULL")))


def _posted(name, key="order_id"):
    return f"""SELECT 'ledger' AS table_name, {key} AS key, tran_sub_type_id AS code, CAST(round(tran_amt, 2) AS DECIMAL(12,2)) AS amount, CAST(tran_gl_date AS VARCHAR) AS detail
 FROM ({SQL[name]})"""


SQL["membership_run"] = " UNION ALL ".join([_posted(f"post_membership_{n}") for n in ("payment", "gift_card", "tax")] + [
    "SELECT 'membership_header', order_id, NULL, CAST(round(total_order, 2) AS DECIMAL(12,2)), CAST(sale_date AS VARCHAR) FROM members",
    f"SELECT 'membership_payments', order_id, NULL, CAST(round(pay_amt, 2) AS DECIMAL(12,2)), payment_type FROM ({SQL['load_membership_payments']})"])
SQL["cancel_run"] = " UNION ALL ".join([_posted("reverse_order_postings"), _posted("reverse_membership_postings")] + [
    f"SELECT '{n}_header', order_id, NULL, NULL, status FROM ({SQL[q]})" for n, q in (("order", "cancel_order_status"), ("membership", "cancel_membership_status"))] + [
    """SELECT CASE WHEN order_id IN (SELECT order_id FROM order_header) OR order_id IN (SELECT order_id FROM members) THEN 'archive' ELSE 'waiting' END, order_id, NULL, NULL,
 message_uuid FROM cancels"""])
_POSTED_CREDITS = ["post_preship_items"] + [f"post_{n}_refund" for n in ("preship", "postship", "membership")] + [
    "post_preship_gift_card", "post_postship_gift_card", "post_membership_refund_gift_card"]
SQL["credit_memo_run"] = " UNION ALL ".join([_posted(n, "credit_memo_id") for n in _POSTED_CREDITS] + [
    f"SELECT 'gift_cards', card_id, card_type, CAST(round(initial_amount, 2) AS DECIMAL(12,2)), CAST(order_increment_id AS VARCHAR) FROM ({SQL['new_refund_gift_cards']})"] + [
    f"SELECT '{n}{part}', credit_id, NULL, NULL, CAST({d} AS VARCHAR) FROM {t} WHERE (credit_id IN (SELECT credit_id FROM routed)) IS {test}"
    for n, (t, d) in G.CREDIT_TABLES.items() for part, test in (("", "TRUE"), ("_processed", "TRUE"), ("_staging", "NOT TRUE"))])

_WORD = re.compile(r"[a-z_][a-z_0-9]*")


def _closure(body: str, seen: list[str]) -> list[str]:
    """CTEs a body needs, in order of use: local ones and derived tables."""
    for word in dict.fromkeys(_WORD.findall(body)):
        if word in seen:
            continue
        if word in LOCAL:
            _closure(LOCAL[word], seen)
        elif word in shapes.SHAPES:
            for name in shapes.needs(word):
                if name not in seen:
                    seen.append(name)
            continue
        else:
            continue
        if word not in seen:
            seen.append(word)
    return seen


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, body in SQL.items():
        ctes = _closure(body, [])
        text = ", ".join(f"{c} AS ({LOCAL[c] if c in LOCAL else shapes.cte(c)})" for c in ctes)
        cols = ", ".join(f"CAST({c} AS {ORACLE_TYPES[k]}) AS {c}" for c, k in G.parse_spec(G.SPECS[name]))
        out[name] = (f"WITH {text} " if text else "") + f"SELECT {cols} FROM ({body}) result"
    return out
SQL["ledger_append"] = f"""SELECT tran_type, tran_sub_type_id, order_id, CAST(round(tran_amt, 2) AS DECIMAL(12,2)) AS tran_amt, tran_gl_date, {AS_OF} AS created_at FROM charges"""
