"""The message queue, as JSON text made from the derived tables.

A message's arrays are built inside its own row (``transform`` over a number sequence),
so writing the queue neither groups nor shuffles.  Some messages are sent again.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.relational import union_all
from tallyloom.sources.shapes import SHAPES, table
from tallyloom.wire import CASH, CASH_APPLIED, CASH_EARNED

TYPE_NUMBERS = {"oc": 1, "mc": 2, "oa": 3, "of": 4, "cm": 5, "ocn": 6, "ma": 7, "gca": 8, "gcf": 9}
# how often a message is sent, by its key
COPIES = {"gca": "CASE WHEN k % 60 = 0 THEN 3 WHEN k % 20 = 0 THEN 2 ELSE 1 END",
          "ocn": "CASE WHEN k % 12 = 2 THEN 2 ELSE 1 END",
          "of": "CASE WHEN k % 15 = 3 THEN 2 ELSE 1 END"}
ISO = "yyyy-MM-dd'T'HH:mm:ss"


def _struct(fields: dict) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {e}" for n, e in fields.items()) + ")"


def _iso(expr):
    return f"date_format({expr}, \"{ISO}\")"


def _times(fields: dict, *names) -> dict:
    return {n: _iso(e) if n in names else e for n, e in fields.items()}


def _inline(expr: str) -> str:
    """A line formula with the line helpers written out, for use inside a lambda."""
    line = SHAPES["capture_line"].cols
    expr = re.sub(r"\bunit_disc_c\b", f"({line['unit_disc_c']})", expr)
    return re.sub(r"\bm\b", f"({line['m']})", expr)


def _array(var, count, body) -> str:
    size = f"CAST({count} AS BIGINT)"
    return f"CASE WHEN {size} > 0 THEN transform(sequence(CAST(1 AS BIGINT), {size}), {var} -> {body}) END"


def _send(base: DataFrame, message_type: str, doc: str, uuid: str, **keys) -> DataFrame:
    number = TYPE_NUMBERS[message_type]
    copies = f"CAST({COPIES.get(message_type, '1')} AS BIGINT)"
    rows = base.withColumn("copy", F.explode(F.expr(f"sequence(CAST(1 AS BIGINT), {copies})")))
    key = {c: keys.get(c, "CAST(NULL AS BIGINT)") for c in ("order_id", "credit_id", "card_id", "customer_id")}
    return rows.select(
        F.expr(f"(k * 4 + copy) * 16 + {number}").alias("id"),
        F.expr("TIMESTAMP_NTZ '2024-02-01 00:00:00'").alias("created_at"),
        F.expr("TIMESTAMP_NTZ '2024-02-01 00:00:00' + copy * INTERVAL '1' HOUR").alias("s3_updated_at"),
        F.lit(f"{message_type}.json").alias("s3_filename"), F.lit(1).alias("s3_line_num"),
        F.lit(message_type).alias("message_type"), F.expr(f"to_json({doc})").alias("json_data"),
        F.expr(uuid).alias("message_uuid"), *[F.expr(e).alias(c) for c, e in key.items()])


def message_queue(spark: SparkSession, sf_dir: str, *types: str, tasks: int | None = None) -> DataFrame:
    """Waiting messages of the given types (default: all), written by ``tasks`` tasks (default: one per split of the scan)."""
    def dealt(df):
        return df.repartition(tasks) if tasks else df
    z = dealt(table(spark, sf_dir, "orders_z"))
    made = {}

    def cols(name, *drop):
        return {n: e for n, e in SHAPES[name].cols.items() if n not in ("message_uuid", "order_id", *drop)}

    pay = _struct({"id": SHAPES["capture_payments"].cols["payment_id"], **cols("capture_payments", "payment_id")})
    gift = _struct(cols("capture_gift_cards"))
    cash = "CAST(cash_c * 0.01 AS DECIMAL(12,2))"
    applied = (f"CASE WHEN cash_c = 0 THEN NULL WHEN k % 2 = 0 THEN to_json(array(named_struct('applied_amt', {cash})))"
               f" ELSE to_json(named_struct('applied_amt', {cash}, 'note', 'x')) END")
    # a discount list is an array per item; an item's formulas name its line number i
    item = {n: _inline(e) for n, e in cols("capture_items").items()}
    discount = {n: _inline(e) for n, e in cols("capture_discounts", "item_id", "position").items()}
    item["discount_detail"] = _array("j", f"(k + i) % 3", _struct(discount))
    header = {"message_uuid": "'oc-' || CAST(k AS STRING)", "order_id": "k",
              **_times(cols("capture"), "created_at", "updated_at")}
    # text cut by hand so that store cash can be a list in one message and an object in the next
    made["oc"] = lambda: _send(
        z, "oc", _struct({**header, "items": _array("i", "n", _struct(item)),
                          "payments": _struct({
                              "payment_detail": f"CASE WHEN k % 29 <> 0 THEN array({pay}) END",
                              "gift_card_details": f"CASE WHEN gift_c > 0 THEN array({gift}) END",
                              CASH_APPLIED: applied})}),
        "'oc-' || CAST(k AS STRING)", order_id="k", customer_id="custkey")

    mem = {"message_uuid": "'mc-' || CAST(k AS STRING)", "order_id": "5000000000 + k", **_times(cols("membership"), "updated_at"),
           "payments": _struct({
               "payment_detail": "CASE WHEN k % 29 <> 0 THEN array("
                                 + _struct({"id": SHAPES["membership_payments"].cols["payment_id"],
                                            **cols("membership_payments", "payment_id")}) + ") END",
               "gift_card_details": "CASE WHEN k % 3 = 1 THEN array(" + _struct(cols("membership_gift_cards")) + ") END"})}
    made["mc"] = lambda: _send(z.filter(SHAPES["membership"].where), "mc", _struct(mem), "'mc-' || CAST(k AS STRING)",
                               order_id="5000000000 + k")

    assign = _array("a", "(k + i) % 2 + 1", _struct({"fc": SHAPES["assignments"].cols["fc"], "units": SHAPES["assignments"].cols["qty_assigned"]}))
    oa = {"message_uuid": "'oa-' || CAST(k AS STRING)", "order_id": "k", "increment_id": "100000000 + k", "customer_id": "custkey",
          "items": _array("i", "n", _struct({"item_id": "k * 8 + i", "qty_ordered": "qty", "fc_assignments": assign}))}
    made["oa"] = lambda: _send(z, "oa", _struct(oa), "'oa-' || CAST(k AS STRING)", order_id="k")

    ship_item = _struct({
        "item_id": "k * 8 + i", "parent_item_id": "CASE WHEN k % 5 = 0 AND i > 1 THEN k * 8 + 1 END", "product_id": "k + i",
        "product_type": "'simple'", "sku": SHAPES["capture_items"].cols["sku"],
        "fc_detail": _struct({"units_shipped": "qty", "units_shorted": "0", "fc": "array(CAST((k + i) % 6 + 1 AS STRING))",
                              "shipment_id": "k", "tracking_id": "'trk' || CAST(k AS STRING)"})})
    of = {"message_uuid": "'of-' || CAST(k AS STRING) || '-' || CAST(copy AS STRING)", "order_id": "k",
          "increment_id": "100000000 + k", "customer_id": "custkey", "updated_at": _iso("created_at + 72 * INTERVAL '1' HOUR"),
          "credit_memo_id": "CASE k % 4 WHEN 0 THEN '0' WHEN 1 THEN '[' || CAST(900000000 + k AS STRING) || ']' WHEN 2 THEN '[]' END",
          "is_last_shipment": "k % 4 <> 2", "is_last_hj_shipment": "CASE WHEN k % 8 = 3 THEN NULL ELSE k % 3 <> 0 END",
          "items": _array("i", "n", ship_item)}
    made["of"] = lambda: _send(z, "of", _struct(of), "'of-' || CAST(k AS STRING) || '-' || CAST(copy AS STRING)", order_id="k")

    refund = {"payment_detail": "CASE WHEN k % 3 <> 1 THEN "
                                + _struct({"id": SHAPES["credit_refunds"].cols["payment_id"],
                                           **cols("credit_refunds", "payment_id", "credit_id")}) + " END",
              "gift_card_details": "CASE WHEN k % 3 = 1 OR k % 12 = 9 THEN array("
                                   + _struct(cols("credit_gift_cards", "credit_id")) + ") END",
              CASH_APPLIED: "CASE WHEN k % 7 = 3 THEN named_struct('cash_give', 3.00) ELSE named_struct('cash_give', 0.00) END"}
    credit = {"message_uuid": "'cm-' || CAST(k AS STRING)", "order_id": SHAPES["credits"].cols["order_id"],
              **_times(cols("credits"), "updated_at")}
    for box in ("frozen", "wine"):
        for part in ("shipment", "shipment_tax"):
            credit[f"{box}_base_{part}"] = credit.pop(f"base_{box}_{part}")
    made["cm"] = lambda: _send(
        z.filter("k % 4 = 1"), "cm",
        _struct({**credit, "items": _array("i", "k % 2 + 1", _struct(cols("credit_items", "credit_id"))), "refunds": _struct(refund)}),
        "'cm-' || CAST(k AS STRING)", order_id="k", credit_id="900000000 + k")

    cancel = {"message_uuid": "'ocn-' || CAST(k AS STRING) || '-' || CAST(copy AS STRING)", "order_id": "k",
              **_times({n: e for n, e in SHAPES["cancel_orders"].cols.items() if n not in ("message_uuid", "order_id", "refunds")}, "updated_at"),
              "refunds": "CASE k % 4 WHEN 0 THEN named_struct('payment_detail', named_struct('voided', true)) END",
              CASH_EARNED: _array("i", "k % 3", "named_struct('item_id', k * 8 + i, 'rule_id', k % 9, 'earned_amt', CAST((k + i) % 500 * 0.01 AS DECIMAL(10,4)), 'thrive_id', k * 2)")}
    made["ocn"] = lambda: _send(z.filter("k % 6 <> 1"), "ocn", _struct(cancel),
                                "'ocn-' || CAST(k AS STRING) || '-' || CAST(copy AS STRING)", order_id="k")

    ma = {"message_uuid": "'ma-' || CAST(k AS STRING)", "message_type": "'ma'", "customer_id": "custkey", "start_status": "'member'",
          "end_status": "CASE WHEN k % 3 = 0 THEN 'canceled' ELSE 'member' END", "membership_type": "'annual'",
          "credit_memo_id": "CASE WHEN k % 5 = 0 THEN 900000000 + k END", "updated_at": _iso("created_at")}
    made["ma"] = lambda: _send(z.filter("k % 8 = 2"), "ma", _struct(ma), "'ma-' || CAST(k AS STRING)")

    card_cols = ("card_id", "card_amt", "card_delta", "action", "action_label", "reason_id", "reason_label", "group_code", "group_label")
    gca = {"message_uuid": "message_uuid", "message_type": "'gca'", "customer_id": "customer_id",
           **{c: f"coalesce({_iso(c)}, '')" for c in ("subscription_start_date", "subscription_end_date", "expire_at")},
           "cards": _struct({**{c: c for c in card_cols}, "updated_at": _iso("updated_at")})}
    made["gca"] = lambda: _send(dealt(table(spark, sf_dir, "card_moves")).withColumn("k", F.col("event_id")), "gca", _struct(gca),
                                "message_uuid", card_id="card_id")

    sale = {"message_uuid": "message_uuid", "order_id": "order_id", "increment_id": "increment_id", "updated_at": _iso("updated_at"),
            "cards": _struct({c: c for c in ("item_id", "card_id", "card_type", "card_amt", "sku", "group_code")})}
    made["gcf"] = lambda: _send(dealt(table(spark, sf_dir, "gift_sales")).withColumn("k", F.col("order_id")), "gcf", _struct(sale),
                                "message_uuid", order_id="order_id", card_id="card_id")
    return union_all(*[made[t]() for t in types or TYPE_NUMBERS])


__all__ = ["message_queue", "TYPE_NUMBERS", "CASH"]
