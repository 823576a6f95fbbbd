"""Message queue: parse, de-duplicate, route.

An operator parses the part of the message it needs into a struct of strings and casts or
explodes that; a value that does not cast becomes NULL.  Whole numbers round, as in the
ledger's warehouse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import relational as R
from tallyloom.wire import CASH, CASH_APPLIED, CASH_EARNED

QUEUE_COLUMNS = ["id", "created_at", "s3_updated_at", "s3_filename", "s3_line_num", "message_type", "json_data",
                 "message_uuid", "order_id", "credit_id", "card_id", "customer_id"]

# Message fields with their kind.  s text, i whole number, t timestamp, b boolean,
# f float, n decimal(10,4), m decimal(12,4), c decimal(12,2).
_TOTALS = "order product discount tax payments gift_cards"
_SHIP = "shipment shipment_tax"
_BOXES = "grocery frozen wine"
_PLACE = "city state postal_code country"
FIELDS = {
    "oc": ("message_uuid:s message_type:s order_id:i increment_id:s order_type:s original_order_id:s customer_id:i is_autoship:s "
           "sechedule_id:i updated_at:t sent_at:t created_at:t base_currency_code:s order_currency_code:s "
           + " ".join(f"base_total_{x}:n total_{x}:n" for x in (_TOTALS.split() + [CASH])) + " "
           "base_donations:n donations:n ppe_fee:n ppe_fee_tax:n "
           + " ".join(f"base_{x}:n {x}:n" for x in _SHIP.split()) + " "
           + " ".join(f"{b}_base_{x}:n {b}_{x}:n" for b in _BOXES.split() for x in _SHIP.split()) + " "
           + " ".join(f"{a}_{x}:s" for a in ("billing", "shipping") for x in _PLACE.split()) + " "
           "message_state_id:i message_state:s"),
    "oc_items": ("item_id:i parent_item_id:s product_id:i product_type:s is_virtual:s sku:s is_autoship_subscribed:s "
                 "subscription_qty:i qty_ordered:i base_original_price:m base_price:m tax_percent:m base_tax_amt:m "
                 "discount_percent:m base_discount_amt:m base_row_total:c base_row_total_incl_tax:c original_price:m "
                 "price:m tax_amt:m discount_amt:m row_total:c row_total_incl_tax:c is_gwp:s"),
    "oc_discounts": ("discount_type:s rule_id:i rule_pct_off:c rule_amt_off:c pct_off_applied:m start_price:c "
                     "base_discount_amt:m discount_amt:m units_applied:i base_amt_off_applied:m amt_off_applied:m "
                     "base_tax_discount:m tax_discount:m base_duty_discount:m duty_discount:m rule_name:s rule_group:s "
                     "sponsored_by:s sponsored_percentage:f"),
    "payments": ("id:s payment_gateway:s cc_type:s base_pay_amt:{0} pay_amt:{0} gateway_tran_id:s cc_tran_id:s "
                 "cc_last_four:s"),
    "gift_cards": "gift_card_id:s gift_card_amt:{0}",
    "mc": ("message_uuid:s message_type:s order_id:i increment_id:i original_order_id:s customer_id:i membership_type:s "
           "start_status:s end_status:s start_date:t end_date:t updated_at:t sent_at:t base_currency_code:s "
           "order_currency_code:s donations:n base_donations:n "
           + " ".join(f"base_total_{x}:n total_{x}:n" for x in ("order", "membership", "tax", "payments", "gift_cards", CASH))
           + " billing_state:s"),
    "ma": ("message_uuid:s message_type:s customer_id:s membership_type:s start_status:s end_status:s credit_memo_id:i "
           "updated_at:t sent_at:t"),
    "ocn": ("message_uuid:s message_type:s order_id:i increment_id:s order_type:s customer_id:i updated_at:t sent_at:t "
            f"total_discount:n shipment:n shipment_tax:n donations:n total_payments:n total_tax:n total_order:n total_{CASH}:n "
            f"total_gift_cards:n base_currency_code:s order_currency_code:s refunds:s {CASH_EARNED}:s ms_initiated:b is_fraud:b"),
    "ocn_cash": "item_id:i rule_id:i earned_amt:n thrive_id:i",
    "oa": ("message_uuid:s message_type:s order_id:i original_order_id:i increment_id:i order_type:s customer_id:i "
           "updated_at:t sent_at:s"),
    "of": ("message_uuid:s message_type:s order_id:i increment_id:i order_type:s customer_id:i credit_memo_id:s "
           "is_last_shipment:b is_last_hj_shipment:b updated_at:t sent_at:t"),
    "of_items": "item_id:i parent_item_id:i product_id:i product_type:s is_virtual:s sku:s",
    "cm": ("message_uuid:s message_type:s credit_id:i credit_increment_id:i order_id:i increment_id:s original_order_id:s "
           "order_type:s customer_id:i order_has_shipped:s updated_at:t sent_at:t base_currency_code:s "
           "order_currency_code:s "
           + " ".join(f"base_total_{x}:n total_{x}:n" for x in ("discount", "product", "tax", "refund", "credit", "gift_cards", CASH))
           + " base_adjustment:n adjustment_amount:n base_donations:n donations:n base_shipment:n shipment:n "
           "base_shipment_tax:n shipment_tax:n ppe_fee:n ppe_fee_tax:n "
           + " ".join(f"{b}_{x}:n {b}_base_{x}:n" for b in ("frozen", "wine") for x in _SHIP.split()) + " billing_state:s"),
    "cm_items": ("credit_item_id:i order_item_id:i is_virtual:s return_reason:s sku:s qty_refunded:i base_price:n "
                 "tax_percent:n base_tax_amt:n discount_percent:n base_discount_amt:n base_row_total:n "
                 "base_row_total_incl_tax:n price:n tax_amt:n discount_amt:n row_total:n row_total_incl_tax:n"),
    "gca": "message_uuid:s message_type:s customer_id:s sent_at:t subscription_start_date:t subscription_end_date:t expire_at:t",
    "gca_cards": ("card_id:i card_amt:f card_delta:f action:s action_label:s reason_id:i reason_label:s group_code:s "
                  "group_label:s updated_at:t"),
    "gcf": "message_uuid:s message_type:s order_id:i increment_id:i updated_at:t sent_at:t",
    "gcf_cards": ("item_id:i product_id:i sku:s card_type:i card_amt:n card_id:i reason_id:s group_code:s group_label:s"),
}
# Warehouse names of four credit-memo columns that differ from the message.
CM_RENAMED = {f"{b}_base_{x}": f"base_{b}_{x}" for b in ("frozen", "wine") for x in _SHIP.split()}


def _kinds(part: str, amount: str = "") -> list[tuple[str, str]]:
    return [tuple(f.split(":")) for f in FIELDS[part].format(amount).split()]


def _struct(part: str, *nested: str) -> str:
    return "STRUCT<" + ", ".join([f"`{n}`: STRING" for n, _ in _kinds(part, "n")] + list(nested)) + ">"


_PAY = _struct("payments")
_GIFT = _struct("gift_cards")
# nested parts of the documents, by message type and path; a path's last name is a field of its parent
NESTED = {
    "oc": {"items": "ARRAY<" + _struct("oc_items") + ">",
           "items.discount_detail": "ARRAY<STRUCT<item_id: STRING, discount_detail: ARRAY<" + _struct("oc_discounts") + ">>>",
           "payments.payment_detail": f"STRUCT<payment_detail: ARRAY<{_PAY}>>",
           "payments.gift_card_details": f"STRUCT<gift_card_details: ARRAY<{_GIFT}>>",
           f"payments.{CASH_APPLIED}": f"STRUCT<{CASH_APPLIED}: STRING>"},
    "mc": {"payments.payment_detail": f"STRUCT<payment_detail: ARRAY<{_PAY}>>",
           "payments.gift_card_details": f"STRUCT<gift_card_details: ARRAY<{_GIFT}>>"},
    "oa": {"items": "ARRAY<STRUCT<item_id: STRING, qty_ordered: STRING, fc_assignments: ARRAY<STRUCT<fc: STRING, units: STRING>>>>"},
    "of": {"items": "ARRAY<" + _struct("of_items", "fc_detail: STRUCT<units_shorted: STRING, units_shipped: STRING, "
                    "shipment_id: STRING, fc: STRING, tracking_id: STRING>") + ">",
           "items.fc_detail.fc": "ARRAY<STRUCT<fc_detail: STRUCT<fc: STRING>>>"},
    "cm": {"items": "ARRAY<" + _struct("cm_items") + ">",
           "refunds.payment_detail": f"STRUCT<payment_detail: {_PAY}>",
           "refunds.gift_card_details": f"STRUCT<gift_card_details: ARRAY<{_GIFT}>>",
           f"refunds.{CASH_APPLIED}": f"STRUCT<{CASH_APPLIED}: STRUCT<cash_give: STRING>>"},
    "gca": {"cards": _struct("gca_cards"),
            "cards.key": "STRUCT<card_id: STRING, updated_at: STRING, card_delta: STRING>"},
    "gcf": {"cards": _struct("gcf_cards")},
}


# the nested parts whole, where a type has several paths into one field
WHOLE = {
    "oc": {"items": "ARRAY<" + _struct("oc_items", "discount_detail: ARRAY<" + _struct("oc_discounts") + ">") + ">",
           "payments": f"STRUCT<payment_detail: ARRAY<{_PAY}>, gift_card_details: ARRAY<{_GIFT}>, {CASH_APPLIED}: STRING>"},
    "mc": {"payments": f"STRUCT<payment_detail: ARRAY<{_PAY}>, gift_card_details: ARRAY<{_GIFT}>>"},
    "cm": {"items": NESTED["cm"]["items"],
           "refunds": f"STRUCT<payment_detail: {_PAY}, gift_card_details: ARRAY<{_GIFT}>, {CASH_APPLIED}: STRUCT<cash_give: STRING>>"},
    **{m: {root: NESTED[m][root]} for m, root in (("oa", "items"), ("of", "items"), ("gca", "cards"), ("gcf", "cards"))},
}


def document(message_type: str, *fields: str) -> str:
    """Schema of the wanted part of a message; the reader skips the rest of the text."""
    nested = NESTED.get(message_type, {})
    return "STRUCT<" + ", ".join(f"`{f.split('.')[0]}`: {nested.get(f, 'STRING')}" for f in fields) + ">"


_DECIMALS = {"n": "decimal(10,4)", "m": "decimal(12,4)", "c": "decimal(12,2)"}


def typed(value, kind: str) -> Column:
    c = F.col(value) if isinstance(value, str) else value
    if kind == "s":
        return c
    if kind == "i":
        return F.coalesce(c.try_cast("bigint"), F.round(c.try_cast("decimal(38,6)"), 0).cast("bigint"))
    if kind == "t":
        return F.nullif(c, F.lit("")).try_cast("timestamp_ntz")
    if kind == "b":
        return c.try_cast("boolean")
    if kind == "f":
        return c.try_cast("double")
    return c.try_cast(_DECIMALS[kind])


def _fields(part: str, source: str, amount: str = "", skip=()) -> list[Column]:
    return [typed(f"{source}.{n}", k).alias(n) for n, k in _kinds(part, amount) if n not in skip]


def messages(queue: DataFrame, message_type: str, *fields: str) -> DataFrame:
    """Messages of one type with the wanted part of their document.

    A frame from :func:`parse_once` holds documents already; the scan then reads the wanted part only.
    """
    if "doc" in queue.columns:
        return queue.select("id", "s3_updated_at", "doc")
    return queue.filter(F.col("message_type") == message_type).select(
        "id", "s3_updated_at", F.from_json("json_data", document(message_type, *fields)).alias("doc"))


def parse_once(queue: DataFrame, message_type: str, path: str) -> DataFrame:
    """Parse one type's messages whole into a Parquet table at ``path`` and return that table.

    For runs that take a message apart several ways: the text is parsed a single time, each
    operator reads its own nested columns, and a lost executor rereads the table instead of
    parsing again.
    """
    whole = WHOLE.get(message_type, {})
    fields = [f"`{n}`: STRING" for n, _ in _kinds(message_type)] + [f"`{n}`: {t}" for n, t in whole.items()]
    parsed = queue.filter(F.col("message_type") == message_type).select(
        "id", "s3_updated_at", F.from_json("json_data", f"STRUCT<{', '.join(fields)}>").alias("doc"))
    parsed.write.mode("overwrite").parquet(path)
    return queue.sparkSession.read.schema(parsed.schema).parquet(path)


_ORDER = ("order_id", "message_uuid")


def _header(queue: DataFrame, message_type: str, *more: str) -> DataFrame:
    return messages(queue, message_type, *[n for n, _ in _kinds(message_type)], *more)


def _with_order(msgs: DataFrame, array, alias: str) -> DataFrame:
    # the array is picked before it is spread: under a Generate the reader of a parsed table would take the whole document
    array = F.col(array) if isinstance(array, str) else array
    rows = msgs.select("id", typed("doc.order_id", "i").alias("order_id"), F.col("doc.message_uuid").alias("message_uuid"), array.alias("_array"))
    return rows.select("id", "order_id", "message_uuid", F.posexplode("_array").alias("pos", alias))


# --------------------------------------------------------------------------- duplicates and work lists

def _split_duplicates(queue, message_type, keyed, keys, known):
    """A message is a duplicate if its key is known already or an earlier waiting message has it.

    Both tests run on one row per key; the queue itself is only joined on its unique id.
    """
    waiting = queue.filter(F.col("message_type") == message_type)
    survivors = R.first_ids(keyed, keys, "s3_updated_at", "id").join(known, keys, "left_anti").select("id")
    fresh, doubled = R.split(waiting, survivors, "id")
    return doubled.withColumn("error_message", F.lit("Duplicate")), fresh


def _card_key(card, moment, delta) -> list[Column]:
    card, moment, delta = (F.col(c) if isinstance(c, str) else c for c in (card, moment, delta))
    return [card.cast("bigint").alias("card_id"), moment.alias("updated_at"), F.round(delta.cast("decimal(38,6)"), 2).alias("delta")]


def dedupe_gift_card_adjustments(queue, staged, processed, stored):
    """(duplicates, remaining); key is card, time and amount to the cent."""
    keyed = messages(queue, "gca", "cards.key").select(
        "id", "s3_updated_at", typed("doc.cards.card_id", "i").alias("card"),
        typed("doc.cards.updated_at", "t").alias("moment"), typed("doc.cards.card_delta", "f").alias("amount"),
    ).select("id", "s3_updated_at", *_card_key("card", "moment", "amount"))
    known = R.union_all(*[t.select(*_card_key("card_id", "updated_at", "card_delta"))
                          for t in (staged, processed, stored)])
    return _split_duplicates(queue, "gca", keyed, ["card_id", "updated_at", "delta"], known)


def dedupe_order_cancel(queue, staged, processed, headers):
    """(duplicates, remaining); an order whose header says cancel is done already."""
    keyed = messages(queue, "ocn", "order_id").select("id", "s3_updated_at", typed("doc.order_id", "i").alias("order_id"))
    done = headers.filter(F.col("status") == "cancel")
    known = R.union_all(*[t.select("order_id") for t in (staged, processed, done)])
    return _split_duplicates(queue, "ocn", keyed, ["order_id"], known)


# The key by which each message type counts as new.
WORK_KEYS = {"gca": "message_uuid", "ocn": "order_id", "ma": "message_uuid", "gcf": "message_uuid", "oc": "order_id",
             "mc": "order_id", "oa": "order_id", "of": "message_uuid", "cm": "credit_id"}


def _by_type(values: dict[str, Column]) -> Column:
    """The value of the row's message type."""
    chain = None
    for message_type, value in values.items():
        same = F.col("message_type") == message_type
        chain = F.when(same, value) if chain is None else chain.when(same, value)
    return chain


def _work_key(message_type: str, doc: Column) -> Column:
    key = WORK_KEYS[message_type]
    return typed(doc[key], "s" if key == "message_uuid" else "i").cast("string")


def key_text() -> Column:
    """What makes a message a repeat of another of its type, as text, from ``message_type`` and ``json_data``.

    A message is parsed once, for the few fields that any type's key needs.
    """
    schema = "STRUCT<message_uuid: STRING, order_id: STRING, credit_id: STRING, cards: " + NESTED["gca"]["cards.key"] + ">"
    doc = F.from_json("json_data", schema)
    card = _card_key(typed(doc["cards"]["card_id"], "i"), typed(doc["cards"]["updated_at"], "t"), typed(doc["cards"]["card_delta"], "f"))
    of_card = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in card])
    return _by_type({m: of_card if m == "gca" else F.coalesce(_work_key(m, doc), F.lit("")) for m in WORK_KEYS})


def new_message_worklist(queue, message_type, staged, processed):
    """Key and id of messages found neither in staging nor in the archive."""
    key = WORK_KEYS[message_type]
    value = f"doc.{key}"
    keyed = messages(queue, message_type, key).select(
        typed(value, "s" if key == "message_uuid" else "i").alias(key), "id")
    return keyed.join(staged.select(key), key, "left_anti").join(processed.select(key), key, "left_anti")


def known_keys(tables: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """message_type, work_key of what staging and archive hold; ``tables``: both by message type."""
    return R.union_all(*[t.select(F.lit(m).alias("message_type"), F.col(WORK_KEYS[m]).cast("string").alias("work_key"))
                         for m, pair in tables.items() for t in pair])


def work_keys(queue) -> DataFrame:
    """message_type, work_key (text), id of all types: one scan, one parse of the three fields that keys are made of."""
    rows = queue.filter(F.col("message_type").isin(*WORK_KEYS)).select(
        "id", "message_type", F.from_json("json_data", document("", "message_uuid", "order_id", "credit_id")).alias("doc"))
    return rows.select("message_type", _by_type({m: _work_key(m, F.col("doc")) for m in WORK_KEYS}).alias("work_key"), "id")


def _with_seen(queue, known: DataFrame) -> DataFrame:
    """Keys of the queue with ``_seen``, true where staging or archive hold the key: one join for all types.

    Messages without a key are new, and are dealt by their id.  (An anti join would be pushed into every branch of a queue
    that is a union.)
    """
    keyed = work_keys(queue).withColumn("_key", F.coalesce("work_key", F.concat(F.lit("\0"), F.col("id").cast("string"))))
    seen = known.filter(F.col("work_key").isNotNull()).select("message_type", F.col("work_key").alias("_key")).distinct().withColumn("_seen", F.lit(True))
    return keyed.join(seen, ["message_type", "_key"], "left")


def work_lists(queue, known: DataFrame) -> DataFrame:
    """message_type, work_key, id of the messages of all types found neither in staging nor in the archive."""
    return _with_seen(queue, known).filter(F.col("_seen").isNull()).select("message_type", "work_key", "id")


def commit_fates(queue, known: DataFrame) -> DataFrame:
    """id, message_type, fate: 'processed' (taken now, so it moves to the archive) or 'queue' (it keeps waiting, as its key is known)."""
    return _with_seen(queue, known).select("id", "message_type", F.when(F.col("_seen"), "queue").otherwise("processed").alias("fate"))


def queue_commit(queue, work):
    """(messages for the archive, messages that keep waiting)."""
    return R.split(queue, work, "id")


def take(queue, work):
    """The waiting messages a work list names."""
    return queue.join(work.select("id"), "id", "left_semi")


# --------------------------------------------------------------------------- headers

def parse_header(queue, message_type, skip=()):
    return _header(queue, message_type).select(*_fields(message_type, "doc", skip=skip))


def parse_gift_card_adjustment(queue):
    return _header(queue, "gca", "cards").select(*_fields("gca", "doc"), *_fields("gca_cards", "doc.cards"))


def parse_gift_card_fulfillment(queue):
    return _header(queue, "gcf", "cards").select(*_fields("gcf", "doc"), *_fields("gcf_cards", "doc.cards"))


def parse_order_cancel(queue):
    """Typed header; refunds and earned cash stay JSON text."""
    return parse_header(queue, "ocn")


def parse_membership_adjustment(queue):
    return parse_header(queue, "ma")


def parse_order_capture(queue):
    return parse_header(queue, "oc")


def parse_membership_capture(queue):
    return parse_header(queue, "mc")


def parse_credit_memo(queue):
    out = parse_header(queue, "cm")
    return out.withColumnsRenamed(CM_RENAMED)


def parse_fulfillment(queue):
    """``credit_memo_id`` is NULL when the message holds 0 or an empty list."""
    out = parse_header(queue, "of", skip=("is_last_hj_shipment",))
    return out.withColumn("credit_memo_id", F.when(~F.col("credit_memo_id").isin("0", "[]"), F.col("credit_memo_id")))


# --------------------------------------------------------------------------- arrays

def explode_cancel_cash_earned(queue):
    rows = ", ".join(f"`{n}`: STRING" for n, _ in _kinds("ocn_cash"))
    msgs = messages(queue, "ocn", *_ORDER, CASH_EARNED).withColumn(
        "earned", F.from_json(f"doc.{CASH_EARNED}", f"ARRAY<STRUCT<{rows}>>"))
    return _with_order(msgs, "earned", "e").select("order_id", *_fields("ocn_cash", "e"), "message_uuid")


def explode_order_items(queue):
    return _with_order(messages(queue, "oc", *_ORDER, "items"), "doc.items", "e").select("order_id", *_fields("oc_items", "e"), "message_uuid")


def explode_item_discounts(queue):
    """Two levels of arrays.  ``discount_id`` counts the message's discounts by item id, inside the row."""
    by_item = F.array_sort(F.transform("doc.items", lambda item, at: F.struct(
        typed(item["item_id"], "i").alias("item_id"), at.alias("at"), item["discount_detail"].alias("details"))))
    flat = F.flatten(F.transform(
        F.filter(by_item, lambda item: item["details"].isNotNull()),
        lambda item: F.transform(item["details"], lambda d: F.struct(item["item_id"].alias("item_id"), d.alias("d")))))
    return _with_order(messages(queue, "oc", *_ORDER, "items.discount_detail"), flat, "e").select(
        "order_id", F.col("e.item_id").alias("item_id"), (F.col("pos") + 1).alias("discount_id"),
        *_fields("oc_discounts", "e.d"), "message_uuid")


def _payments(queue, message_type, amount):
    return _with_order(messages(queue, message_type, *_ORDER, "payments.payment_detail"), "doc.payments.payment_detail", "e").select(
        "order_id", F.col("e.id").alias("payment_id"), *_fields("payments", "e", amount, skip=("id",)), "message_uuid")


def _gift_cards(queue, message_type, amount):
    return _with_order(messages(queue, message_type, *_ORDER, "payments.gift_card_details"), "doc.payments.gift_card_details", "e").select(
        "order_id", *_fields("gift_cards", "e", amount), "message_uuid")


def explode_order_payments(queue):
    return _payments(queue, "oc", "c")


def explode_order_gift_cards(queue):
    return _gift_cards(queue, "oc", "c")


def explode_membership_payments(queue):
    return _payments(queue, "mc", "m")


def explode_membership_gift_cards(queue):
    return _gift_cards(queue, "mc", "m")


def explode_order_cash(queue):
    """Store cash applied, as a list of objects or as one object.

    One object is spread into its values, as a lateral flatten does, so its scalar values
    carry no amount and give NULL.  ``tc_id`` numbers the entries of a message.
    """
    text = F.col(f"doc.payments.{CASH_APPLIED}")
    entries = F.when(F.ltrim(text).startswith("["), F.from_json(text, "ARRAY<STRING>")) \
        .otherwise(F.map_values(F.from_json(text, "MAP<STRING, STRING>")))
    return _with_order(messages(queue, "oc", *_ORDER, f"payments.{CASH_APPLIED}"), entries, "e").select(
        "order_id", (F.col("pos") + 1).alias("tc_id"),
        typed(F.get_json_object("e", "$.applied_amt"), "c").alias("tc_amt"), "message_uuid")


def explode_assignments(queue):
    """Items times their warehouse assignments."""
    lines = _header(queue, "oa", "items").select("doc", F.explode("doc.items").alias("item"))
    lines = lines.select("doc", "item", F.explode("item.fc_assignments").alias("a"))
    ordered, units = typed("item.qty_ordered", "i"), typed("a.units", "i")
    return lines.select(*_fields("oa", "doc"), typed("item.item_id", "i").alias("item_id"),
                        ordered.alias("qty_ordered"), units.alias("qty_assigned"),
                        (ordered - units).alias("qty_short"), typed("a.fc", "i").alias("fc"))


def hold_partial_shipments(queue, fc_xref):
    """(held, remaining): shipments touching an ``is_hj`` warehouse wait for their last part."""
    parts = messages(queue, "of", "is_last_hj_shipment", "items.fc_detail.fc").filter(~typed("doc.is_last_hj_shipment", "b")).select(
        "id", F.explode("doc.items").alias("item")).select(
        "id", F.explode(F.from_json("item.fc_detail.fc", "ARRAY<STRING>")).alias("fc"))
    hj = fc_xref.filter("is_hj").select(F.col("fc_id").cast("string").alias("fc"))
    partial = parts.join(hj, "fc", "left_semi").select("id").distinct()
    waiting = queue.filter(F.col("message_type") == "of")
    return R.split(waiting, partial, "id")


def shipment_parts(fc_ids: list[str]) -> tuple[Column, Column]:
    """(waits for its last part, is the last part) of a message, without a join; ``fc_ids``: the ``is_hj`` warehouses."""
    doc = F.from_json("json_data", document("of", "is_last_hj_shipment", "items.fc_detail.fc"))
    last = F.coalesce(typed(doc["is_last_hj_shipment"], "b"), F.lit(None).cast("boolean"))
    fcs = F.transform(doc["items"], lambda i: F.from_json(i["fc_detail"]["fc"], "ARRAY<STRING>"))
    fcs = F.flatten(F.filter(fcs, lambda x: x.isNotNull()))
    hj = F.array(*[F.lit(x) for x in fc_ids]).cast("array<string>")
    mine = F.col("message_type") == "of"
    return F.coalesce(mine & ~last & F.arrays_overlap(fcs, hj), F.lit(False)), F.coalesce(mine & last, F.lit(False))


def explode_fulfillment_items(queue, staged_detail):
    """First row of every item, unless the item is staged already."""
    rows = messages(queue, "of", *_ORDER, "increment_id", "customer_id", "items").select("id", "doc", F.posexplode("doc.items").alias("pos", "item"))
    rows = rows.select(
        "id", "pos", typed("doc.order_id", "i").alias("order_id"), typed("doc.increment_id", "i").alias("increment_id"),
        typed("doc.customer_id", "i").alias("customer_id"), *_fields("of_items", "item"),
        typed("item.fc_detail.units_shorted", "i").alias("units_shorted"),
        typed("item.fc_detail.units_shipped", "i").alias("units_shipped"),
        F.col("item.fc_detail.shipment_id").alias("shipment_id"), F.col("item.fc_detail.fc").alias("fc"),
        F.col("item.fc_detail.tracking_id").alias("tracking_id"), F.col("doc.message_uuid").alias("message_uuid"))
    first = R.one_per_key(rows, ["item_id"], ["id", "pos"])
    return first.join(staged_detail.select("item_id"), "item_id", "left_anti").drop("id", "pos")


_CREDIT = ("credit_id", *_ORDER)


def _with_credit(queue, array, alias="e"):
    return messages(queue, "cm", *_CREDIT, array.removeprefix("doc.")).select(
        typed("doc.credit_id", "i").alias("credit_id"), typed("doc.order_id", "i").alias("order_id"),
        F.col("doc.message_uuid").alias("message_uuid"), F.explode(array).alias(alias))


def explode_credit_items(queue):
    return _with_credit(queue, "doc.items").select("credit_id", "order_id", *_fields("cm_items", "e"), "message_uuid")


def credit_refunds(queue):
    """The one card refund of a credit memo; none without a payment id."""
    pay = "doc.refunds.payment_detail"
    return messages(queue, "cm", *_CREDIT, "refunds.payment_detail").filter(F.col(f"{pay}.id").isNotNull()).select(
        typed("doc.order_id", "i").alias("order_id"), F.col(f"{pay}.id").alias("payment_id"),
        *_fields("payments", pay, "n", skip=("id",)), typed("doc.credit_id", "i").alias("credit_id"),
        F.col("doc.message_uuid").alias("message_uuid"))


def credit_gift_cards(queue):
    return _with_credit(queue, "doc.refunds.gift_card_details").select(
        "credit_id", "order_id", *_fields("gift_cards", "e", "n"), "message_uuid")


def credit_cash(queue):
    amount = typed(f"doc.refunds.{CASH_APPLIED}.cash_give", "n")
    return messages(queue, "cm", *_CREDIT, f"refunds.{CASH_APPLIED}").filter(F.coalesce(amount, F.lit(0)) != 0).select(
        typed("doc.credit_id", "i").alias("credit_id"), typed("doc.order_id", "i").alias("order_id"),
        F.lit(1).alias("tc_id"), amount.alias("tc_amt"), F.col("doc.message_uuid").alias("message_uuid"))
