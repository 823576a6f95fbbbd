"""Operators composed into the runs a scheduler would start."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import relational as R
from tallyloom.operators import credits, fulfillment, funding, ingest, ledger, maintenance, postings
from tallyloom.schema import to_ledger


def order_capture(queue: DataFrame, cards: DataFrame, legacy_cards: DataFrame, as_of: str, staging: str) -> dict[str, DataFrame]:
    """Capture messages to ledger rows and store tables: parse into ``staging``, correct, post, load."""
    queue = ingest.parse_once(queue, "oc", f"{staging}/capture")
    header = ingest.parse_order_capture(queue)
    items = ingest.explode_order_items(queue)
    payments = ingest.explode_order_payments(queue)
    gifts = ingest.explode_order_gift_cards(queue)
    cash = ingest.explode_order_cash(queue)
    discounts = ingest.explode_item_discounts(queue)
    items = postings.fix_gift_card_negative_discount(postings.fix_zero_charge_discounts(items, payments))
    header = postings.reclassify_reshipment(header, payments)
    posted = R.union_all(*[to_ledger(rows) for rows in (
        postings.post_order_payment(header, payments),
        postings.post_order_gift_card(header, gifts, cards, legacy_cards),
        postings.post_order_charges(header))])
    return {
        "ledger": posted,
        "order_header": postings.load_order_header(header, as_of),
        "order_detail": postings.load_order_detail(items, header),
        "order_detail_discounts": postings.load_order_discounts(discounts, header),
        "order_payments": postings.load_order_payments(header, payments, gifts, cash),
    }


def fulfillment_postings(stage: DataFrame, discounts: DataFrame, fc_xref: DataFrame, items: DataFrame,
                         order_header: DataFrame, staging: str) -> DataFrame:
    """Staged lines to ledger rows: allocate bundles, balance to the cent, post revenue and discounts.

    The two allocations are read several times each, so they are written to ``staging`` once.
    """
    amounts = R.stored(fulfillment.allocate_bundle(stage), f"{staging}/bundle_amounts")
    rules = R.stored(fulfillment.allocate_bundle_discounts(stage, discounts), f"{staging}/bundle_discounts")
    lines = fulfillment.apply_allocation(stage, fulfillment.balance(amounts))
    parts = fulfillment.penny_fix_rule_discount(rules)
    return R.union_all(*[to_ledger(rows) for rows in (
        fulfillment.post_product_revenue(lines, fc_xref, items),
        fulfillment.post_line_discounts(stage, discounts, fc_xref, items),
        fulfillment.post_bundle_discounts(stage, parts, fc_xref, items),
        fulfillment.post_shipment_revenue(order_header, stage))])


def fulfillment_run(queue: DataFrame, store: dict[str, DataFrame], dims: dict[str, DataFrame], as_of: str, staging: str,
                    start_id: int = 0) -> dict[str, DataFrame]:
    """Shipment messages to ledger rows, statuses and archive, in the order a night's run has.

    ``store``: order_header, order_detail, order_detail_discounts, order_payments, credits, credit_items, card_history, cards,
    ledger (posted so far).  ``dims``: fc_xref, items, agreements, brands.  Every step reads the tables that the steps before it
    wrote under ``staging``.
    """
    fc, items = dims["fc_xref"], dims["items"]
    header, detail, discounts = store["order_header"], store["order_detail"], store["order_detail_discounts"]
    held, queue = ingest.hold_partial_shipments(queue, fc)
    messages = ingest.parse_once(queue, "of", f"{staging}/messages")
    none = detail.select("item_id").limit(0)
    shipments = R.stored(ingest.parse_fulfillment(messages), f"{staging}/shipments")
    lines = ingest.explode_fulfillment_items(messages, none)
    errors, lines = maintenance.quarantine_already_done(lines, detail, as_of)
    lines = R.stored(lines, f"{staging}/lines")
    work = R.stored(fulfillment.fulfillment_worklist(shipments, lines, header, detail, store["credits"], as_of), f"{staging}/work")
    # only the history of the orders at work is read on
    due = work.select("order_id")
    detail_due = detail.join(due, "order_id", "left_semi")
    stage = fulfillment.stage_fulfillment(shipments, work, lines, header.join(due, "order_id", "left_semi"), detail_due,
                                          discounts.join(due, "order_id", "left_semi"), store["credit_items"], fc)
    stage = R.stored(fulfillment.retail_price_fallback(stage, fc, items), f"{staging}/stage")
    posted = R.union_all(
        fulfillment_postings(stage, discounts, fc, items, header, f"{staging}/allocation"),
        *[to_ledger(rows) for rows in (
            fulfillment.post_make_good(store["order_payments"], stage, store["card_history"], store["cards"]),
            fulfillment.post_cash_discount(stage, store["order_payments"]),
            funding.post_vendor_rebate(stage, fc, items, dims["agreements"], as_of))])
    # a rerun over the same messages posts nothing again
    keys = ["tran_gl_date", "order_id", "order_line_id", "tran_sub_type_id", "rule_id"]
    posted = R.stored(ledger.prepared(ledger.not_posted(posted, store["ledger"], keys), store["ledger"], as_of, keys), f"{staging}/posted")
    posted = R.stored(maintenance.link_rebate_to_fulfillment(posted), f"{staging}/linked")
    kinds = (funding.post_tpr_funding, funding.post_tpr_funding_bundle, funding.post_as_funding, funding.post_as_funding_bundle)
    funded = R.union_all(*[to_ledger(f(posted, discounts, fc, items, dims["brands"], as_of=as_of)) for f in kinds])
    funded = ledger.prepared(ledger.not_posted(funded, store["ledger"], keys), posted, as_of, keys)
    archived, waiting = maintenance.archive_move(shipments, work, ["order_id"])
    return {
        "ledger": posted.unionByName(R.stored(funded, f"{staging}/funded")),
        "order_detail": fulfillment.update_detail_fulfillment(detail, stage, as_of),
        "order_header": fulfillment.update_header_shipped(header, stage, as_of),
        "errors": errors, "archive": archived, "waiting": waiting, "held": held, "stage": stage,
    }


def membership_run(queue: DataFrame, as_of: str, staging: str) -> dict[str, DataFrame]:
    """Membership messages to ledger rows and store tables; the messages are parsed into ``staging`` once."""
    queue = ingest.parse_once(queue, "mc", f"{staging}/membership")
    members = ingest.parse_membership_capture(queue)
    payments = ingest.explode_membership_payments(queue)
    gifts = ingest.explode_membership_gift_cards(queue)
    posted = R.union_all(*[to_ledger(rows) for rows in (
        postings.post_membership_payment(members, payments),
        postings.post_membership_gift_card(members, gifts),
        postings.post_membership_tax(members))])
    return {
        "ledger": posted,
        "membership_header": postings.load_membership_header(members, as_of),
        "membership_payments": postings.load_membership_payments(members, payments, gifts),
    }


def cancel_run(cancels: DataFrame, store: dict[str, DataFrame], sub_types: DataFrame, refunds: DataFrame, staging: str) -> dict[str, DataFrame]:
    """Cancel messages of known orders and memberships: reversals, statuses, and the messages that are done.

    ``store``: ledger, order_header, membership_header.  Both work lists are written to ``staging``; a message that belongs to no known
    order or membership waits.  Reversals read the ledger once per family, cut to its types.
    """
    orders = R.stored(postings.cancel_worklist(cancels, store["order_header"]), f"{staging}/orders")
    members = R.stored(postings.cancel_worklist(cancels, store["membership_header"]), f"{staging}/members")
    # a partition each per task: such ids compress to little, and small partitions put together would be many rows in one task
    tasks = int(cancels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = R.union_all(orders.select("order_id"), members.select("order_id")).repartition(tasks, "order_id")
    archived, waiting = maintenance.archive_move(cancels, known, ["order_id"])
    return {
        "ledger": R.union_all(to_ledger(postings.reverse_order_postings(store["ledger"], orders, sub_types)),
                              to_ledger(postings.reverse_membership_postings(store["ledger"], members, sub_types, refunds))),
        "order_header": postings.cancel_order_status(store["order_header"], orders),
        "membership_header": postings.cancel_membership_status(store["membership_header"], members),
        "archive": archived, "waiting": waiting,
    }


def credit_memo_run(staged: dict[str, DataFrame], store: dict[str, DataFrame], dims: dict[str, DataFrame], as_of: str,
                    staging: str) -> dict[str, DataFrame]:
    """Staged credit memos to ledger rows, new cards, store tables and the archive.

    ``staged``: credit_memo, credit_memo_items, credit_memo_refunds, credit_memo_gift_cards.  ``store``: order_header, order_detail,
    membership_header, cards, adjustments.  ``dims``: fc_xref, items, control.  Credits are routed once into ``staging``.  Per staging table the
    result has the rows to add to the store (its own name), to its archive (``_processed``) and those that wait (``_staging``).
    """
    memos, lines, refunds, gifts = (staged[n] for n in ("credit_memo", "credit_memo_items", "credit_memo_refunds", "credit_memo_gift_cards"))
    routed = credits.credit_worklists(memos, store["order_header"], store["membership_header"], dims["control"])
    routed = R.stored(routed, f"{staging}/routed")
    posted = R.union_all(*[to_ledger(rows) for rows in (
        credits.post_preship_items(routed, lines, store["order_detail"], dims["fc_xref"], dims["items"]),
        credits.post_refunds(routed, refunds),
        credits.post_refund_gift_cards(routed, gifts, store["adjustments"]))])
    out = {"ledger": posted, "gift_cards": credits.new_refund_gift_cards(routed, gifts, store["cards"])}
    for name, (done, waiting) in credits.archive_credit_memos(routed, memos, lines, refunds, gifts).items():
        loaded = done.withColumn("load_date", F.lit(as_of).cast("timestamp_ntz")) if name == "credit_memo" else done
        out |= {name: loaded, f"{name}_processed": done, f"{name}_staging": waiting}
    return out
