"""Registered queries against DuckDB.  A selection by default; TALLYLOOM_ALL=1 runs every query."""

import os

import pytest

from tallyloom.plans import registry
from tallyloom.verification.compare import compare, connect
from tallyloom.verification.oracle import SQL

CHOSEN = ["dedupe_gift_card_adjustments", "explode_item_discounts", "explode_order_cash", "post_product_tax",
          "post_order_gift_card", "reverse_membership_postings", "fulfillment_worklist", "apply_allocation",
          "penny_fix_rule_discount", "post_tpa", "post_shipment_revenue", "credit_worklists", "post_preship_refund",
          "gift_card_adjustment_enrich", "post_vendor_rebate", "post_as_funding_bundle", "check_order_payment",
          "check_discount_item_over", "ledger_dedupe", "link_rebate_to_fulfillment", "upsert_dimension",
          "vendor_funding_journal", "distributor_report", "queue_stream", "order_capture_pipeline", "membership_run", "cancel_run", "credit_memo_run"]
NAMES = list(registry.SPECS) if os.environ.get("TALLYLOOM_ALL") else CHOSEN


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(SQL) == set(registry.SPECS)


@pytest.mark.parametrize("name", NAMES)
def test_matches_duckdb(spark, con, sf_dir, name):
    ours, theirs, extra, missing = compare(spark, con, sf_dir, name)
    assert not extra and not missing, (list(extra)[:3], list(missing)[:3])
    assert ours == theirs and ours > 0
