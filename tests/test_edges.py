"""Hand-made edge rows."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import relational as R
from tallyloom.functions.exprs import capitalise, legacy_number, local_date, whole
from tallyloom.operators import checks, credits, fulfillment, funding, ingest, maintenance
from tallyloom.wire import CASH_APPLIED, CASH_EARNED

D = Decimal


def queue_of(spark, message_type, *docs):
    rows = [(i + 1, dt.datetime(2024, 2, 1, i), message_type, json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "id bigint, s3_updated_at timestamp_ntz, message_type string, json_data string")


def values(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


# --------------------------------------------------------------------------- expressions

def test_local_date_across_daylight_saving(spark):
    rows = [("2023-07-01 06:59:59", "2023-06-30"), ("2023-07-01 07:00:00", "2023-07-01"),
            ("2023-12-01 07:59:59", "2023-11-30"), ("2023-12-01 08:00:00", "2023-12-01")]
    df = spark.createDataFrame(rows, "ts string, day string").select(
        local_date(F.col("ts").cast("timestamp_ntz")).cast("string").alias("got"), "day")
    assert all(r.got == r.day for r in df.collect())


def test_capital_after_hyphen_and_rounding(spark):
    row = spark.range(1).select(
        capitalise(F.lit("make-good card")).alias("a"), whole(F.lit(D("0.50"))).alias("b"), whole(F.lit(D("-0.50"))).alias("c"),
        whole(F.lit(D("0.49"))).alias("d"), legacy_number("'123-1'").alias("e")).first()
    assert tuple(row) == ("Make-Good Card", 1, -1, 0, 123)


# --------------------------------------------------------------------------- relational patterns

def test_not_in_with_null_in_list_and_null_value(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert values(R.not_in(rows, "k", spark.createDataFrame([(1,)], "c int")), "k") == [(2,)]
    assert values(R.not_in(rows, "k", spark.createDataFrame([(1,), (None,)], "c int")), "k") == []


def test_first_ids_and_upsert(spark):
    rows = spark.createDataFrame([(1, "a", 5), (2, "a", 4), (3, None, 1), (4, None, 2)], "id int, k string, o int")
    assert values(R.first_ids(rows, ["k"], "o", "id"), "id") == [(2,), (3,)]
    old = spark.createDataFrame([(1, "x", "keep"), (2, "y", "keep")], "k int, a string, b string")
    new = spark.createDataFrame([(2, None, "no"), (3, "z", "new")], "k int, a string, b string")
    assert values(R.upsert(old, new, ["k"], ["a"]), "k", "a", "b") == [(1, "x", "keep"), (2, None, "keep"), (3, "z", "new")]
    assert maintenance.insert_if_absent(old, new, ["k"]).count() == 3


def test_update_from_reduces_source_to_one_row(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(1, "z"), (1, "m")], "k int, v string")
    assert values(R.update_from(target, source, ["k"], ["v"]), "k", "v") == [(1, "m"), (2, "b")]


def test_purge_keeps_unknown(spark):
    rows = spark.createDataFrame([(1, True), (2, False), (3, None)], "k int, c boolean")
    assert values(maintenance.purge_by_predicate(rows, F.col("c")), "k") == [(2,), (3,)]


def test_surrogate_ids_are_dense(spark):
    rows = spark.range(1000).withColumn("k", F.lit(7))
    out = R.surrogate_ids(rows, F.pmod("id", F.lit(16)), ["id"], "tran_id", start=100)
    got = sorted(r.tran_id for r in out.select("tran_id").collect())
    assert got == list(range(101, 1101))


# --------------------------------------------------------------------------- penny fix

def brute_force(rows, target):
    """item -> cent, by the plain definition."""
    off = int(((target - sum(a for _, a in rows)) * 100).to_integral_value(rounding="ROUND_HALF_UP"))
    ranked = sorted((r for r in rows if r[1] > 0), key=lambda r: (-r[1], r[0] % 64, r[0]))
    return {i: D("0.01") if off > 0 else D("-0.01") for i, _ in ranked[:abs(off)]}


@pytest.mark.parametrize("amounts, target", [
    ([D("1.00"), D("1.00"), D("1.00")], D("3.01")),          # equal amounts, one cent short
    ([D("5.00"), D("0.00"), D("2.00")], D("6.98")),          # two cents over, a zero line
    ([D("0.01"), D("0.02")], D("0.10")),                     # more cents than lines
    ([D("0.00"), D("0.00")], D("0.05")),                     # nothing to move
    ([D("3.33")] * 200, D("666.77")),                        # ties over many salts
])
def test_penny_rank(spark, amounts, target):
    rows = [(1, i * 7 + 3, a, target) for i, a in enumerate(amounts)]
    df = spark.createDataFrame(rows, "g int, item bigint, amount decimal(12,2), target decimal(14,4)")
    got = {r.item: r.cent for r in R.penny_rank(df, ["g"], "item", "amount", "target").collect()}
    assert got == brute_force([(r[1], r[2]) for r in rows], target)


def test_penny_rank_with_one_hot_group(spark):
    """A third of all rows in one group of equal amounts."""
    hot = spark.range(6000).select(F.lit(0).alias("g"), F.col("id").alias("item"), F.lit(D("1.00")).alias("amount"), F.lit(D("6020.00")).alias("target"))
    cold = spark.range(12000).select((F.col("id") % 4000 + 1).cast("int").alias("g"), (F.col("id") + 10**6).alias("item"),
                                     F.lit(D("2.00")).alias("amount"), F.lit(D("6.01")).alias("target"))
    df = hot.union(cold).withColumn("target", F.col("target").cast("decimal(14,4)"))
    out = R.penny_rank(df, ["g"], "item", "amount", "target").groupBy("g").agg(F.sum("cent").alias("s"))
    got = {r.g: r.s for r in out.collect()}
    assert got[0] == D("20.00") and len(got) == 4001 and all(v == D("0.01") for g, v in got.items() if g)


def stage_rows(spark, rows):
    return spark.createDataFrame(
        rows, "order_id bigint, item_id bigint, parent_item_id bigint, product_type string, sku string, fc bigint, units_shipped bigint,"
              " base_price decimal(12,4), base_discount_amt decimal(12,4), base_tax_amt decimal(12,4), retail_price decimal(12,4)")


def test_bundle_adds_up_and_zero_base(spark):
    stage = stage_rows(spark, [
        (1, 10, None, "bundle", "b", 1, 1, D("10.00"), D("0.01"), D("0.07"), None),
        (1, 11, 10, "simple", "x", 1, 1, D("0"), D("0"), D("0"), D("3.33")),
        (1, 12, 10, "simple", "y", 1, 1, D("0"), D("0"), D("0"), D("3.33")),
        (1, 13, 10, "simple", "z", 1, 1, D("0"), D("0"), D("0"), D("3.33")),
        (2, 20, None, "bundle", "b", 1, 1, D("8.00"), D("0"), D("0"), None),
        (2, 21, 20, "simple", "x", 1, 1, D("0"), D("0"), D("0"), D("0")),
        (3, 30, None, "bundle", "b", 1, 1, D("0"), D("0"), D("0"), None),
        (3, 31, 30, "simple", "x", 1, 1, D("0"), D("0"), D("0"), D("5")),
    ])
    got = {r.item_id: r for r in fulfillment.balanced_bundle(stage).collect()}
    assert set(got) == {11, 12, 13, 21}
    assert sum(got[i].alloc_revenue_amt for i in (11, 12, 13)) == D("10.01")
    assert sum(got[i].alloc_tax_amt for i in (11, 12, 13)) == D("0.07")
    # a one-cent discount over three lines allocates nothing, so no line may take the cent
    assert sum(got[i].alloc_discount_amt for i in (11, 12, 13)) == 0
    assert got[21].alloc_revenue_amt == 0


# --------------------------------------------------------------------------- messages

def test_order_message_shapes(spark):
    base = {"order_id": 5, "message_uuid": "m", "schedule_id": 9, "base_total_order": 31.75, "created_at": "2022-03-04T05:06:07+00:00",
            "updated_at": ""}
    item = {"item_id": 42, "parent_item_id": 0, "is_gwp": 0, "base_row_total": 2.3000000000000003, "discount_detail": []}
    other = {"item_id": "41", "base_price": 8.25, "discount_detail": [{"rule_id": 12, "sponsored_percentage": .25}]}
    docs = [{**base, "items": [item, other], "payments": {CASH_APPLIED: {"applied_amt": 5, "other": "x"}}},
            {**base, "order_id": 6, "items": [], "payments": {CASH_APPLIED: [{"applied_amt": 1.255}, {"applied_amt": 2}]}},
            {**base, "order_id": 7}]
    q = queue_of(spark, "oc", *docs)
    head = ingest.parse_order_capture(q).filter("order_id = 5").first()
    assert head.created_at == dt.datetime(2022, 3, 4, 5, 6, 7) and head.updated_at is None and head.sechedule_id is None
    assert head.base_total_order == D("31.7500")
    assert values(ingest.explode_order_items(q), "item_id", "parent_item_id", "base_row_total", "is_gwp") == [
        (41, None, None, None), (42, "0", D("2.30"), "0")]
    assert values(ingest.explode_item_discounts(q), "item_id", "discount_id", "rule_id", "sponsored_percentage") == [(41, 1, 12, .25)]
    assert values(ingest.explode_order_cash(q), "order_id", "tc_id", "tc_amt") == [
        (5, 1, None), (5, 2, None), (6, 1, D("1.26")), (6, 2, D("2.00"))]


def test_parse_once_gives_the_same(spark, tmp_path):
    docs = [{"order_id": i, "message_uuid": f"m{i}", "items": [{"item_id": i * 10, "discount_detail": [{"rule_id": i}]}],
             "payments": {"payment_detail": [{"id": "p", "base_pay_amt": 1.5}]}} for i in range(3)]
    q = queue_of(spark, "oc", *docs)
    once = ingest.parse_once(q, "oc", str(tmp_path / "oc"))
    for f in (ingest.parse_order_capture, ingest.explode_order_items, ingest.explode_item_discounts, ingest.explode_order_payments):
        assert values(f(q), *f(q).columns) == values(f(once), *f(q).columns)


def test_fulfillment_messages(spark):
    def message(credit, fc, last, items=(1,)):
        return {"order_id": 1, "message_uuid": credit, "credit_memo_id": credit, "is_last_hj_shipment": last,
                "items": [{"item_id": i, "fc_detail": {"fc": [fc], "units_shipped": 2}} for i in items]}
    q = queue_of(spark, "of", message("0", "2", False), message("[]", "2", True), message("[12]", "1", False, (1, 2)), message(None, "2", None))
    assert values(ingest.parse_fulfillment(q), "credit_memo_id") == [("[12]",), (None,), (None,), (None,)]
    xref = spark.createDataFrame([(1, False), (2, True)], "fc_id int, is_hj boolean")
    held, rest = ingest.hold_partial_shipments(q, xref)
    assert values(held, "id") == [(1,)] and values(rest, "id") == [(2,), (3,), (4,)]
    staged = spark.createDataFrame([(2,)], "item_id bigint")
    assert values(ingest.explode_fulfillment_items(q, staged), "item_id", "message_uuid") == [(1, "0")]


def test_cancel_and_credit_messages(spark):
    q = queue_of(spark, "ocn", {"order_id": 1, "refunds": {"payment_detail": {"voided": True}}, CASH_EARNED: [{"item_id": 3, "earned_amt": "0.5"}]},
                 {"order_id": 2}, {"order_id": 1})
    assert values(ingest.explode_cancel_cash_earned(q), "order_id", "item_id", "earned_amt") == [(1, 3, D("0.5000"))]
    none = spark.createDataFrame([], "order_id bigint")
    headers = spark.createDataFrame([(2, "cancel")], "order_id bigint, status string")
    doubled, fresh = ingest.dedupe_order_cancel(q, none, none, headers)
    assert values(doubled, "id") == [(2,), (3,)] and values(fresh, "id") == [(1,)]
    cm = queue_of(spark, "cm", {"credit_id": 1, "refunds": {"payment_detail": {"id": None}, CASH_APPLIED: {"cash_give": 0}}},
                  {"credit_id": 2, "refunds": {"payment_detail": {"id": "x", "base_pay_amt": 2}, CASH_APPLIED: {"cash_give": "1.5"}}}, {"credit_id": 3})
    assert values(ingest.credit_refunds(cm), "credit_id", "base_pay_amt") == [(2, D("2.0000"))]
    assert values(ingest.credit_cash(cm), "credit_id", "tc_amt") == [(2, D("1.5000"))]


# --------------------------------------------------------------------------- other operators

def test_redemption_window(spark):
    t0 = dt.datetime(2024, 1, 1, 12, 0, 29)
    moves = spark.createDataFrame([(i, 1, 5.0, t0 + dt.timedelta(seconds=s)) for i, s in enumerate((-1, 0, 30, 31))],
                                  "id int, card_id bigint, card_delta double, updated_at timestamp_ntz")
    spent = spark.createDataFrame([(1, t0, 5.0, "inc", 9)], "gift_card_id bigint, created_at timestamp_ntz, pay_amt double, increment_id string, customer_id bigint")
    got = values(credits.redeeming_orders(moves, spent), "id", "redeeming_increment_id")
    assert got == [(0, None), (1, "inc"), (2, "inc"), (3, None)]


def test_rebate_first_and_last_day_and_no_end(spark):
    day = dt.date
    terms = [(1, 5, 1, day(2023, 1, 1), day(2024, 1, 1), D("10"), None), (2, 5, 1, day(2023, 1, 1), None, D("10"), None)]
    agreements = spark.createDataFrame(
        [(i, b, st, s, e, p, d, "Monthly", "By SKU", 1, 7) for i, b, st, s, e, p, d in terms],
        "item_id bigint, brand_id bigint, active_status_id int, start_date date, end_date date, percentage decimal(12,4),"
        " dollar_amount decimal(12,4), billing_period string, brand_sku string, billing_method_id bigint, rebate_agreement_id bigint")
    rows = spark.createDataFrame([(1, 1, 5), (2, 2, 5), (3, None, None)], "line bigint, item bigint, brand bigint")
    got = funding.rebate_waterfall(rows, agreements, funding.live_at("2023-06-01"), "item", "brand")
    assert values(got, "line", "rebate_percentage") == [(1, D("10.0000")), (2, None), (3, None)]


def test_discount_difference_of_exactly_half(spark):
    header = spark.createDataFrame([(1, "i", dt.datetime(2023, 1, 1))], "order_id bigint, increment_id string, created_at timestamp_ntz")
    items = spark.createDataFrame([(1, i, "0", "simple", D("1.0000"), 1, D(b), g) for i, b, g in (
        (1, "1.0000", "false"), (2, "1.0100", "false"), (3, "1.0000", "true"), (4, "-0.1000", "false"))],
        "order_id bigint, item_id bigint, parent_item_id string, product_type string, base_price decimal(12,4), qty_ordered int,"
        " base_discount_amt decimal(12,4), is_gwp string")
    pays = spark.createDataFrame([(1, "card")], "order_id bigint, payment_gateway string")
    detail = spark.createDataFrame([(i, "tpa", D("1.5000"), D("1.5000")) for i in (1, 2, 3, 4)],
                                   "item_id bigint, discount_type string, base_amt_off_applied decimal(12,4), amt_off_applied decimal(12,4)")
    assert values(checks.check_discounts(header, items, pays, detail), "item_id", "error_code") == [(1, 1), (4, 3)]


def test_ledger_duplicates_and_dedupe_agree(spark):
    led = spark.createDataFrame([(1, 16, None), (2, 16, None), (3, 16, "x"), (4, 16, "x"), (5, 17, "x")], "tran_id bigint, sub int, note string") \
               .withColumn("tran_sub_type", F.col("sub").cast("string"))
    assert values(checks.ledger_duplicates(led), "tran_id") == [(2,), (4,)]
    assert values(checks.ledger_dedupe(led), "tran_id") == [(1,), (3,), (5,)]
    assert values(checks.duplicate_profile(led), "tran_sub_type", "duplicates") == [("16", 2)]
