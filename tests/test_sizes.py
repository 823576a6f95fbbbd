"""Steps whose work must not grow by fan-out, missing keys or repeated scans."""

from decimal import Decimal

import __spark_entry__ as e
from tallyloom.operators import reports


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_parties_of_a_brand_multiply_sums_without_a_row_each(spark):
    terms = ", ".join(f"cast(null as string) as {c}" for c in reports.TERMS)
    rows = spark.sql("select 'b' as brand_name, 1L as rebate_billing_method, 's' as sku, 'd' as description, 2L as _qty, cast(1.5 as decimal(14,4)) as _cogs,"
                     f" cast(null as decimal(14,4)) as _rebate, {terms} union all select null, null, 's', 'd', 5L, cast(2 as decimal(14,4)), null, {terms}")
    agreements = spark.createDataFrame([("b", 1, 7, 9), ("b", 2, 7, 9), ("b", 3, None, 9), (None, 4, 1, 1)],
                                       "brand_records_name string, brand_id long, billing_customer_id long, vendor_id long")
    methods = spark.createDataFrame([(1, "m"), (1, "m")], "list_id long, list_item_name string")
    got = reports._named_sums(rows, *reports._parties(agreements, methods)).select("brand_name", "cust_vend", "list_item_name", *reports._REPORT_SUMS).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [("b", 7, "m", 8, Decimal(6), None), ("b", 9, "m", 4, Decimal(3), None), (None, None, None, 5, Decimal(2), None)], key=str)


def test_rows_without_an_order_are_spread(spark, sf_dir):
    assert "_spread" in plan(e.queries()["gift_card_adjustment_enrich"](spark, sf_dir))


def test_coupons_are_read_once(spark, sf_dir):
    # one semi join with the journal per member of the ledger's union
    assert plan(e.queries()["crm_discounts"](spark, sf_dir)).count("LeftSemi") == 3
