"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query writes its whole result to the ``noop`` sink, so no column is pruned away.
The figure is the median of $BENCH_RUNS warm runs (default 1) after one cold run.
``python bench.py name ...`` times the named queries, ``python bench.py all`` every one.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from tallyloom.plans import registry

HEADLINE = [
    "parse_order_capture", "explode_item_discounts", "dedupe_gift_card_adjustments", "hold_partial_shipments",
    "link_rebate_to_fulfillment", "post_order_payment", "post_product_tax", "reverse_order_postings",
    "fulfillment_worklist", "stage_fulfillment", "apply_allocation", "post_product_revenue", "post_tpa",
    "post_postship_refund", "gift_card_adjustment_enrich", "post_vendor_rebate", "post_tpr_funding",
    "check_order_payment", "check_discount_detail_over", "ledger_dedupe", "revenue_by_state",
    "vendor_rebate_report", "order_capture_pipeline",
]


def session(cpus: str) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("tallyloom-bench")
             .config("spark.driver.memory", "16g").config("spark.sql.shuffle.partitions", cpus)
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(run, spark, sf_dir) -> float:
    start = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    known = registry.queries()
    names = sys.argv[1:] or HEADLINE
    names = list(known) if names == ["all"] else names
    spark = session(cpus)
    times = {}
    for name in names:
        seconds(known[name], spark, sf_dir)
        times[name] = round(statistics.median(seconds(known[name], spark, sf_dir) for _ in range(runs)), 3)
    print(json.dumps({"metric": "total_seconds_headline_queries", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus,
                      "shuffle_partitions": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
