"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of the sample tables, ``BENCH_CPUS`` the
number of local threads. Each query runs once unmeasured and is then timed;
the value is the sum of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tidestar import build_session, suite

HEADLINE = [
    "dedup_order_items", "dedup_missing_times", "build_dim_customer", "build_dim_date", "build_fact_orders",
    "build_fact_orders_salted", "fact_rejects", "scd2_merge_customer", "scd2_merge_product", "scd2_history_items",
    "snapshot_diff_cdc", "delete_from_fact", "read_cdc_parquet", "fact_day_partition", "process_batch",
    "surrogate_key_composite", "md5_hex", "q_row_counts", "q_star_join_top20", "q_top_customers", "q_top_products",
    "q_daily_sales", "q_quarter_category", "q_category_totals", "q_top5_spend", "q_first_customer_history",
    "q_orphan_customers", "q_scd2_versions", "q_facts_latest", "q_fact_count_as_of", "q_mismatched_totals",
    "q_order_totals",
]
# Each run writes a warehouse of its own.
ONE_RUN = {"process_batch"}


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = suite.queries()
    chosen = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    times: dict[str, float] = {}
    for name in chosen:
        def run(name: str = name) -> None:
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        times[name] = round(statistics.median(timed(run) for _ in range(1 if name in ONE_RUN else runs)), 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_total", "value": total, "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
