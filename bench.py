"""Benchmark the headline queries.

Runs a representative set of registered queries on ``$BENCH_SF_DIR``
(default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints ONE
JSON line: {"metric", "value", "unit", "queries": {key: sec}, "sf"}.

Each query is executed to completion with the ``noop`` sink (every row is
computed, nothing is collected to the driver). A warm-up run of each query
is excluded (JVM code generation and file listing); the time is the best of
``$BENCH_REPEAT`` (default 2) measured runs.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "agg09_distinct_orders_month_category",   # flagship: star join + monthly cube
    "joi02_fact_sales_star",
    "agg16_rollup_state_month",
    "agg21_grouping_sets_dims",
    "agg24_delivery_percentiles",
    "agg05_word_count",
    "agg29_cohort_table",
    "win04_top3_per_category",
    "win07_running_and_moving_sum",
    "win12_cumulative_and_lag_per_key",
    "win14_global_sequence_id",
    "sub03_correlated_state_average",
    "sub04_freight_above_other_orders",
    "sub13_recursive_rollup_descendants",
    "joi03_preaggregated_left_joins",
    "joi05_lookup_as_array",
    "agg34_daily_sales",
    "pip05_balancing_interval",
    "pip06_balancing_greedy",
    "pip07_wide_order_item_table",
    "pip09_scd2_customer_dimension",
    "dq08_foreign_keys",
    "str03_tumbling_window_aggregate",
    "pip03_raw_to_silver_three_entities",
]

# Rows each throughput figure is computed over: (query, tables whose rows it processes).
THROUGHPUT = {
    "raw_to_silver_rows_per_s": ("pip03_raw_to_silver_three_entities", ("customer", "orders", "lineitem")),
    "stream_events_per_s": ("str03_tumbling_window_aggregate", ("events",)),
    "star_join_rows_per_s": ("joi02_fact_sales_star", ("lineitem",)),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    from cuenca.session import get_session
    from cuenca.plans.registry import load_all

    # spark.checkpoint.dir comes from the environment's Spark defaults;
    # cuenca.session.checkpoint_dir falls back to a scratch folder if unset.
    spark = get_session(
        f"local[{cpus}]", app="cuenca-bench", shuffle_partitions=max(8, 2 * cpus),
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "4g"),
               "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    reg = load_all()
    keys = only or HEADLINE
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for k in keys:
        build = reg[k].build
        try:
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
            best = None
            for _ in range(repeat):
                t0 = time.perf_counter()
                build(spark, sf_dir).write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                best = dt if best is None else min(best, dt)
            times[k] = round(best, 3)
        except Exception as e:  # report the failure, keep measuring the others
            failed[k] = str(e).splitlines()[0][:200]
    from cuenca.sources.tables import read_table
    throughput = {}
    for name, (q, tables) in THROUGHPUT.items():
        if q in times and times[q] > 0:
            rows = sum(read_table(spark, sf_dir, tb).count() for tb in tables)
            throughput[name] = round(rows / times[q])
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
           "throughput": throughput}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
