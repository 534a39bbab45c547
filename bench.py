"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS set the data, the cores and the number
of timed runs after one warm-up; BENCH_QUERIES is a comma list or ``all``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starloom.runtime import local_session  # noqa: E402
from starloom.workload.all_queries import QUERIES  # noqa: E402

HEADLINE = [
    "date_spine", "week_of_year_us", "dim_date", "fiscal_period_bounds", "holiday_calendar",
    "dim_customer", "dim_product", "dim_sales_reason", "dim_store", "delta_dim_customer", "latest_per_key",
    "fact_sales_full", "fact_line_amounts", "delta_fact_sales", "fact_key_lookup_unknown", "fact_insert_only",
    "assign_surrogate_key", "number_stored_fact", "scd2_merge_profile", "scd2_merge_sales_reason", "watermark_extract",
    "cleanse_table", "xml_survey_struct", "xml_pivot_dynamic", "dq_foreign_keys", "dq_duplicate_grain",
    "fact_merge", "fact_sales_allocated", "customer_by_ship_to", "scd2_merge_customer", "incremental_run_status",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr)
    print(json.dumps({
        "metric": "total seconds of the headline queries, warm", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus, "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
