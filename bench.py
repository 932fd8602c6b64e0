"""Time the headline queries and print one JSON line.

Each query runs twice and the second run counts: the first pays for class
loading and code generation, which a long-lived session pays once.

BENCH_SF_DIR   folder of sample tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
"""

from __future__ import annotations

import json
import os
import time

from shopledger.session import local_session
from verification.queries import registered

HEADLINE = (
    "extract_incremental",
    "extract_manifest",
    "silver_customers",
    "silver_order_items",
    "quality_report",
    "check_referential_integrity",
    "fact_sales",
    "fact_sales_verified",
    "fact_campaign_events",
    "load_assertions",
    "vw_executive_summary",
    "vw_daily_sales",
    "vw_product_performance",
    "vw_customer_segments",
    "vw_campaign_performance",
    "idempotency_check",
)


def run_once(build, spark, folder: str) -> float:
    """Seconds to plan the query and produce all its rows."""
    started = time.perf_counter()
    build(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    builders = registered()
    seconds = {}
    for name in HEADLINE:
        run_once(builders[name], spark, folder)
        seconds[name] = round(run_once(builders[name], spark, folder), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
