"""Benchmark: wall time of every report pipeline at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each report runs to completion through the ``noop`` sink (all stages
execute, nothing is collected to the driver). Prints one JSON line.
"""
from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

REPORTS_FN: dict = {}
REPORTS = [
    "work_orders_latest", "work_order_operations", "equipment_register", "order_supplies",
    "purchasing_tracker", "yard_current", "yard_history", "hourmeter_latest",
    "hourmeter_invalid_latest", "reservation_picking", "po_approvals", "po_payment",
    "receipts_status", "parts_history", "po_payment_by_item", "receipts_by_order",
    "yard_snapshot_topn", "po_approvals_workflow",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = sys.argv[1:]
    from duck_oracle.adapters import TABLES
    from fleetyard.plans.registry import REPORTS as ALL_REPORTS
    from fleetyard.session import build_session, checkpoint_dir
    from fleetyard.sources.landing import land_bucketed
    from fleetyard.sources.testdata import TestdataTables

    global REPORTS_FN
    REPORTS_FN = ALL_REPORTS
    spark = build_session(f"local[{cpus}]", app="fleetyard-bench",
                          shuffle_partitions=max(8, cpus * 2),
                          extra={"spark.driver.memory": "16g",
                                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m"})
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM warm-up
    # Land the ERP-shaped tables derived from the test data once, as a
    # replica extract is landed in production: a catalog database in the
    # shared checkpoint folder, order-keyed tables bucketed by order number,
    # the others sorted on their filter columns. Reports read the catalog.
    t = time.perf_counter()
    names = [n for n in TABLES if n not in ("o", "li", "po_li")]
    root = f"{checkpoint_dir(spark).rstrip('/')}/warehouse-{os.getpid()}"
    src = land_bucketed(spark, TestdataTables(spark, sf_dir), names, "fleetyard_bench", root,
                        buckets=max(8, cpus * 2))
    landing = round(time.perf_counter() - t, 3)
    print(f"landing: {landing}s", file=sys.stderr, flush=True)
    times: dict[str, float] = {}
    for name in REPORTS:
        if only and name not in only:
            continue
        t = time.perf_counter()
        REPORTS_FN[name](src).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "report_suite_wall_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
                      "setup_landing_sec": landing}))


if __name__ == "__main__":
    main()
