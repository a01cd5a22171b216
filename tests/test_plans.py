"""Physical-plan properties that matter at scale."""
import os
import re
import tempfile

import pytest

from fleetyard.plans.registry import REPORTS
from fleetyard.sources.landing import land

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "FlatMapGroupsInPandas", "MapInPandas")
# bounded single-partition steps: the 50k top-N payload and the per-batch
# totals / per-partition offsets of delivery numbering
SINGLE_PARTITION_OK = {"yard_snapshot_topn", "yard_snapshot_events", "yard_payload", "yard_newest_500",
                       "yard_newest_500_current", "delivery_batches",
                       "yard_payload_fields", "work_orders_ordered", "receipts_ordered", "equipment_ordered",
                       "operations_ordered"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def landed(spark, small_src):
    from duck_oracle.adapters import TABLES
    names = [n for n in TABLES if n not in ("o", "li", "po_li")]
    root = tempfile.mkdtemp(prefix="landing-", dir=os.environ.get("TMPDIR", "/tmp"))
    return land(spark, small_src, names, root, files_per_table=2)


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_no_udf_cartesian_or_unbounded_single_partition(landed, name):
    if name in ("json_encoding",):
        pytest.skip("rendering only")
    p = plan_of(REPORTS[name](landed))
    for op in FORBIDDEN:
        assert op not in p, (name, op)
    if name not in SINGLE_PARTITION_OK:
        lines = p.splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                # allowed only for a global aggregate fed by its partial step
                # (one row per input partition crosses the exchange)
                assert "partial_" in lines[i + 1], (name, lines[i:i + 2])


def test_latest_by_is_partially_limited_before_shuffle(landed):
    p = plan_of(REPORTS["yard_current"](landed))
    assert re.search(r"WindowGroupLimit .*Partial", p), p
    assert re.search(r"WindowGroupLimit .*Final", p), p


def test_filters_reach_parquet_scans(landed):
    p = plan_of(REPORTS["work_orders_latest"](landed))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(erdat,2024-01-01\)", p), p
    p = plan_of(REPORTS["reservation_picking"](landed))
    assert re.search(r"PushedFilters: \[[^\]]*In\(lgort", p), p
    p = plan_of(REPORTS["purchasing_tracker"](landed))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(badat,", p), p


def test_column_pruning(landed):
    p = plan_of(REPORTS["po_payment"](landed))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert scans and all("lifnr" not in s and "frgrl" not in s for s in scans), scans


@pytest.mark.parametrize("name,table,most", [
    ("reservation_picking", "resb", 1), ("reservation_picking", "afih", 1), ("purchasing_tracker", "eban", 1),
    ("purchasing_tracker", "ekpo", 1), ("order_supplies", "eban", 2), ("order_supplies", "ekpo", 1), ("order_supplies", "resb", 1),
    ("parts_history", "resb", 1), ("work_orders_latest", "aufk", 1), ("work_orders_latest", "afih", 1), ("work_order_operations", "aufk", 1), ("work_order_operations", "afvc", 1), ("dq_diff", "ekko", 2)])
def test_big_tables_are_scanned_once(spark, landed, name, table, most):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan_of(REPORTS[name](landed))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    scans = [x for x in p.splitlines() if "FileScan parquet" in x and f"/{table}]" in x]
    assert 1 <= len(scans) <= most, (name, table, len(scans))


def test_purchasing_tracker_joins(spark, landed):
    p = plan_of(REPORTS["purchasing_tracker"](landed))
    assert len(re.findall(r"\b(?:SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)\b", p)) <= 8


def test_purchasing_tracker_moves_rows_once_by_purchase_order(spark, landed):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan_of(REPORTS["purchasing_tracker"](landed))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    by_item = re.findall(r"Exchange hashpartitioning\(\w+#\d+, ebelp#\d+", p)
    by_order = re.findall(r"Exchange hashpartitioning\(__po#\d+, \d+\)", p)
    assert not by_item and len(by_order) == 2, (by_item, by_order)      # the rows with the histories, and the headers
