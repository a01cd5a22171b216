"""Registry of checked queries: name -> callable(src) -> DataFrame.

``queries(spark, sf_dir)`` binds each entry to the test-data source; the
same report functions run unchanged on a Parquet or JDBC source in
production (see ``fleetyard.sources.tables``).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from fleetyard.plans import (equipment, parts, purchasing, receipts, reservations, work_orders,
                             yard)
from fleetyard.plans.params import AS_OF, FULL_WINDOW, PAYMENT_GROUPS, SLICE_DAYS
from fleetyard.sources.testdata import TestdataTables

Report = Callable[[object], DataFrame]


def as_doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles: the checked queries compare numbers with the
    oracle's; deliveries keep the decimals."""
    kinds = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, DecimalType)}
    return df.withColumns({c: F.col(c).cast("double") for c in kinds}) if kinds else df


REPORTS: dict[str, Report] = {
    # report pipelines
    "work_orders_latest": lambda s: work_orders.work_orders_latest(s),
    "work_order_operations": lambda s: work_orders.work_order_operations(s),
    "equipment_register": lambda s: equipment.equipment_register(s),
    "order_supplies": lambda s: work_orders.order_supplies(s),
    "purchasing_tracker": lambda s: purchasing.purchasing_tracker(s, AS_OF, FULL_WINDOW, 0),
    "yard_current": lambda s: yard.yard_current(s),
    "yard_history": lambda s: yard.yard_history(s),
    "hourmeter_latest": lambda s: yard.hourmeter_latest(s),
    "hourmeter_invalid_latest": lambda s: yard.hourmeter_invalid_latest(s),
    "reservation_picking": lambda s: reservations.reservation_picking(s),
    "po_approvals": lambda s: purchasing.po_approvals(s),
    "po_payment": lambda s: purchasing.po_payment(s, AS_OF, FULL_WINDOW),
    "receipts_status": lambda s: receipts.receipts_status(s),
    "parts_history": lambda s: parts.parts_history(s, AS_OF, FULL_WINDOW, 0),
    "po_payment_by_item": lambda s: purchasing.po_payment_by_item(s),
    "receipts_by_order": lambda s: receipts.receipts_by_order(s),
    "yard_snapshot_topn": lambda s: yard.yard_snapshot_rows(s),
    "yard_snapshot_events": lambda s: yard.yard_snapshot(s)[1],
    "yard_payload": lambda s: yard.yard_payload(s, "1970-01-01T00:00:00+00:00"),
    "po_approvals_workflow": lambda s: purchasing.po_approvals_workflow(s, AS_OF, FULL_WINDOW),
    # operators exercised on their own
    "order_items_union": lambda s: work_orders.order_items(s),
    "priority_dedupe": lambda s: work_orders.dedupe_items(work_orders.order_items(s)),
    "lot_position_rollup": lambda s: reservations.lot_positions(reservations.bin_stock(s)),
    # the features that leave rows out, with parameters that do so on the test data
    "yard_newest_500": lambda s: yard.yard_snapshot(s, 500)[1],
    "yard_newest_500_current": lambda s: yard.yard_snapshot(s, 500)[0],
    "po_payment_of_groups": lambda s: purchasing.po_payment_by_item(s, groups=PAYMENT_GROUPS),
    "po_payment_with_items": lambda s: purchasing.po_payment(s, AS_OF, FULL_WINDOW, require_items=True),
    "day_slices": lambda s: parts.parts_history(s, AS_OF, FULL_WINDOW, 0, slice_days=SLICE_DAYS),
}


def _register_operator_queries():
    from fleetyard.plans import delivery_queries, operator_queries
    for module in (operator_queries, delivery_queries):
        for name, fn in module.QUERIES.items():
            REPORTS.setdefault(name, fn)


_register_operator_queries()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(f: Report):
        return lambda spark, sf_dir: as_doubles(f(TestdataTables(spark, sf_dir)))
    return {name: bind(f) for name, f in REPORTS.items()}
