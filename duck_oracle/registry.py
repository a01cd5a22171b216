"""Oracle SQL per registered query name."""
from __future__ import annotations

from duck_oracle import reports as R

SQL = {
    "work_orders_latest": R.work_orders_latest,
    "work_order_operations": R.work_order_operations,
    "equipment_register": R.equipment_register,
    "order_supplies": R.order_supplies,
    "purchasing_tracker": R.purchasing_tracker,
    "yard_current": R.yard_current,
    "yard_history": R.yard_history,
    "hourmeter_latest": R.hourmeter_latest,
    "hourmeter_invalid_latest": R.hourmeter_invalid_latest,
    "reservation_picking": R.reservation_picking,
    "po_approvals": R.po_approvals,
    "po_payment": R.po_payment,
    "receipts_status": R.receipts_status,
    "parts_history": R.parts_history,
    "po_payment_by_item": R.po_payment_by_item,
    "receipts_by_order": R.receipts_by_order,
    "yard_snapshot_topn": R.yard_snapshot_rows,
    "yard_snapshot_events": R.yard_snapshot_events,
    "po_approvals_workflow": R.po_approvals_workflow,
    "order_items_union": R.order_items_union,
    "priority_dedupe": R.priority_dedupe,
    "lot_position_rollup": R.lot_position_rollup,
    "day_slices": R.day_slices,
}


def _register_operator_sql():
    from duck_oracle import deliveries, operators
    for module in (operators, deliveries):
        for name, fn in module.SQL.items():
            SQL.setdefault(name, fn)


_register_operator_sql()


def oracle_sql() -> dict[str, str]:
    return {name: f() for name, f in SQL.items()}
