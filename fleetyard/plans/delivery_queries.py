"""Checked queries of reads in parts, popular keys, sliced runs, deliveries, versions and kept state.

Each works on the whole test-data tables through the operator it is named for.
What it writes on the way (a sliced run, an outbox, a versioned table) is removed
once the result is kept.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetyard.functions import not_blank, strip_zeros
from fleetyard.operators.keyed import latest_by
from fleetyard.operators.keyed_diff import SAME, change_counts, keyed_diff
from fleetyard.operators.maintained import refreshed_latest
from fleetyard.operators.profiles import LG_HLL, exact_profile, report, sketches
from fleetyard.operators.profiles import merged as sketches_merged
from fleetyard.plans import equipment, parts, purchasing, receipts, reservations, work_orders
from fleetyard.plans.params import AS_OF, EARLIER_DAY, FULL_WINDOW, PAYMENT_GROUPS, WIDE_SLICE_DAYS
from fleetyard.plans.parts_state import PartsState
from fleetyard.plans.slices import SliceRun
from fleetyard.plans.yard import YARD
from fleetyard.session import checkpoint_dir, discard, materialize
from fleetyard.sources import outbox
from fleetyard.sources.delivery import number_rows
from fleetyard.sources.key_ranges import depths, equal_depth_bounds
from fleetyard.sources.tables import RoutedTables
from fleetyard.sources.versions import VersionedTable
from fleetyard.streaming.polling import YardPoll

RANGE_KEY, RANGE_PARTS = ("gewrk", "aufnr"), 12


def _in_scratch(spark, work: Callable[[str], DataFrame]) -> DataFrame:
    """The result of ``work(folder)``, kept; the folder is removed."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/work-{uuid.uuid4().hex}"
    try:
        return materialize(work(folder), "result")[0]
    finally:
        discard(spark, folder)


def key_range_depths(src) -> DataFrame:
    """Rows of every part when order headers are cut by work centre and number into
    parts of equal depth (a few work centres hold all rows; some rows have none)."""
    rows = src.table("afih").select(*RANGE_KEY)
    return depths(rows, RANGE_KEY, equal_depth_bounds(rows, RANGE_KEY, RANGE_PARTS))


def reservation_picking_dealt(src) -> DataFrame:
    """J10 with the rows of popular materials dealt over tasks."""
    return reservations.reservation_picking(src, hot=reservations.hot_materials(src))


def parts_history_dealt(src) -> DataFrame:
    """J15 with the rows of popular parts dealt over tasks."""
    return parts.parts_history(src, AS_OF, FULL_WINDOW, 0, hot=parts.hot_parts(src))


def purchasing_tracker_dealt(src) -> DataFrame:
    """J05 with the rows of popular materials dealt over tasks."""
    return purchasing.purchasing_tracker(src, AS_OF, FULL_WINDOW, 0, hot=purchasing.hot_requested(src, AS_OF, FULL_WINDOW, 0))


def sliced_run(src) -> DataFrame:
    """J15 by day slices, each entered in a ledger, all read back together."""

    def work(folder: str) -> DataFrame:
        run = SliceRun.start(src, folder, "pecas_historico", "all", AS_OF, ini=FULL_WINDOW, fim=0, slice_days=WIDE_SLICE_DAYS)
        run.work(src)
        return run.rows()

    return _in_scratch(src.spark, work)


def outbox_batches(src) -> DataFrame:
    """Batches of the payment report as a receiver finds them in the outbox."""

    def work(folder: str) -> DataFrame:
        sent = outbox.send(purchasing.po_payment(src, AS_OF, FULL_WINDOW), folder, "pagamento_pedidos", [F.col("pedido")])
        docs = outbox.batches(src.spark, folder, "pagamento_pedidos", sent.delivery)
        shape = "batch long, total_batches long, row_count long, total_rows long, rows array<struct<pedido: string>>"
        return docs.select(F.from_json("json", shape).alias("d")).select(
            "d.batch", "d.total_batches", "d.row_count", "d.total_rows",
            F.size("d.rows").cast("long").alias("rows_there"),
            F.element_at("d.rows", 1)["pedido"].alias("first_key"), F.element_at("d.rows", -1)["pedido"].alias("last_key"))

    return _in_scratch(src.spark, work)


def _payments(src) -> list[DataFrame]:
    """Three states of the payment table: some buyers, all by item, all by order."""
    return [purchasing.po_payment_by_item(src, groups=PAYMENT_GROUPS), purchasing.po_payment_by_item(src),
            purchasing.po_payment(src, AS_OF, FULL_WINDOW).select("pedido", "status_pagamento")]


def payment_versions(src) -> DataFrame:
    """Every version of the payment table after three merges, read back."""

    def work(folder: str) -> DataFrame:
        table = VersionedTable.at(src.spark, folder, ["pedido"])
        for n, report in enumerate(_payments(src), 1):
            table.merge(report)
            if n == 2:
                table.compact()
        out = None
        for v in sorted(table.versions()):
            part = table.read(v).withColumn("version", F.lit(v).cast("long"))
            out = part if out is None else out.unionByName(part)
        return out

    return _in_scratch(src.spark, work)


def payment_changes(src) -> DataFrame:
    """Inserted, changed and deleted orders of each merge."""

    def work(folder: str) -> DataFrame:
        table = VersionedTable.at(src.spark, folder, ["pedido"])
        for report in reversed(_payments(src)):
            table.merge(report)
        rows = [(v, k, r[k]) for v, r in table.versions().items() for k in ("insert", "update", "delete")]
        return src.spark.createDataFrame(rows, "version long, op string, n long")

    return _in_scratch(src.spark, work)


def _payment_diff(src) -> DataFrame:
    """Old rule (by item) against new rule (by order)."""
    _, old, new = _payments(src)
    return keyed_diff(old, new, ["pedido"])


def dq_payment_changes(src) -> DataFrame:
    """Orders whose payment status differs between the old and the new rule."""
    d = _payment_diff(src).filter(F.col("op") != SAME)
    return d.select("pedido", "op", F.array_join("changed", ",").alias("changed"),
                    F.col("old.status_pagamento").alias("old_status"), F.col("new.status_pagamento").alias("new_status"))


def dq_payment_change_counts(src) -> DataFrame:
    """How many orders were inserted, deleted, changed or the same, and by column."""
    return change_counts(_payment_diff(src), ["status_pagamento"])


# ------------------------------------------------------------------ delivery order
def _placed(df: DataFrame, shown: list[str], *order) -> DataFrame:
    """Rows with their place in the delivery order (0-based)."""
    return number_rows(df.select(*shown), list(order), col="place")[0].select("place", *shown)


def receipts_ordered(src) -> DataFrame:
    """J14 in delivery order: finished receipts first, newest date first."""
    shown = ["status_migo", "data_do_recebimento_fisico", "pedido", "requisicao"]
    return _placed(receipts.receipts_status(src), shown, F.col(shown[0]), F.col(shown[1]).desc_nulls_last(),
                   *[F.col(c).asc_nulls_last() for c in shown[2:]])


def equipment_ordered(src) -> DataFrame:
    """J03 in delivery order: by asset, those without a number last."""
    shown = ["ativo", "descricao", "chassi"]
    return _placed(equipment.equipment_register(src), shown, *[F.col(c).asc_nulls_last() for c in shown])


def operations_ordered(src) -> DataFrame:
    """J02 in delivery order: branch, asset, order, operation."""
    shown = ["filial", "ativo", "ordem", "num_operacao", "centro_trabalho_operacao", "status_operacao"]
    return _placed(work_orders.work_order_operations(src), shown, *[F.col(c).asc_nulls_last() for c in shown])


# ------------------------------------------------------------------ kept state
def latest_orders_maintained(src) -> DataFrame:
    """Latest order per asset, from winners of an earlier day and the changes since:
    orders created later, orders dated wrongly then, and orders deleted meanwhile."""
    rows = (src.table("aufk").select("aufnr", "erdat").join(src.table("afih").filter(not_blank("equnr")).select("aufnr", "equnr"), "aufnr")
            .select(strip_zeros("equnr").alias("ativo"), "aufnr", "erdat"))
    number = F.col("aufnr").cast("bigint")
    gone, wrong, later = number % 11 == 0, number % 13 == 0, F.col("erdat") >= EARLIER_DAY
    order = [F.col("erdat").desc_nulls_last(), F.col("aufnr").desc()]
    then = rows.filter(~later).withColumn("erdat", F.when(wrong, "2099-12-31").otherwise(F.col("erdat")))
    now = rows.filter(~gone)
    return refreshed_latest(latest_by(then, "ativo", order), now.filter(later | wrong), rows.filter(gone).select("aufnr"),
                            now, ["ativo"], ["aufnr"], order)


def parts_history_merged(src) -> DataFrame:
    """J15 from aggregates kept by day slices, merged with the window's ends."""
    return _in_scratch(src.spark, lambda folder: PartsState(src.spark, folder, 365).history(src, AS_OF, FULL_WINDOW, 0))


def yard_polled(src) -> DataFrame:
    """The yard after three polls; at each, the newest events are incomplete."""

    def work(folder: str) -> DataFrame:
        events = src.table(YARD)
        low, high = events.agg(F.min("id"), F.max("id")).first()
        overlap = (high - low) // 8 + 1
        poll = YardPoll(src.spark, folder, overlap)
        for third in (1, 2):
            top = low + (high - low) * third // 3
            young = (F.col("id") > top - overlap // 2) & (F.col("id") % 3 == 0)
            poll.poll(RoutedTables(src, {YARD: _Frame(events.filter((F.col("id") <= top) & ~young))}))
        poll.poll(src)
        return poll.current()

    return _in_scratch(src.spark, work)


class _Frame:
    """One table as a source."""

    def __init__(self, df: DataFrame):
        self.df = df

    def table(self, name: str) -> DataFrame:
        return self.df


PROFILED = ["aufnr", "erdat", "idat2", "loekz", "ernam", "auart"]


def dq_profile(src) -> DataFrame:
    """Rows, NULLs, blanks and distinct values of order header columns, counted."""
    return exact_profile(src.table("aufk"), PROFILED)


def dq_profile_sketched(src) -> DataFrame:
    """The same from sketches by creation year, merged; whether the estimated
    distinct count is within three standard errors of the exact one."""
    a = src.table("aufk")
    by_year = sketches(a.withColumn("__year", F.substring("erdat", 1, 4)), ["__year"], PROFILED)
    got = report(sketches_merged(by_year))
    exact = exact_profile(a, PROFILED).select("column", F.col("distinct").alias("exact"))
    off = F.abs(F.col("distinct") - F.col("exact"))
    return got.join(exact, "column").select("column", "rows", "nulls", "blanks", (
        off <= F.greatest(F.lit(2.0), F.col("exact") * 3 * 1.04 / 2 ** (LG_HLL / 2))).alias("within"))


QUERIES = {f.__name__: f for f in (
    receipts_ordered, equipment_ordered, operations_ordered, latest_orders_maintained, parts_history_merged, yard_polled, dq_profile, dq_profile_sketched,
    key_range_depths, reservation_picking_dealt, parts_history_dealt, purchasing_tracker_dealt, sliced_run, outbox_batches,
    payment_versions, payment_changes, dq_payment_changes, dq_payment_change_counts)}
