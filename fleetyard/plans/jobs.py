"""Scheduled jobs: report x parameters x delivery, as one Spark job each.

The source runner executed each statement per slice (storage location, day
window) in a serial loop and posted 2,000-row batches. Here a job is one
DataFrame: value slices are an ``isin`` filter, day slices a slice-id column
(``parts_history(slice_days=...)``), and the batches are written as JSON
documents by the executors.
"""
from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetyard.plans import (equipment, parts, purchasing, receipts, reservations, work_orders,
                             yard)
from fleetyard.sources import outbox
from fleetyard.sources.delivery import BATCH_ROWS, deliver, run_log, write_snapshot
from fleetyard.sources.versions import VersionedTable


@dataclass(frozen=True)
class Job:
    report: Callable[..., DataFrame]
    order: tuple[str, ...]                        # delivery order (made total by the key columns)
    defaults: dict = field(default_factory=dict)  # rolling-window parameters
    uses_as_of: bool = False
    style: str = "runner"                         # envelope: runner, legacy (rows in batches) or yard (one document)
    internal: tuple[str, ...] = ()                # columns that are not delivered
    hot: Callable | None = None                   # measures popular keys: (src, parameters) -> HotKeys
    keys: tuple[str, ...] = ()                    # names one row of the report, where it has such a key


def _cols(*names):
    return names


JOBS: dict[str, Job] = {
    "ordens_servico": Job(work_orders.work_orders_latest, _cols("filial", "ativo", "tipo_manutencao"),
                          keys=("ativo", "tipo_manutencao")),
    "os_operacoes": Job(work_orders.work_order_operations,
                        _cols("filial", "ativo", "ordem", "num_operacao", "status_operacao",
                              "descricao_operacao", "tempo_previsto_h")),
    "equipamentos": Job(equipment.equipment_register, _cols("ativo", "descricao", "chassi")),
    "os_suprimentos": Job(work_orders.order_supplies, _cols("ativo", "ordem", "cod_sap")),
    "suprimentos_compras": Job(purchasing.purchasing_tracker,
                               _cols("num_rc", "item_rc", "num_operacao"),
                               {"ini": 30, "fim": 0}, uses_as_of=True, hot=purchasing.hot_requested),
    "uca_patio": Job(yard.yard_current, _cols("n_armac"), keys=("n_armac",)),
    "uca_historico": Job(yard.yard_history, _cols("ts", "n_armac", "tipo_relatorio", "filial")),
    "horimetros": Job(yard.hourmeter_latest, _cols("n_armac"), keys=("n_armac",)),
    "horimetros_invalidos": Job(yard.hourmeter_invalid_latest, _cols("n_armac"), keys=("n_armac",)),
    "reservas_separacao": Job(reservations.reservation_picking,
                              _cols("chave", "data", "remessa"), hot=reservations.hot_materials),
    "aprovacao_pedidos": Job(purchasing.po_approvals,
                             _cols("pedido", "aprovador", "data_inicio", "hora_inicio"),
                             {"ini": None}, uses_as_of=True,
                             keys=("pedido", "aprovador", "data_inicio", "hora_inicio")),
    "pagamento_pedidos": Job(purchasing.po_payment, _cols("pedido"), {"ini": 90}, uses_as_of=True, keys=("pedido",)),
    "migo_recebimentos": Job(receipts.receipts_status,
                             _cols("status_migo", "data_do_recebimento_fisico", "pedido",
                                   "requisicao")),
    "pecas_historico": Job(parts.parts_history, _cols("ativo", "cod_sap", "fatia"),
                           {"ini": 365, "fim": 0, "slice_days": 45}, uses_as_of=True,
                           internal=("fatia",), hot=lambda src, **_: parts.hot_parts(src)),
    # the three older stand-alone jobs, with their own envelopes
    "pagamento_por_item": Job(purchasing.po_payment_by_item, _cols("pedido"),
                              {"groups": None, "creators": None}, style="legacy", keys=("pedido",)),
    "recebimentos_por_pedido": Job(receipts.receipts_by_order, _cols("pedido"), style="legacy", keys=("pedido",)),
    "uca_payload": Job(yard.yard_payload, (), {"n_events": yard.SNAPSHOT_EVENTS}, style="yard"),
}


def build(name: str, src, as_of=None, spread: bool = False, **params) -> DataFrame:
    """The job's report with its defaults overridden by ``params``.

    ``spread``: measure popular keys first and deal their rows over tasks (for
    reports that join on such keys; the rows are the same)."""
    job = JOBS[name]
    unknown = set(params) - set(job.defaults)
    if unknown:
        raise TypeError(f"job {name!r} takes no parameter(s) {sorted(unknown)}")
    kw = {**job.defaults, **{k: v for k, v in params.items() if v is not None}}
    if job.uses_as_of:
        kw["as_of"] = as_of
    if spread and job.hot:
        kw["hot"] = job.hot(src, **{k: v for k, v in kw.items() if k != "slice_days"})
    return job.report(src, **kw)


def _run_folder(out_dir: str, started: str) -> str:
    at = started.replace(":", "").replace("+0000", "Z")
    return f"{out_dir.rstrip('/')}/run-{at}-{uuid.uuid4().hex[:8]}"


def snapshot(name: str, src, out_dir: str, as_of=None, **params) -> str:
    """Write the job's report as a table (Parquet, decimals kept) to a folder of
    its own below ``out_dir``, the destination table of the job; returns it."""
    folder = _run_folder(out_dir, _dt.datetime.now(_dt.timezone.utc).isoformat())
    write_snapshot(build(name, src, as_of, **params).drop(*JOBS[name].internal), folder)
    return folder


def merge(name: str, src, table: str, as_of=None, **params) -> dict[str, int]:
    """Make the job's report the next version of a destination table, by the
    report's key; counts of inserted, changed and deleted keys."""
    job = JOBS[name]
    if not job.keys:
        raise ValueError(f"the rows of {name} have no key; write a snapshot")
    report = build(name, src, as_of, **params).drop(*job.internal)
    return VersionedTable.at(src.spark, table, job.keys).merge(report, label=None if as_of is None else str(as_of))


def send(name: str, src, outbox_dir: str, as_of=None, size: int = BATCH_ROWS, **params) -> outbox.Sent:
    """Deliver the job's report whole or not at all; the same rows are not sent twice."""
    job = JOBS[name]
    df = build(name, src, as_of, **params)
    order = [F.col(c).asc_nulls_last() for c in job.order if c in df.columns]
    return outbox.send(df, outbox_dir, name, order, size, job.internal)


def run(name: str, src, out_dir: str, as_of=None, size: int = BATCH_ROWS, **params) -> str:
    """Compute the job and write its delivery documents (JSON lines) to a run
    folder of its own below ``out_dir``; returns that folder.

    Earlier runs stay as they are. A failed run writes one document
    ``{started_at, error}`` with the whole error text to ``<run>_error``.
    """
    job = JOBS[name]
    started = _dt.datetime.now(_dt.timezone.utc).isoformat()
    folder = _run_folder(out_dir, started)
    try:
        if job.style == "yard":
            job.report(src, started, **{**job.defaults, **params}).write.text(folder)
            return folder
        df = build(name, src, as_of, **params)
        # columns that only order or cut the delivery are dropped from the rows
        order = [F.col(c).asc_nulls_last() for c in job.order if c in df.columns]
        deliver(df, folder, order, name, started, size, "legacy" if job.style == "legacy" else "runner", job.internal)
        return folder
    except Exception as exc:
        spark = getattr(src, "spark", None)
        if spark is not None:
            (run_log(spark, name, started, f"{type(exc).__name__}: {exc}")
             .select(F.to_json(F.struct("started_at", "error")).alias("json"))
             .coalesce(1).write.text(f"{folder}_error"))
        raise
