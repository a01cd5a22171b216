"""Oracle SQL for reads in parts, sliced runs, deliveries, versions and keyed differences."""
from __future__ import annotations

from duck_oracle.adapters import with_tables
from duck_oracle.blocks import bare, has
from duck_oracle.reports import (day_slices, equipment_register, parts_history, po_payment, po_payment_by_item, purchasing_tracker,
                                 receipts_status, reservation_picking, work_order_operations, yard_current)
from fleetyard.plans.params import PAYMENT_GROUPS, WIDE_SLICE_DAYS


def key_range_depths() -> str:
    """A row's part: how many cut rows come before it or are equal; rows without a first key column are apart."""
    return with_tables(["afih"], """
keyed AS (SELECT gewrk, aufnr, row_number() OVER (ORDER BY gewrk, aufnr NULLS FIRST) - 1 AS nth, count(*) OVER () AS n
  FROM afih WHERE gewrk IS NOT NULL),
cut AS (SELECT DISTINCT gewrk, aufnr FROM keyed WHERE nth IN (SELECT n * i // 12 FROM range(1, 12) AS r(i))),
placed AS (SELECT gewrk, (SELECT count(*) FROM cut WHERE (cut.gewrk, cut.aufnr) <= (afih.gewrk, afih.aufnr)) AS part
  FROM afih WHERE gewrk IS NOT NULL
  UNION ALL SELECT NULL, (SELECT count(*) + 1 FROM cut) FROM afih WHERE gewrk IS NULL)
SELECT part::INT AS part, count(*) AS rows, min(gewrk) AS low, max(gewrk) AS high FROM placed GROUP BY 1""")


def sliced_run() -> str:
    return day_slices(days=WIDE_SLICE_DAYS)


def outbox_batches() -> str:
    return f"""WITH pay AS ({po_payment()}),
placed AS (SELECT pedido, (row_number() OVER (ORDER BY pedido) - 1) // 2000 + 1 AS batch, count(*) OVER () AS total_rows FROM pay)
SELECT batch, (any_value(total_rows) + 1999) // 2000 AS total_batches, count(*) AS row_count, any_value(total_rows) AS total_rows,
  count(*) AS rows_there, min(pedido) AS first_key, max(pedido) AS last_key FROM placed GROUP BY batch"""


def _states() -> str:
    return f"""WITH first_state AS ({po_payment_by_item(PAYMENT_GROUPS)}), old AS ({po_payment_by_item()}),
new AS (SELECT pedido, status_pagamento FROM ({po_payment()}) p)"""


def payment_versions() -> str:
    return f"""{_states()}
SELECT *, 1 AS version FROM first_state UNION ALL SELECT *, 2 FROM old UNION ALL SELECT *, 3 FROM new"""


def payment_changes() -> str:
    def step(version: int, before: str, after: str) -> str:
        both = f"FROM {before} b JOIN {after} a USING (pedido) WHERE a.status_pagamento IS DISTINCT FROM b.status_pagamento"
        return f"""SELECT {version}::BIGINT AS version, 'insert' AS op, (SELECT count(*) FROM {after} ANTI JOIN {before} USING (pedido)) AS n
UNION ALL SELECT {version}, 'delete', (SELECT count(*) FROM {before} ANTI JOIN {after} USING (pedido))
UNION ALL SELECT {version}, 'update', (SELECT count(*) {both})"""

    return f"""{_states()}, nothing AS (SELECT * FROM new WHERE false)
{step(1, "nothing", "new")} UNION ALL {step(2, "new", "old")} UNION ALL {step(3, "old", "first_state")}"""


def _compared() -> str:
    return f"""{_states()}, seen AS (
  SELECT pedido, old.status_pagamento AS old_status, new.status_pagamento AS new_status,
    CASE WHEN old.pedido IS NULL THEN 'insert' WHEN new.pedido IS NULL THEN 'delete'
      WHEN old_status IS DISTINCT FROM new_status THEN 'update' ELSE 'same' END AS op
  FROM old FULL JOIN new USING (pedido))"""


def dq_payment_changes() -> str:
    return f"""{_compared()}
SELECT pedido, op, CASE op WHEN 'update' THEN 'status_pagamento' ELSE '' END AS changed, old_status, new_status
FROM seen WHERE op != 'same'"""


def dq_payment_change_counts() -> str:
    return f"""{_compared()}
SELECT what, (SELECT count(*) FROM seen WHERE op = what) AS n FROM (VALUES ('insert'), ('delete'), ('update'), ('same'), ('repeated')) v(what)
UNION ALL SELECT 'column status_pagamento', (SELECT count(*) FROM seen WHERE op = 'update')"""


def _placed(rows: str, order: str, shown: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY {order}) - 1 AS place, {shown} FROM ({rows}) r"


def receipts_ordered() -> str:
    return _placed(receipts_status(), "status_migo, data_do_recebimento_fisico DESC NULLS LAST, pedido NULLS LAST, requisicao NULLS LAST",
                   "status_migo, data_do_recebimento_fisico, pedido, requisicao")


def equipment_ordered() -> str:
    return _placed(equipment_register(), "ativo NULLS LAST, descricao NULLS LAST, chassi NULLS LAST", "ativo, descricao, chassi")


def operations_ordered() -> str:
    shown = "filial, ativo, ordem, num_operacao, centro_trabalho_operacao, status_operacao"
    return _placed(work_order_operations(), ", ".join(f"{c} NULLS LAST" for c in shown.split(", ")), shown)


def latest_orders_maintained() -> str:
    return with_tables(["aufk", "afih"], f"""
there AS (SELECT {bare("equnr")} AS ativo, aufnr, erdat FROM aufk JOIN afih USING (aufnr)
  WHERE {has("equnr")} AND aufnr::BIGINT % 11 != 0)
SELECT ativo, max((erdat, aufnr))[2] AS aufnr, max((erdat, aufnr))[1] AS erdat FROM there GROUP BY ativo""")


PROFILED = ("aufnr", "erdat", "idat2", "loekz", "ernam", "auart")


def dq_profile() -> str:
    return with_tables(["aufk"], " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) FILTER ({c} IS NULL) AS nulls,
  count(*) FILTER (trim({c}) = '') AS blanks, count(DISTINCT {c}) AS "distinct" FROM aufk""" for c in PROFILED)).replace(
        "SELECT 'aufnr'", "\nSELECT 'aufnr'", 1)


def dq_profile_sketched() -> str:
    return f"""SELECT "column", rows, nulls, blanks, true AS within FROM ({dq_profile()}) p"""


SQL = {
    "parts_history_merged": parts_history, "yard_polled": yard_current,
    "reservation_picking_dealt": reservation_picking, "parts_history_dealt": parts_history,
    "purchasing_tracker_dealt": purchasing_tracker,
    **{f.__name__: f for f in (receipts_ordered, equipment_ordered, operations_ordered, latest_orders_maintained, dq_profile, dq_profile_sketched, key_range_depths, sliced_run, outbox_batches, payment_versions, payment_changes,
                               dq_payment_changes, dq_payment_change_counts)}}
