"""Business label waterfalls (ordered CASE expressions; first match wins)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source system's labels and codes.
PREPARATION = "Preparação"
WORKSHOP = "Oficina"
OTHER = "Outro"
PHASES = ("3 - Encerrada Comercial", "2 - Concluída Tecnicamente", "1 - Liberada",
          "0 - Criada / Aberta")
PURCHASE_STATUS = ("recebido", "entrega_parcial", "aguardando_aprovacao", "pedido_emitido",
                   "pedido_cancelado", "rc_excluida", "aguardando_pedido", "verificar")
CONSUMPTION_TYPES = {"K": "Centro de Custo", "A": "Ativo Fixo (Imobilizado)",
                     "F": "Ordem (Manutencao/Interna)", "P": "Projeto (PEP)",
                     "Q": "Projeto (PEP)", "N": "Rede", "": "Estoque"}
CONSUMPTION_OTHER = "Outro"
MOVEMENTS = {"201": "Reserva Manual", "261": "Ordem"}
APPROVAL_LABELS = {"STARTED": "1. Iniciado/Aguardando", "READY": "2. Pronto para Aprovacao",
                   "COMPLETED": "3. Aprovado", "CANCELLED": "0. Cancelado/Reprovado"}
PAID = "Pago / Fatura Lançada (MIRO)"
NOT_PAID = "Não Lançado"
RECEIPT_DONE = "MIGO FEITA"
RECEIPT_PENDING = "MIGO PENDENTE"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def maintenance_type(ilart, activity_text) -> Column:
    """Type by code or by activity text (``prep`` / ``ofi`` anywhere, case-insensitive)."""
    txt = F.lower(F.coalesce(_c(activity_text), F.lit("")))
    return (F.when((_c(ilart) == "PRP") | (F.instr(txt, "prep") > 0), F.lit(PREPARATION))
            .when((_c(ilart) == "OFI") | (F.instr(txt, "ofi") > 0), F.lit(WORKSHOP))
            .otherwise(F.lit(OTHER)))


def maintenance_type_by_code(ilart, other=OTHER) -> Column:
    """Type by activity code only; ``other=None`` leaves other codes NULL."""
    c = (F.when(_c(ilart) == "PRP", F.lit(PREPARATION))
         .when(_c(ilart) == "OFI", F.lit(WORKSHOP)))
    return c.otherwise(F.lit(other)) if other is not None else c


def order_phase(idat1, idat2, idat3) -> Column:
    """Phase from the latest milestone date present (tested by IS NOT NULL only)."""
    return (F.when(_c(idat3).isNotNull(), F.lit(PHASES[0]))
            .when(_c(idat2).isNotNull(), F.lit(PHASES[1]))
            .when(_c(idat1).isNotNull(), F.lit(PHASES[2]))
            .otherwise(F.lit(PHASES[3])))


def destination(knttp) -> Column:
    """Account assignment blank -> stock, K -> cost centre, else consumption."""
    k = F.trim(_c(knttp))
    return (F.when(F.coalesce(k, F.lit("")) == "", F.lit("estoque"))
            .when(k == "K", F.lit("centro_custo"))
            .otherwise(F.lit("consumo")))


def consumption_type(knttp) -> Column:
    """Label of the account-assignment category; blank is stock, unknown is other."""
    k = F.trim(F.coalesce(_c(knttp), F.lit("")))
    out = None
    for code, label in CONSUMPTION_TYPES.items():
        out = (F.when(k == code, F.lit(label)) if out is None
               else out.when(k == code, F.lit(label)))
    return out.otherwise(F.lit(CONSUMPTION_OTHER))


def order_status(po_number, po_deletion, rc_deletion, rc_number) -> Column:
    """Requisition -> order part of the status waterfall: what holds while nothing is
    received and no release is awaited."""
    return (F.when(_c(po_number).isNotNull()
                   & (F.coalesce(F.trim(_c(po_deletion)), F.lit("")) != "L"),
                   F.lit(PURCHASE_STATUS[3]))
            .when(F.trim(F.coalesce(_c(po_deletion), F.lit(""))) == "L", F.lit(PURCHASE_STATUS[4]))
            .when(F.trim(F.coalesce(_c(rc_deletion), F.lit(""))) == "X", F.lit(PURCHASE_STATUS[5]))
            .when(_c(rc_number).isNotNull()
                  & (F.coalesce(F.trim(_c(po_number)), F.lit("")) == ""),
                  F.lit(PURCHASE_STATUS[6]))
            .otherwise(F.lit(PURCHASE_STATUS[7])))


def status_with_receipts(received, po_qty, release_flag, ordered) -> Column:
    """Status by receipts and release, else ``ordered`` (:func:`order_status`)."""
    rec = F.coalesce(_c(received), F.lit(0))
    return (F.when((rec >= _c(po_qty)) & (_c(po_qty) > 0), F.lit(PURCHASE_STATUS[0]))
            .when(rec > 0, F.lit(PURCHASE_STATUS[1]))
            .when(_c(release_flag) == "X", F.lit(PURCHASE_STATUS[2]))
            .otherwise(_c(ordered)))


def purchase_status(received, po_qty, release_flag, po_number, po_deletion, rc_deletion,
                    rc_number) -> Column:
    """Requisition -> order -> receipt status waterfall."""
    return status_with_receipts(received, po_qty, release_flag,
                                order_status(po_number, po_deletion, rc_deletion, rc_number))


def movement_label(bwart) -> Column:
    c = _c(bwart)
    return (F.when(c == "201", F.lit(MOVEMENTS["201"]))
            .when(c == "261", F.lit(MOVEMENTS["261"]))
            .otherwise(F.lit("")))


def approval_label(status) -> Column:
    c = _c(status)
    out = None
    for code, label in APPROVAL_LABELS.items():
        out = F.when(c == code, F.lit(label)) if out is None else out.when(c == code, F.lit(label))
    return out.otherwise(c)


def payment_status(invoiced) -> Column:
    return F.when(_c(invoiced), F.lit(PAID)).otherwise(F.lit(NOT_PAID))


def receipt_status(received_at) -> Column:
    return F.when(_c(received_at).isNotNull(), F.lit(RECEIPT_DONE)).otherwise(F.lit(RECEIPT_PENDING))
