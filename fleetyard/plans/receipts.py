"""Goods-receipt evidence from the receipts application."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetyard.functions import labels as L
from fleetyard.operators.joins import spread_key
from fleetyard.operators.keyed import latest_by
from fleetyard.plans.common import sort_report, zero_strip


def _evidence(src) -> DataFrame:
    er = src.table("evidencia_recebimentos")
    rc = src.table("requisicoes_de_compra").select(
        F.col("id").cast("string").alias("__rc"), "numero_pedido_gerado")
    # evidence without a requisition is spread over all tasks
    key = spread_key(F.col("requisicao_de_compra_id").cast("string"), F.col("id"))
    return er.withColumn("__rc", key).join(rc, "__rc", "left")


def _requisition(e: DataFrame):
    return zero_strip(F.coalesce(F.nullif("requisicao_de_compra_os", F.lit("")),
                                 F.col("numero_pedido_gerado"), F.lit("")))


def receipts_status(src, ordered: bool = False) -> DataFrame:
    """Receipt status per evidence row (done when a receipt date exists)."""
    e = _evidence(src)
    out = e.select(
        "pedido", F.nullif(_requisition(e), F.lit("")).alias("requisicao"),
        F.col("data_recebimento").alias("data_do_recebimento_fisico"),
        L.receipt_status("data_recebimento").alias("status_migo"))
    return sort_report(out, [F.col("status_migo"),
                             F.col("data_do_recebimento_fisico").desc_nulls_last()], ordered)


def receipts_by_order(src) -> DataFrame:
    """V2: one row per trimmed order number: a finished receipt first, newest date."""
    e = _evidence(src).filter(F.trim(F.coalesce("pedido", F.lit(""))) != "")
    e = e.select("id", "pedido", _requisition(e).alias("requisicao"),
                 F.col("data_recebimento").alias("data_do_recebimento_fisico"),
                 L.receipt_status("data_recebimento").alias("status_migo"))
    first = latest_by(e, F.trim("pedido"),
                      [F.col("status_migo").asc(), F.col("data_do_recebimento_fisico").desc_nulls_last(),
                       F.col("id").desc()])
    return first.select("pedido", "requisicao", "data_do_recebimento_fisico", "status_migo")
