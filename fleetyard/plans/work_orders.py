"""Maintenance orders: latest order per asset and type (J01), its operations
(J02) and the supplies it needs (J04).

Every report first reduces the order history to the winners (latest order
per asset x maintenance type) and only then fans out to statuses, operations
and items, so the expensive joins scale with the fleet, not with history.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetyard.functions import is_code_in, norm_id, not_blank, strip_zeros
from fleetyard.functions import labels as L
from fleetyard.operators.joins import code_table, spread_key
from fleetyard.operators.keyed import latest_by, priority_dedupe, rank_when, text_lookup
from fleetyard.operators.status import (active_system_statuses, active_user_statuses,
                                        with_statuses)
from fleetyard.plans.common import (ORDERS_SINCE, activity_texts, dbl, priority_texts,
                                    sort_report, work_centres, zero_strip)


def _newest():
    return [F.col("erdat").desc_nulls_first(), F.col("aufnr").desc_nulls_first()]


def _orders(src, since: str, codes: tuple[str, ...] | None = None) -> DataFrame:
    """aufk x afih (+ work centre, left: an order without centre stays) created
    from ``since`` on (text compare, pushed to the scan), equipment not blank."""
    a = src.table("aufk").filter(F.col("erdat") >= since)
    h = src.table("afih").filter(not_blank("equnr"))
    if codes:
        h = h.filter(F.col("ilart").isin(list(codes)))
    ct = work_centres(src.table("crhd"))
    o = a.join(h, "aufnr")
    o = o.join(ct, o["gewrk"] == ct["objid"], "left").drop("objid")
    return o.withColumn("ativo", norm_id("equnr"))


def latest_orders(src, since: str = ORDERS_SINCE) -> DataFrame:
    """J01 winners: type by code or activity text; other types dropped before ranking."""
    o = _orders(src, since)
    o = o.join(activity_texts(src.table("t353i_t")), "ilart", "left")
    o = o.withColumn("tipo_manutencao", L.maintenance_type("ilart", "ilatx"))
    o = o.filter(F.col("tipo_manutencao").isin(L.WORKSHOP, L.PREPARATION))
    return latest_by(o, ["ativo", "tipo_manutencao"], _newest())


def latest_orders_by_code(src, since: str = ORDERS_SINCE) -> DataFrame:
    """J02/J04 winners: type by activity code only, restricted to PRP/OFI first."""
    o = _orders(src, since, codes=("PRP", "OFI"))
    o = o.withColumn("tipo_manutencao", L.maintenance_type_by_code("ilart"))
    return latest_by(o, ["ativo", "tipo_manutencao"], _newest())


def work_orders_latest(src, since: str = ORDERS_SINCE, ordered: bool = False) -> DataFrame:
    """Latest order per asset x type with phase, priority text and user status."""
    w = latest_orders(src, since).join(priority_texts(src.table("t356_t")), "priok", "left")
    # the statuses join the winners themselves and are rolled up next to them:
    # the ranking, and the scans below it, run once
    shown = ["ativo", "tipo_manutencao", "filial", "arbpl", "aufnr", "ilatx", "priokx", "priok",
             "idat1", "idat2", "idat3", "erdat"]
    active = active_user_statuses(src.table("jsto"), src.table("jest"), src.table("tj30t"))
    out = with_statuses(w, shown, "objnr", active, "status_usuario")
    out = out.select(
        "ativo", "filial", F.col("arbpl").alias("centro_trabalho"),
        zero_strip("aufnr").alias("ordem"), "tipo_manutencao",
        F.col("ilatx").alias("tipo_atividade"),
        F.coalesce("priokx", "priok").alias("criticidade"),
        L.order_phase("idat1", "idat2", "idat3").alias("fase_os"),
        "status_usuario", F.col("erdat").alias("data_criacao"))
    return sort_report(out, [F.col("filial").asc_nulls_last(), F.col("ativo").asc_nulls_last(),
                             F.col("tipo_manutencao")], ordered)


def work_order_operations(src, since: str = ORDERS_SINCE, ordered: bool = False) -> DataFrame:
    """Operations of the winning orders with planned dates, hours and step status.

    Inner joins: a winner without planning data or operations has no row."""
    w = latest_orders_by_code(src, since)
    plan = src.table("afko").select("aufnr", "gstrp", "gltrp", "aufpl")
    ops = src.table("afvc").select("aufpl", "aplzl", "vornr", "ltxa1", "arbid",
                                   F.col("objnr").alias("op_objnr"))
    hours = src.table("afvv").select("aufpl", "aplzl", "arbei")
    op_ct = code_table(src.table("crhd").filter(is_code_in("objty", ["A", ""]))
                       .select(F.col("objid").alias("arbid"), F.col("arbpl").alias("op_arbpl")))
    base = (w.select("aufnr", "ativo", "filial", "tipo_manutencao", "ktext", "arbpl", "idat1",
                     "ernam")
            .join(plan, "aufnr")
            .join(ops, "aufpl")
            .join(hours, ["aufpl", "aplzl"], "left")
            .join(op_ct, "arbid", "left"))
    # an operation is (aufpl, aplzl): its statuses join the operations themselves
    shown = ["aufnr", "aufpl", "aplzl", "ativo", "filial", "tipo_manutencao", "ktext", "arbpl", "gstrp", "gltrp",
             "idat1", "ernam", "vornr", "ltxa1", "op_arbpl", "arbei"]
    active = active_system_statuses(src.table("jest"), src.table("tj02t"))
    out = with_statuses(base, shown, "op_objnr", active, "status_operacao").select(
        "ativo", "filial", zero_strip("aufnr").alias("ordem"), "tipo_manutencao",
        F.col("ktext").alias("descricao_os"), F.col("arbpl").alias("centro_trabalho_responsavel"),
        F.col("gstrp").alias("data_inicio_programada"), F.col("gltrp").alias("data_fim_programada"),
        F.col("idat1").alias("data_liberacao"), F.col("ernam").alias("autor_os"),
        F.col("vornr").alias("num_operacao"), F.col("ltxa1").alias("descricao_operacao"),
        F.col("op_arbpl").alias("centro_trabalho_operacao"),
        dbl("arbei").alias("tempo_previsto_h"), "status_operacao")
    return sort_report(out, [F.col("filial").asc_nulls_last(), F.col("ativo").asc_nulls_last(),
                             F.col("ordem"), F.col("num_operacao")], ordered)


def order_items(src, since: str = ORDERS_SINCE) -> DataFrame:
    """J04 raw items of the winning orders: purchase requisitions assigned to
    the order UNION ALL its reservations (duplicates kept), blank material dropped."""
    w = (latest_orders_by_code(src, since)
         .select("ativo", "filial", F.col("aufnr").alias("ordem_sap"),
                 zero_strip("aufnr").alias("ordem")))
    ebkn = src.table("ebkn").select("banfn", "bnfpo", F.col("aufnr").alias("ordem_sap"))
    eban = src.table("eban").select("banfn", "bnfpo", "matnr", "txz01", "menge", "knttp")
    ekpo = src.table("ekpo").select(F.col("banfn").alias("q_banfn"), F.col("bnfpo").alias("q_bnfpo"), "ebeln")
    purchases = (w.join(ebkn, "ordem_sap").join(eban, ["banfn", "bnfpo"])
                 .select("ativo", "filial", "ordem", strip_zeros("matnr").alias("cod_sap"),
                         F.col("txz01").alias("desc_compra_direta"), F.col("menge").alias("qtd_req"),
                         F.lit(None).cast("string").alias("num_reserva"),
                         F.lit("compra").alias("origem"), "knttp",
                         F.col("banfn").alias("q_banfn"), F.col("bnfpo").alias("q_bnfpo")))
    resb = (src.table("resb").filter(~F.col("xloek").eqNullSafe("X"))
            .select(F.col("aufnr").alias("ordem_sap"), "rsnum", "matnr", "bdmng", "postp",
                    # many reservations have no requisition: each missing key gets a
                    # stand-in of its own row before it is joined on
                    spread_key(F.col("banfn"), F.concat_ws("/", "rsnum", "rspos")).alias("r_banfn"),
                    F.col("bnfpo").alias("r_bnfpo")))
    eban_r = eban.select(F.col("banfn").alias("r_banfn"), F.col("bnfpo").alias("r_bnfpo"),
                         F.col("banfn").alias("e_banfn"), F.col("bnfpo").alias("e_bnfpo"), "knttp")
    by_order = F.col("postp") == "N"
    reservations = (w.join(resb, "ordem_sap").join(eban_r, ["r_banfn", "r_bnfpo"], "left")
                    .select("ativo", "filial", "ordem", strip_zeros("matnr").alias("cod_sap"),
                            F.lit(None).cast("string").alias("desc_compra_direta"),
                            F.col("bdmng").alias("qtd_req"), F.when(by_order, F.lit(None).cast("string"))
                            .otherwise(strip_zeros("rsnum")).alias("num_reserva"),
                            F.when(by_order, F.lit("compra")).otherwise(F.lit("reserva"))
                            .alias("origem"), "knttp",
                            # where the requisition is unknown, the reservation's own (spread) key
                            # still parts the rows; it matches no order item
                            F.coalesce("e_banfn", F.concat(F.lit("\u0001"), "r_banfn")).alias("q_banfn"),
                            F.coalesce("e_bnfpo", F.lit("")).alias("q_bnfpo")))
    items = purchases.unionByName(reservations)
    items = items.filter(F.col("cod_sap").isNotNull() & (F.col("cod_sap") != ""))
    # one join with the order items for both branches
    return items.join(ekpo, ["q_banfn", "q_bnfpo"], "left").select(
        "ativo", "filial", "ordem", "cod_sap", "desc_compra_direta", "qtd_req",
        strip_zeros("ebeln").alias("pedido"), "num_reserva", "origem", "knttp")


def dedupe_items(items: DataFrame) -> DataFrame:
    """One item per (order, material): purchase first, then with PO, then with
    reservation number; remaining columns complete the order."""
    return priority_dedupe(
        items, ["ordem", "cod_sap"],
        [rank_when(F.col("origem") == "compra"), rank_when(F.col("pedido").isNotNull()),
         rank_when(F.col("num_reserva").isNotNull())],
        tiebreak=[F.col("pedido").asc_nulls_last(), F.col("num_reserva").asc_nulls_last(),
                  F.col("qtd_req").desc_nulls_last(), F.col("knttp").asc_nulls_last(),
                  F.col("desc_compra_direta").asc_nulls_last()])


def order_supplies(src, since: str = ORDERS_SINCE, ordered: bool = False) -> DataFrame:
    """Items needed by the winning orders, de-duplicated by priority."""
    items = order_items(src, since)
    texts = text_lookup(src.table("makt"), strip_zeros("matnr"), "maktx", lang="spras",
                        langs=["p", "pt"], lang_ci=True, order=[F.col("spras").asc_nulls_last()],
                        key_name="cod_sap")
    out = dedupe_items(items).join(texts, "cod_sap", "left").select(
        "ativo", "filial", "ordem", "cod_sap",
        F.coalesce("maktx", "desc_compra_direta", F.lit("Sem Descrição")).alias("descricao"),
        dbl("qtd_req").alias("qtd_req"), "num_reserva", "pedido", "origem",
        F.nullif(F.trim(F.coalesce("knttp", F.lit(""))), F.lit("")).alias("knttp"),
        L.destination("knttp").alias("destinacao"))
    return sort_report(out, [F.col("ativo").asc_nulls_last(), F.col("ordem")], ordered)
