"""Purchasing: requisition -> order -> receipt tracker (J05), order payment
(J13 and the legacy per-item rule V1), approvals (J12 and the native
workflow skeleton V4)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetyard.functions import blank_to_null, days_back, strip_zeros, window_bounds
from fleetyard.functions import labels as L
from fleetyard.operators.hot_keys import HotKeys, dealt_join, measure
from fleetyard.operators.joins import code_table, semi_restrict, spread_key, unspread
from fleetyard.operators.keyed import latest_by, text_lookup
from fleetyard.operators.packed import packed, unpacked
from fleetyard.plans.common import dbl, sort_report
from fleetyard.sources.dictionaries import PICKING_LOCATIONS

PO_KEY = ["ebeln", "ebelp"]
RC_KEY = ["banfn", "bnfpo"]


def plants_for(t001l: DataFrame, lgorts=PICKING_LOCATIONS) -> DataFrame:
    """Plants owning one of the storage locations (live map, no plant list in code)."""
    return code_table(t001l.filter(F.col("lgort").isin(list(lgorts))).select("werks").distinct())


def requisitions_in_window(src, as_of, ini: int, fim: int, lgorts=PICKING_LOCATIONS) -> DataFrame:
    """Requisition items dated in the window, with a material, in scope plants."""
    lo, hi = window_bounds(as_of, ini, fim)
    e = src.table("eban").filter((F.col("badat") >= lo) & (F.col("badat") <= hi)
                                 & (strip_zeros("matnr") != ""))
    return semi_restrict(e, plants_for(src.table("t001l"), lgorts), "werks")


def received_qty(ekbe: DataFrame, keys: DataFrame | None, since: str | None) -> DataFrame:
    """Quantity received per order item (goods-receipt history type 1)."""
    x = ekbe.filter(F.col("vgabe") == "1")
    if since is not None:
        x = x.filter(F.col("budat") >= since)
    if keys is not None:
        x = semi_restrict(x, keys, PO_KEY)
    return x.groupBy(*PO_KEY).agg(F.sum("menge").alias("qtd_recebida"))


def order_item_rows(src, since: str) -> DataFrame:
    """What three tables say of order items, a row each: cost centre, quantity received
    since ``since`` or schedule date."""
    text, number = F.lit(None).cast("string"), F.lit(None).cast("decimal(18,3)")

    def row(df, kostl=text, menge=number, eindt=text):
        return df.select(*PO_KEY, kostl.alias("kostl"), menge.alias("menge"), eindt.alias("eindt"))

    got = src.table("ekbe").filter((F.col("vgabe") == "1") & (F.col("budat") >= since))
    rows = (row(src.table("ekkn"), kostl=F.col("kostl"))
            .unionByName(row(got, menge=F.col("menge")))
            .unionByName(row(src.table("eket"), eindt=F.col("eindt"))))
    return rows.dropna(subset=PO_KEY).dropna("all", subset=["kostl", "menge", "eindt"])


def with_order_facts(base: DataFrame, src, since: str) -> DataFrame:
    """``base`` with its order item's greatest cost centre, quantity received since
    ``since`` (NULL without receipts) and first schedule date. ``__po``: the order, or
    for rows without one a key that matches nothing.

    The rows of ``base`` are sorted in among those of the histories, in partitions of
    whole orders, where the order header can be joined too: a join by order and item
    would move all these rows once more.
    """
    own = [c for c in base.columns if c not in ("__po", "ebelp")]
    rows = base.select("__po", "ebelp", F.struct(*own).alias("__own"))
    said = order_item_rows(src, since).withColumnRenamed("ebeln", "__po")
    item = Window.partitionBy("__po", "ebelp")
    facts = rows.unionByName(said, allowMissingColumns=True).repartition("__po").select(
        "__po", "ebelp", "__own", F.max("kostl").over(item).alias("pk_kostl"),
        F.sum("menge").over(item).alias("qtd_recebida"), F.min("eindt").over(item).alias("eindt"))
    return facts.filter(F.col("__own").isNotNull()).select("__po", "ebelp", "__own.*", "pk_kostl", "qtd_recebida", "eindt")


def hot_requested(src, as_of, ini: int = 30, fim: int = 0, lgorts=PICKING_LOCATIONS) -> HotKeys:
    """Popular materials of the requisitions in the window, measured in one pass."""
    return measure(requisitions_in_window(src, as_of, ini, fim, lgorts), F.col("matnr"))


def purchasing_tracker(src, as_of=None, ini: int = 30, fim: int = 0,
                       lgorts=PICKING_LOCATIONS, ordered: bool = False, hot: HotKeys | None = None) -> DataFrame:
    """One row per requisition item x order item in the window.
    ``hot``: materials that hold a large share of the requisitions (``hot_requested``).

    Requisitions and order items are scanned once. The rows are moved once for each
    kind of key (material, requisition item, maintenance order, purchase order), and
    the columns that the last two moves only carry are packed.
    """
    lo, _ = window_bounds(as_of, ini, fim)
    rc = requisitions_in_window(src, as_of, ini, fim, lgorts).select(
        "banfn", "bnfpo", "matnr", "txz01", "menge", "preis", "ekgrp", "ernam", "badat",
        "knttp", "loekz")
    ekpo = src.table("ekpo").select(
        "banfn", "bnfpo", "ebeln", "ebelp", F.col("menge").alias("p_menge"), "netpr", "netwr",
        F.col("knttp").alias("p_knttp"), F.col("loekz").alias("p_loekz"))
    ekko = src.table("ekko").select(
        F.col("ebeln").alias("__po"), F.col("ekgrp").alias("k_ekgrp"),
        F.col("ernam").alias("k_ernam"), "lifnr", "bedat", "frgrl")
    # account row of the requisition: greatest order number, then greatest cost centre
    acc = (src.table("ebkn").groupBy(*RC_KEY)
           .agg(F.max(F.struct("aufnr", "kostl")).alias("a"))
           .select(*RC_KEY, F.col("a.aufnr").alias("acc_aufnr"), F.col("a.kostl").alias("acc_kostl")))
    mtext = text_lookup(src.table("makt"), "matnr", "maktx", lang="spras", langs=["p", "pt"],
                        lang_ci=True, order=[F.lower("spras").asc_nulls_last()])
    afih = src.table("afih").select(F.col("aufnr").alias("__ord"), "equnr")
    lfa1 = src.table("lfa1").select(F.col("lifnr").alias("__vendor"), "name1")

    # material texts join the requisitions, the narrowest rows
    if hot is None:
        rc = rc.join(mtext, "matnr", "left")
    else:
        rc = dealt_join(rc, mtext.withColumnRenamed("matnr", "__mat"), F.col("matnr"), "__mat", hot,
                        F.concat_ws("/", *RC_KEY))
    rc = rc.withColumn("descricao", F.coalesce("maktx", "txz01")).drop("maktx", "txz01")
    base = rc.join(acc, RC_KEY, "left").join(ekpo, RC_KEY, "left")
    # what these three tables decide is decided here: the next joins move fewer columns
    base = base.select(
        "acc_aufnr", "ebeln", "ebelp", "banfn", "bnfpo", strip_zeros("matnr").alias("cod_sap"), "descricao",
        "p_menge", dbl(F.coalesce("p_menge", "menge")).alias("qtd_req"),
        dbl(F.coalesce("netpr", "preis")).alias("vlr_unit"),
        dbl(F.coalesce(F.col("netwr"), F.col("menge") * F.col("preis"))).alias("vlr_total"),
        F.coalesce("p_knttp", "knttp").alias("knttp"), "ekgrp", "ernam", "badat", "acc_kostl",
        L.order_status("ebeln", "p_loekz", "loekz", "banfn").alias("__status"))
    base, own = packed(base, ["acc_aufnr", "ebeln", "ebelp", "banfn"], "__row")
    # rows without an order are common: their missing keys are spread by requisition
    base = (base.withColumn("__ord", spread_key(F.col("acc_aufnr"), F.col("banfn"))).drop("acc_aufnr")
            .join(afih, "__ord", "left")
            .select(spread_key(F.col("ebeln"), F.col("banfn")).alias("__po"), "ebelp", "banfn",
                    unspread("__ord").alias("acc_aufnr"), "equnr", "__row"))
    b = (with_order_facts(base, src, lo).join(ekko, "__po", "left")
         .withColumn("__vendor", spread_key(F.col("lifnr"), F.col("banfn")))
         .join(lfa1, "__vendor", "left")
         .withColumn("ebeln", unspread("__po")))
    b = unpacked(b, "__row", own)

    out = b.select(
        F.coalesce(F.nullif(strip_zeros("equnr"), F.lit("")), F.lit("ESTOQUE")).alias("ativo"),
        F.coalesce(F.nullif(strip_zeros("acc_aufnr"), F.lit("")),
                   F.nullif(F.concat(F.lit("PC-"), strip_zeros(F.coalesce("ebeln", F.lit("")))),
                            F.lit("PC-")),
                   F.concat(F.lit("RC-"), strip_zeros("banfn"))).alias("ordem"),
        "cod_sap", "descricao", "qtd_req",
        F.nullif(strip_zeros(F.coalesce("ebeln", F.lit(""))), F.lit("")).alias("pedido"),
        F.lit(None).cast("string").alias("num_reserva"), F.lit("compra").alias("origem"),
        F.trim(F.coalesce("ebelp", "bnfpo")).alias("num_operacao"),
        F.nullif(strip_zeros("banfn"), F.lit("")).alias("num_rc"),
        F.col("bnfpo").alias("item_rc"),
        F.coalesce("k_ernam", "ekgrp").alias("comprador"),
        F.coalesce(blank_to_null("k_ekgrp"), F.col("ekgrp")).alias("grupo_compras"),
        F.col("ernam").alias("criado_por_sap"), F.col("badat").alias("data_requisicao"),
        F.nullif(strip_zeros(F.coalesce("lifnr", F.lit(""))), F.lit("")).alias("fornecedor_cod"),
        F.col("name1").alias("fornecedor_nome"), F.col("bedat").alias("data_emissao_pc"),
        F.col("eindt").alias("data_remessa_pc"),
        "vlr_unit", "vlr_total",
        F.nullif(F.trim(F.coalesce("knttp", F.lit(""))), F.lit("")).alias("knttp"),
        L.destination("knttp").alias("destinacao"),
        L.consumption_type("knttp").alias("tipo_consumo"),
        F.nullif(strip_zeros(F.coalesce("pk_kostl", "acc_kostl", F.lit(""))), F.lit(""))
         .alias("centro_custo"),
        L.status_with_receipts("qtd_recebida", "p_menge", "frgrl", "__status").alias("status_processo"))
    return sort_report(out, [F.col("num_rc").asc_nulls_last()], ordered)


def invoiced_orders(ekbe: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Orders with an invoice posted (history type 2) and the last posting date."""
    x = ekbe.filter(F.col("vgabe") == "2")
    if orders is not None:
        x = semi_restrict(x, orders.select("ebeln"), "ebeln")
    return x.groupBy("ebeln").agg(F.max("budat").alias("data_pagamento"))


def po_payment(src, as_of=None, ini: int = 90, require_items: bool = False,
               ordered: bool = False) -> DataFrame:
    """Orders dated in the window, invoiced or not, with last invoice date.

    The order item table is only a bridge between header and history, so it
    is left out; orders without items are reported (``require_items`` restores
    the older inner-join behaviour with a semi join)."""
    k = src.table("ekko").filter(F.col("bedat") >= days_back(as_of, ini)) \
        .select("ebeln", "ekgrp", "ernam")
    if require_items:
        k = semi_restrict(k, src.table("ekpo").select("ebeln"), "ebeln")
    f = invoiced_orders(src.table("ekbe")).withColumn("__inv", F.lit(True))
    out = k.join(f, "ebeln", "left").select(
        strip_zeros("ebeln").alias("pedido"), blank_to_null("ekgrp").alias("grupo_compras"),
        F.col("ernam").alias("criado_por_sap"),
        L.payment_status(F.col("__inv").isNotNull()).alias("status_pagamento"),
        "data_pagamento")
    return sort_report(out, [F.col("pedido")], ordered)


def po_payment_by_item(src, groups=None, creators=None) -> DataFrame:
    """V1 legacy rule: orders with at least one item; paid when any item has an
    invoice; one row per zero-stripped order number, "paid" preferred.

    ``groups`` / ``creators`` restore the old buyer filter (None = all orders)."""
    k = src.table("ekko")
    if groups is not None or creators is not None:
        cond = F.lit(False)
        if groups is not None:
            cond = cond | F.col("ekgrp").isin(list(groups))
        if creators is not None:
            cond = cond | F.col("ernam").isin(list(creators))
        k = k.filter(cond)
    # an item counts as invoiced by an invoice of the same item: items and
    # invoices meet in one aggregation per (order, item)
    items = src.table("ekpo").select(*PO_KEY, F.lit(1).alias("__item"), F.lit(None).cast("int").alias("__inv"))
    inv = (src.table("ekbe").filter(F.col("vgabe") == "2")
           .select(*PO_KEY, F.lit(None).cast("int").alias("__item"), F.lit(1).alias("__inv")))
    per_item = (items.unionByName(inv).groupBy(*PO_KEY)
                .agg(F.max("__item").alias("__item"), F.max("__inv").alias("__inv")).filter("__item = 1"))
    per_item = semi_restrict(per_item, k.select("ebeln"), "ebeln")
    per_key = (per_item.withColumn("pedido", strip_zeros("ebeln"))
               .filter(F.col("pedido") != "")
               .groupBy("pedido").agg(F.max("__inv").alias("__inv")))
    return per_key.select("pedido", L.payment_status(F.col("__inv").isNotNull()).alias("status_pagamento"))


def po_approvals(src, as_of=None, ini: int | None = None) -> DataFrame:
    """One row per (order, approver, start date, start time): the open or
    latest-ending approval (NULL end time first)."""
    a = src.table("bi_bs_fluxo_aprov")
    if ini is not None:
        a = a.filter(F.col("DataInicio") >= days_back(as_of, ini))
    keys = ["NumeroPedido", "NomeAprovador", "DataInicio", "HorarioInicioAprovacao"]
    last = latest_by(a, keys, [F.col("HorarioFinalAprovacao").desc_nulls_first(),
                               F.col("StatusFluxoAprovacao").asc_nulls_last(),
                               F.col("DataFinal").asc_nulls_last()])
    return last.select(
        F.col("NumeroPedido").alias("pedido"), F.col("NomeAprovador").alias("aprovador"),
        F.col("DataInicio").alias("data_inicio"), F.col("HorarioInicioAprovacao").alias("hora_inicio"),
        F.col("HorarioFinalAprovacao").alias("hora_fim"),
        L.approval_label("StatusFluxoAprovacao").alias("status_aprovacao"),
        F.col("StatusFluxoAprovacao").alias("status_raw"), F.col("DataFinal").alias("data_final"))


def po_approvals_workflow(src, as_of=None, ini: int = 3650) -> DataFrame:
    """V4 (unvalidated skeleton in the source): approvals read from the native
    workflow work items of purchase orders, with the approver's name."""
    w = src.table("swwwihead").filter((F.col("wi_type") == "W")
                                      & (F.col("wi_cd") >= days_back(as_of, ini)))
    o = src.table("sww_wi2obj").filter((F.col("catid") == "BO") & (F.col("typeid") == "BUS2012")) \
        .select("wi_id", "instid")
    usr21, adrp = src.table("usr21"), src.table("adrp")
    # the names of the users first: a master table, so few agents holding most
    # work items do not gather them in few tasks
    people = code_table(
        usr21.select(F.trim("bname").alias("__agent"), F.trim("persnumber").alias("__pers"))
        .join(adrp.select(F.trim("persnumber").alias("__pers"), "name_text"), "__pers", "left").drop("__pers"),
        inputs=[usr21, adrp])
    j = (w.join(o, "wi_id")
         .withColumn("__agent", spread_key(F.trim("wi_aagent"), F.col("wi_id")))
         .join(people, "__agent", "left"))
    return j.select(
        strip_zeros("instid").alias("pedido"),
        F.coalesce("name_text", "wi_aagent").alias("aprovador"),
        F.col("wi_cd").alias("data_inicio"), F.col("wi_ct").alias("hora_inicio"),
        F.col("wi_aed").alias("hora_fim"), L.approval_label("wi_stat").alias("status_aprovacao"),
        F.col("wi_stat").alias("status_raw"), F.col("wi_aed").alias("data_final"))
