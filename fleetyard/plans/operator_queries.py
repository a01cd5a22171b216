"""Each reusable operator applied on its own to whole tables (one checked
query per operator), plus the data-quality checks bound to the reports."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetyard.functions import blank_to_null, norm_id, not_blank, strip_zeros, window_bounds
from fleetyard.functions import labels as L
from fleetyard.operators.joins import semi_restrict
from fleetyard.operators.keyed import latest_by, latest_then, text_lookup
from fleetyard.operators.status import active_system_statuses, user_status, with_statuses
from fleetyard.plans import equipment, parts, purchasing, quality, reservations, work_orders
from fleetyard.plans.common import ORDERS_SINCE, activity_texts, dbl, work_centres
from fleetyard.plans.params import AS_OF, CUT_WINDOW, FULL_WINDOW
from fleetyard.sources.dictionaries import PICKING_LOCATIONS


def latest_by_key(src) -> DataFrame:
    """Latest maintenance order per equipment (any type)."""
    o = src.table("aufk").select("aufnr", "erdat").join(
        src.table("afih").filter(not_blank("equnr")).select("aufnr", "equnr"), "aufnr")
    last = latest_by(o.withColumn("ativo", norm_id("equnr")), "ativo",
                     [F.col("erdat").desc_nulls_first(), F.col("aufnr").desc_nulls_first()])
    return last.select("ativo", strip_zeros("aufnr").alias("ordem"),
                       F.col("erdat").alias("data_criacao"))


def latest_then_filter(src) -> DataFrame:
    """Reservation keys whose latest approval log entry is a rejection."""
    z = src.table("ztwf_log_wf").withColumn("chave_reserva", F.trim("chave"))
    last = latest_then(z, "chave_reserva",
                       [F.col("data").desc_nulls_last(), F.col("hora").desc_nulls_last(),
                        F.col("acao").asc_nulls_last()],
                       F.trim("acao") == "REPROVADO")
    return last.select("chave_reserva", blank_to_null("data").alias("data"),
                       blank_to_null("hora").alias("hora"))


def material_texts(src) -> DataFrame:
    """Material text in Portuguese per zero-stripped material number."""
    return text_lookup(src.table("makt"), strip_zeros("matnr"), "maktx", lang="spras",
                       langs=["p", "pt"], lang_ci=True, order=[F.col("spras").asc_nulls_last()],
                       key_name="material")


def work_centre_branch(src) -> DataFrame:
    """Branch of every order's work centre (NULL when the centre is unknown)."""
    ct = work_centres(src.table("crhd"))
    h = src.table("afih").select("aufnr", "gewrk")
    return h.join(ct, h["gewrk"] == ct["objid"], "left").select("aufnr", "gewrk", "arbpl", "filial")


def norm_ids(src) -> DataFrame:
    """Equipment numbers of orders: zero-stripped, blank-to-NULL and both."""
    h = src.table("afih")
    return h.select("aufnr", strip_zeros("equnr").alias("sem_zeros"),
                    blank_to_null("equnr").alias("sem_branco"), norm_id("equnr").alias("ativo"))


def maintenance_type(src) -> DataFrame:
    """Maintenance type of every order, by code+text and by code only."""
    h = src.table("afih").select("aufnr", "ilart").join(
        activity_texts(src.table("t353i_t")), "ilart", "left")
    return h.select("aufnr", "ilart", F.col("ilatx").alias("tipo_atividade"),
                    L.maintenance_type("ilart", "ilatx").alias("tipo_manutencao"),
                    L.maintenance_type_by_code("ilart", other=None).alias("tipo_por_codigo"))


def order_phase(src) -> DataFrame:
    a = src.table("aufk")
    return a.select("aufnr", L.order_phase("idat1", "idat2", "idat3").alias("fase_os"))


def status_rollup(src) -> DataFrame:
    """User status codes and texts of every order."""
    a = src.table("aufk").select("aufnr", "objnr")
    return user_status(a, "aufnr", "objnr", src.table("jsto"), src.table("jest"),
                       src.table("tj30t"), with_codes=True)


def operation_statuses(src) -> DataFrame:
    """Every operation with its hours and system statuses; repeated hours repeat the row."""
    rows = (src.table("afvc").select("aufpl", "aplzl", "vornr", "objnr")
            .join(src.table("afvv").select("aufpl", "aplzl", "arbei"), ["aufpl", "aplzl"], "left"))
    active = active_system_statuses(src.table("jest"), src.table("tj02t"))
    out = with_statuses(rows, ["aufpl", "aplzl", "vornr", "arbei"], "objnr", active, "status_operacao")
    return out.select("aufpl", "aplzl", "vornr", dbl("arbei").alias("arbei"), "status_operacao")


def semi_restrict_query(src) -> DataFrame:
    """Reservation items of orders created since the cut-off (semi join, no fan-out)."""
    orders = src.table("aufk").filter(F.col("erdat") >= ORDERS_SINCE).select("aufnr")
    return semi_restrict(src.table("resb"), orders, "aufnr").select("rsnum", "rspos", "aufnr")


def plant_scope(src) -> DataFrame:
    """Requisition items in plants owning a picking storage location."""
    e = semi_restrict(src.table("eban"), purchasing.plants_for(src.table("t001l")), "werks")
    return e.select("banfn", "bnfpo", "werks")


def active_equipment(src) -> DataFrame:
    return equipment.active_equipment(src).select("equnr", "objnr")


def received_qty(src) -> DataFrame:
    return dbl_cols(purchasing.received_qty(src.table("ekbe"), None, None), "qtd_recebida")


def dbl_cols(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def purchase_status(src) -> DataFrame:
    """Status waterfall for every requisition item (no window, no plant scope)."""
    e = src.table("eban").select("banfn", "bnfpo", "loekz")
    p = src.table("ekpo").select("banfn", "bnfpo", "ebeln", "ebelp", F.col("menge").alias("p_menge"),
                                 F.col("loekz").alias("p_loekz"))
    k = src.table("ekko").select("ebeln", "frgrl")
    rec = purchasing.received_qty(src.table("ekbe"), None, None)
    j = e.join(p, ["banfn", "bnfpo"], "left").join(k, "ebeln", "left") \
        .join(rec, ["ebeln", "ebelp"], "left")
    return j.select("banfn", "bnfpo", "ebeln", "ebelp",
                    L.purchase_status("qtd_recebida", "p_menge", "frgrl", "ebeln", "p_loekz",
                                      "loekz", "banfn").alias("status_processo"))


def account_assignment(src) -> DataFrame:
    """Account assignment of every requisition item (the order item's code wins,
    an empty code on the order item included)."""
    e = src.table("eban").select("banfn", "bnfpo", "knttp")
    p = src.table("ekpo").select("banfn", "bnfpo", F.col("knttp").alias("p_knttp"))
    kn = F.coalesce("p_knttp", "knttp")
    return e.join(p, ["banfn", "bnfpo"], "left").select(
        "banfn", "bnfpo", F.nullif(F.trim(F.coalesce(kn, F.lit(""))), F.lit("")).alias("knttp"),
        L.destination(kn).alias("destinacao"), L.consumption_type(kn).alias("tipo_consumo"))


def invoice_flag(src) -> DataFrame:
    """Invoice status and last invoice date of every order."""
    k = src.table("ekko").select("ebeln")
    f = purchasing.invoiced_orders(src.table("ekbe")).withColumn("__inv", F.lit(True))
    return k.join(f, "ebeln", "left").select(
        "ebeln", L.payment_status(F.col("__inv").isNotNull()).alias("status_pagamento"),
        "data_pagamento")


def parts_consumption(src) -> DataFrame:
    """Consumption aggregate over every order (full window)."""
    agg = parts.parts_agg(parts.consumption(src, AS_OF, FULL_WINDOW, 0))
    return agg.select("equnr", "matnr", "qtd_ocorrencias", dbl("qtd_total").alias("qtd_total"),
                      "ultima_data", F.col("__last.aufnr").alias("ultima_ordem"))


def window_filter(src) -> DataFrame:
    """A window that cuts the test data's dates at both ends."""
    lo, hi = window_bounds(AS_OF, *CUT_WINDOW)
    e = src.table("eban").filter((F.col("badat") >= lo) & (F.col("badat") <= hi))
    return e.select("banfn", "bnfpo", "badat")


def null_safe_filters(src) -> DataFrame:
    return reservations.open_reservations(src, PICKING_LOCATIONS).select(
        "rsnum", "rspos", "chave_reserva")


# ------------------------------------------------------------------ data quality
def delivery_batches(src) -> DataFrame:
    """Batch numbering of the payment report in delivery order (2,000 rows each)."""
    from fleetyard.sources.delivery import batch_summary
    df = purchasing.po_payment(src, AS_OF, FULL_WINDOW)
    return batch_summary(df, [F.col("pedido")], "pedido")


def json_encoding(src) -> DataFrame:
    """Yard history rows as the JSON objects the application receives."""
    from fleetyard.plans.yard import yard_history
    from fleetyard.sources.delivery import to_json_rows
    return to_json_rows(yard_history(src))


def json_fields(src) -> DataFrame:
    """The rendered yard history rows read back: every field as the text (or
    null) that the application receives."""
    names = ["n_armac", "tipo_relatorio", "ts", "filial", "cliente", "situacao", "horimetro", "descricao"]
    shape = ", ".join(f"{n} string" for n in names)
    return json_encoding(src).select(F.from_json("json", shape).alias("r")).select("r.*")


def yard_payload_fields(src) -> DataFrame:
    """The legacy yard document of the newest 500 events read back: the place of
    every event and row, and its fields as text."""
    from fleetyard.plans.yard import yard_payload
    event = "struct<n_armac:string,tipo_relatorio:string,ts:string,filial:string,cliente:string,horimetro:string>"
    row = "struct<n_armac:string,situacao:string,data_entrada:string,filial:string,cliente:string,horimetro:string>"
    doc = yard_payload(src, "t", 500).select(
        F.from_json("json", f"started_at string, rows array<{row}>, eventos array<{event}>").alias("d"))
    events = doc.select(F.posexplode("d.eventos").alias("place", "e")).select(
        F.lit("evento").alias("part"), "place", "e.n_armac", F.col("e.tipo_relatorio").alias("what"),
        F.col("e.ts").alias("at"), "e.filial", "e.cliente", "e.horimetro")
    rows = doc.select(F.posexplode("d.rows").alias("place", "e")).select(
        F.lit("row").alias("part"), "place", "e.n_armac", F.col("e.situacao").alias("what"),
        F.col("e.data_entrada").alias("at"), "e.filial", "e.cliente", "e.horimetro")
    return events.unionByName(rows)


def work_orders_ordered(src) -> DataFrame:
    """Place of every order in the delivery order of J01 (NULLs last)."""
    from fleetyard.sources.delivery import number_rows
    order = [F.col("filial").asc_nulls_last(), F.col("ativo").asc_nulls_last(), F.col("tipo_manutencao")]
    numbered, _ = number_rows(work_orders.work_orders_latest(src), order, col="place")
    return numbered.select("place", "filial", "ativo", "tipo_manutencao", "ordem")


def dq_code_profile(src) -> DataFrame:
    return quality.code_profile(src.table("resb"), "postp")


def dq_duplicate_keys(src) -> DataFrame:
    return quality.duplicate_keys(src.table("rsadd"), ["rsnum", "rspos"])


def dq_language_profile(src) -> DataFrame:
    return quality.language_profile({"eqkt": src.table("eqkt"), "makt": src.table("makt")})


def dq_null_impact(src) -> DataFrame:
    return quality.null_impact(src)


def _payment_new_old(src):
    new = purchasing.po_payment(src, AS_OF, FULL_WINDOW).select("pedido", "status_pagamento")
    old = purchasing.po_payment_by_item(src)
    return new, old


def dq_row_counts(src) -> DataFrame:
    return quality.row_counts(*_payment_new_old(src))


def dq_diff(src) -> DataFrame:
    return quality.multiset_diff(*_payment_new_old(src))


def dq_orders_without_items(src) -> DataFrame:
    return quality.missing_items(src.table("ekko"), src.table("ekpo"), "ebeln")


def dq_branch_distribution(src) -> DataFrame:
    return quality.distribution(work_orders.work_orders_latest(src), "filial")


def dq_fill_rate(src) -> DataFrame:
    return quality.fill_rate(work_orders.work_orders_latest(src), "status_usuario")


QUERIES = {
    "latest_by_key": latest_by_key,
    "latest_then_filter": latest_then_filter,
    "text_lookup": material_texts,
    "work_centre_branch": work_centre_branch,
    "norm_ids": norm_ids,
    "maintenance_type": maintenance_type,
    "order_phase": order_phase,
    "status_rollup": status_rollup,
    "operation_statuses": operation_statuses,
    "semi_restrict": semi_restrict_query,
    "plant_scope": plant_scope,
    "active_equipment": active_equipment,
    "received_qty": received_qty,
    "purchase_status": purchase_status,
    "account_assignment": account_assignment,
    "invoice_flag": invoice_flag,
    "parts_consumption": parts_consumption,
    "window_filter": window_filter,
    "null_safe_filters": null_safe_filters,
    "delivery_batches": delivery_batches,
    "json_encoding": json_encoding,
    "json_fields": json_fields,
    "yard_payload_fields": yard_payload_fields,
    "work_orders_ordered": work_orders_ordered,
    "dq_code_profile": dq_code_profile,
    "dq_duplicate_keys": dq_duplicate_keys,
    "dq_language_profile": dq_language_profile,
    "dq_null_impact": dq_null_impact,
    "dq_row_counts": dq_row_counts,
    "dq_diff": dq_diff,
    "dq_orders_without_items": dq_orders_without_items,
    "dq_branch_distribution": dq_branch_distribution,
    "dq_fill_rate": dq_fill_rate,
}
