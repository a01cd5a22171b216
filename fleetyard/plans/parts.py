"""Parts consumption history per asset and part."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetyard.functions import day_slice_id, not_blank, strip_zeros, window_bounds
from fleetyard.operators.hot_keys import HotKeys, dealt_join, measure
from fleetyard.operators.joins import dealt_by_size
from fleetyard.operators.keyed import text_lookup
from fleetyard.plans.common import dbl, sort_report


def consumption(src, as_of, ini: int, fim: int) -> DataFrame:
    """Reservation lines of orders created in the window, with equipment and material."""
    lo, hi = window_bounds(as_of, ini, fim)
    a = src.table("aufk").filter((F.col("erdat") >= lo) & (F.col("erdat") <= hi)) \
        .select("aufnr", "erdat")
    h = src.table("afih").filter(not_blank("equnr")).select("aufnr", "equnr")
    r = src.table("resb").filter(not_blank("matnr")).select("aufnr", "matnr", "bdmng")
    # the join, both hash tables and the sort of ``parts_agg`` share a stage
    a, h, r = dealt_by_size("aufnr", a, h, r)
    return a.join(h, "aufnr").join(r, "aufnr")


def sliced_consumption(src, as_of, cuts: dict[str, dict]) -> DataFrame:
    """Consumption of several slices of days (name -> ini, fim; no day in two) in one
    pass over the source; column __slice names the slice."""
    rows = consumption(src, as_of, max(c["ini"] for c in cuts.values()), min(c["fim"] for c in cuts.values()))
    names = []
    for name, c in cuts.items():
        lo, hi = window_bounds(as_of, c["ini"], c["fim"])
        names.append(F.when((F.col("erdat") >= lo) & (F.col("erdat") <= hi), F.lit(name)))
    return rows.withColumn("__slice", F.coalesce(*names)).filter(F.col("__slice").isNotNull())


def parts_agg(cons: DataFrame, extra_keys: list = ()) -> DataFrame:
    """Per (equipment, material): distinct orders, total quantity, last date and
    the order of that date (newest date, then highest order number).

    Two aggregation levels, both with map-side partial aggregation: first per
    order (which also makes the order count exact without a distinct
    aggregate), then per (equipment, material). A hot pair is reduced before
    each shuffle instead of being collected in one task."""
    keys = ["equnr", "matnr", *extra_keys]
    # the creation date belongs to the order, so it is a grouping key here:
    # this level then only sums decimals and runs as a hash aggregate
    per_order = cons.groupBy(*keys, "aufnr", F.col("erdat").alias("d")).agg(
        F.sum("bdmng").alias("q"))
    # the last date is part of the last order: the shuffle carries it once
    return per_order.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("qtd_ocorrencias"), F.sum("q").alias("qtd_total"),
        F.max(F.struct("d", "aufnr")).alias("__last")).select(
        *keys, "qtd_ocorrencias", "qtd_total", F.col("__last.d").alias("ultima_data"), "__last")


def hot_parts(src) -> HotKeys:
    """Popular parts of the reservations, measured in one pass over the key."""
    return measure(src.table("resb").filter(not_blank("matnr")), strip_zeros("matnr"))


def parts_history(src, as_of=None, ini: int = 365, fim: int = 0, slice_days: int | None = None,
                  ordered: bool = False, hot: HotKeys | None = None, rows: DataFrame | None = None) -> DataFrame:
    """J15. ``slice_days`` reproduces the delivery cut into day slices: the
    slice id joins the group key, so counts and sums are per slice. ``hot``: parts
    that a large share of the assets use (``hot_parts``). ``rows``: the window's
    consumption, where it is already read."""
    cons = consumption(src, as_of, ini, fim) if rows is None else rows
    extra = []
    if slice_days:
        cons = cons.withColumn("fatia", day_slice_id("erdat", as_of, ini, fim, slice_days))
        extra = ["fatia"]
    out = described(src, parts_agg(cons, extra), extra, hot)
    return sort_report(out, [F.col("ativo"), F.col("cod_sap")], ordered)


def described(src, agg: DataFrame, extra: list = (), hot: HotKeys | None = None) -> DataFrame:
    """Report rows of :func:`parts_agg` rows: ids without zeros, texts, material group."""
    agg = agg.withColumn("__eq", strip_zeros("equnr")).withColumn("__mat", strip_zeros("matnr"))
    eq_txt = text_lookup(src.table("eqkt"), strip_zeros("equnr"), "eqktx", lang="spras",
                         langs=["p", "pt"], lang_ci=True, order=[F.col("spras").asc_nulls_last()],
                         key_name="__eq")
    mat_txt = text_lookup(src.table("makt"), strip_zeros("matnr"), "maktx", lang="spras",
                          langs=["p", "pt"], lang_ci=True, order=[F.col("spras").asc_nulls_last()],
                          key_name="__mat")
    mara = src.table("mara").select(strip_zeros("matnr").alias("__mat"), "matkl")
    # material text and group come in one join (a material may have several group rows)
    materials = mara.join(mat_txt, "__mat", "full_outer")
    j = agg.join(eq_txt, "__eq", "left")
    if hot is None:
        j = j.join(materials, "__mat", "left")
    else:
        salt = F.concat_ws("/", "equnr", *[F.col(c).cast("string") for c in extra])
        j = dealt_join(j, materials.withColumnRenamed("__mat", "__of"), F.col("__mat"), "__of", hot, salt)
    return j.select(
        F.col("__eq").alias("ativo"), F.col("eqktx").alias("descricao_ativo"),
        F.col("__mat").alias("cod_sap"), F.col("maktx").alias("descricao_componente"),
        F.col("matkl").alias("grupo_mercadoria"), "qtd_ocorrencias",
        dbl("qtd_total").alias("qtd_total"),
        strip_zeros(F.col("__last.aufnr")).alias("ultima_ordem"), "ultima_data", *extra)
