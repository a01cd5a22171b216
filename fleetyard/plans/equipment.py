"""Equipment register."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetyard.functions import blank_to_null, norm_id
from fleetyard.operators.joins import anti_restrict, spread_key
from fleetyard.operators.keyed import latest_by, text_lookup
from fleetyard.plans.common import sort_report

# Fixed value: system status "marked for deletion".
DELETION_FLAG = "I0076"


def flagged_objects(jest: DataFrame, code: str = DELETION_FLAG) -> DataFrame:
    """Objects with the status ``code`` active."""
    return (jest.filter((F.col("stat") == code) & (F.coalesce("inact", F.lit("")) != "X"))
            .select("objnr"))


def active_equipment(src) -> DataFrame:
    """Equipment not marked for deletion (``NOT EXISTS``: NULL object numbers stay)."""
    return anti_restrict(src.table("equi"), flagged_objects(src.table("jest")), "objnr")


def equipment_register(src, ordered: bool = False) -> DataFrame:
    """Active equipment with description, chassis, brand and current location."""
    desc = text_lookup(src.table("eqkt"), "equnr", "eqktx", lang="spras", langs=["p", "pt"],
                       lang_ci=True, order=[F.col("spras").asc_nulls_last()])
    iloa = src.table("iloa").select("iloan", "tplnr", "swerk")
    # the current row of each equipment first, then its place: fewer rows to
    # join, and rows without a place are spread
    loc = latest_by(src.table("equz"), "equnr",
                    [F.col("datbi").desc_nulls_first(), F.col("iloan").asc_nulls_last()])
    loc = (loc.withColumn("iloan", spread_key(F.col("iloan"), F.col("equnr")))
           .join(iloa, "iloan", "left").select("equnr", "tplnr", "swerk"))
    e = active_equipment(src).join(desc, "equnr", "left").join(loc, "equnr", "left")
    out = e.select(
        F.col("swerk").alias("tipo_holo"), norm_id("equnr").alias("ativo"),
        F.col("eqktx").alias("descricao"),
        blank_to_null(F.coalesce(blank_to_null("sernr"), F.col("serge"))).alias("chassi"),
        blank_to_null("herst").alias("marca"), blank_to_null("typbz").alias("modelo"),
        blank_to_null("eqart").alias("tipo_equipamento"),
        blank_to_null("groes").alias("porte_tonelagem"),
        blank_to_null("baujj").alias("ano_fabricacao"), F.lit("Ativo").alias("status_ativo"),
        blank_to_null("tplnr").alias("local_instalacao"))
    return sort_report(out, [F.col("ativo").asc_nulls_last()], ordered)
