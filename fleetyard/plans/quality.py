"""Data-quality and reconciliation checks (preflight profiles, old-vs-new
comparisons, distribution and fill-rate checks), all as distributed
aggregates: nothing is collected to the driver."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetyard.operators.joins import anti_restrict
from fleetyard.sources.dictionaries import NON_STOCK_TEXT, PICKING_LOCATIONS


def code_profile(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of a code column with their length and row count."""
    return df.groupBy(F.col(col).alias("valor"), F.length(col).cast("bigint").alias("tamanho")) \
        .agg(F.count(F.lit(1)).alias("qtd"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys occurring more than once (HAVING count > 1)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("qtd")).filter(F.col("qtd") > 1)


def language_profile(tables: dict[str, DataFrame], col: str = "spras") -> DataFrame:
    """Row count per language code over several text tables (union of group counts)."""
    out = None
    for name, df in tables.items():
        g = df.groupBy(F.col(col).alias("spras")).agg(F.count(F.lit(1)).alias("qtd")) \
            .select(F.lit(name).alias("tabela"), "spras", "qtd")
        out = g if out is None else out.unionByName(g)
    return out


def null_impact(src, lgorts=PICKING_LOCATIONS) -> DataFrame:
    """Rows the NULL-unsafe versions of the reservation filters would hide."""
    r = src.table("resb").filter(
        F.col("lgort").isin(list(lgorts)) & F.col("bwart").isin("201", "261")
        & ~F.col("sgtxt").eqNullSafe(NON_STOCK_TEXT) & ~F.col("xloek").eqNullSafe("X")
        & ((F.col("postp") == "L") | F.col("postp").isNull() | (F.col("postp") == "")))
    return r.agg(
        F.count_if(F.col("sgtxt").isNull()).alias("sgtxt_nulo"),
        F.count_if(F.col("xloek").isNull()).alias("xloek_nulo"),
        F.count_if(F.col("sgtxt").isNull() | F.col("xloek").isNull()).alias("linhas_novas"),
        F.count(F.lit(1)).alias("total_apos_correcao"))


def row_counts(new: DataFrame, old: DataFrame) -> DataFrame:
    """Row counts of two versions of a report, side by side (one row, one pass)."""
    tagged = new.select(F.lit(1).alias("__k")).unionByName(old.select(F.lit(2).alias("__k")))
    return tagged.agg(F.count_if(F.col("__k") == 1).alias("linhas_nova"),
                      F.count_if(F.col("__k") == 2).alias("linhas_antiga"))


def multiset_diff(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows of each side missing from the other, duplicates counted (EXCEPT ALL
    both ways); ``lado`` tells which side the row comes from.

    One signed count per row value: each report runs once, and equal rows are
    combined before the shuffle."""
    tagged = new.withColumn("__side", F.lit(1)).unionByName(old.withColumn("__side", F.lit(-1)))
    net = tagged.groupBy(*new.columns).agg(F.sum("__side").alias("__net")).filter(F.col("__net") != 0)
    side = F.when(F.col("__net") > 0, F.lit("so_nova")).otherwise(F.lit("so_antiga"))
    each = F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("__net")))
    return net.select(*new.columns, side.alias("lado"), each.alias("__nth")).drop("__nth")


def missing_items(headers: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """Headers that no item refers to (a NULL key has none)."""
    return anti_restrict(headers, items.select(key), key).select(key)


def distribution(df: DataFrame, col: str) -> DataFrame:
    """Row count per value (e.g. per branch)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("qtd"))


def fill_rate(df: DataFrame, col: str) -> DataFrame:
    """Share of rows with ``col`` filled (one row)."""
    return df.agg(F.count(F.lit(1)).alias("linhas"),
                  F.count_if(F.col(col).isNotNull()).alias("preenchidas")) \
        .withColumn("taxa", F.col("preenchidas") / F.col("linhas"))
