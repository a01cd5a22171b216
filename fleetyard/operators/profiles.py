"""Profiles of all columns of a table in one pass, with sketches that merge.

Per column: rows, NULLs and blanks (exact), distinct values (HyperLogLog),
quantiles of numbers (KLL) and frequent values (bounded counters). A sketch has
a fixed size however many rows it has seen; sketches of days, slices or
files are stored and combined without reading the rows again.

Errors, with the sizes below: distinct counts about 1.04 / sqrt(2 ** LG_HLL),
1.6 % (three times that is rare); ranks of quantiles about 1.3 / KLL_K ** 0.9 of
the rows, under 1 %; a frequent value's count is at most rows / (0.75 * TRACKED)
too high. ``exact_profile`` is the exact counterpart, for checks and small tables.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LG_HLL, KLL_K, TRACKED, TOP = 12, 400, 4096, 5
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
_PARTS = ("rows", "nulls", "blanks", "hll", "kll", "frequent")


def _number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _text(c: str) -> Column:
    return F.col(f"`{c}`").cast("string")


def sketches(df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """(by.., column, rows, nulls, blanks, hll, kll, frequent): one row per column, from one
    grouping; ``kll`` is NULL for a column that is not a number."""
    fields = [f for f in df.schema.fields if f.name in (columns or df.columns) and f.name not in by]
    aggs = []
    for i, f in enumerate(fields):
        t = _text(f.name)
        aggs += [F.count_if(t.isNull()).alias(f"nulls{i}"), F.count_if(F.trim(t) == "").alias(f"blanks{i}"),
                 F.hll_sketch_agg(t, LG_HLL).alias(f"hll{i}"),
                 F.expr(f"approx_top_k_accumulate(cast(`{f.name}` as string), {TRACKED})").alias(f"frequent{i}"),
                 (F.kll_sketch_agg_double(F.col(f"`{f.name}`").cast("double"), KLL_K) if _number(f.dataType)
                  else F.lit(None).cast("binary")).alias(f"kll{i}")]
    if not fields:
        raise ValueError("no columns to profile")
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *aggs)
    rows = F.array(*[F.struct(F.lit(f.name).alias("column"), "rows", *[F.col(f"{p}{i}").alias(p) for p in _PARTS[1:]])
                     for i, f in enumerate(fields)])
    return wide.select(*by, F.explode(rows).alias("p")).select(*by, "p.*")


def merged(parts: DataFrame) -> DataFrame:
    """Sketches of several parts of a table as those of the whole."""
    return parts.groupBy("column").agg(
        *[F.sum(c).alias(c) for c in _PARTS[:3]], F.hll_union_agg("hll").alias("hll"),
        F.kll_merge_agg_double("kll").alias("kll"),
        F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent"))


def report(whole: DataFrame) -> DataFrame:
    """(column, rows, nulls, blanks, distinct, quantiles, top) of sketches."""
    ranks = F.array(*[F.lit(q) for q in QUANTILES])
    some = F.col("kll").isNotNull() & (F.kll_sketch_get_n_double("kll") > 0)
    top = F.filter(F.expr(f"approx_top_k_estimate(frequent, {TOP + 1})"), lambda x: x["item"].isNotNull())
    return whole.select("column", "rows", "nulls", "blanks", F.hll_sketch_estimate("hll").alias("distinct"),
                        F.when(some, F.kll_sketch_get_quantile_double("kll", ranks)).alias("quantiles"),
                        F.slice(top, 1, TOP).alias("top"))


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return report(sketches(df, (), columns))


def exact_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, rows, nulls, blanks, distinct), counted: each value of each column once
    in a grouping, so this shuffles the distinct values."""
    names = list(columns or df.columns)
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _text(c).alias("v")) for c in names])).alias("x"))
    each = pairs.select("x.*").groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy("column").agg(
        F.sum("n").alias("rows"), F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
        F.sum(F.when(F.trim("v") == "", F.col("n")).otherwise(0)).alias("blanks"), F.count("v").alias("distinct"))
