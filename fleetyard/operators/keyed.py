"""Top-1-per-key operators.

All of them run as ``row_number() == 1`` over a window partitioned by the
key. Spark plans that as a *partial* ``WindowGroupLimit`` before the shuffle
(each map task keeps only its own best row per key) and a final one after it,
so a hot key holding a large share of the rows is cut down map-side instead
of landing whole in one task. The ordering passed in must be total: callers
append explicit tiebreak columns so reruns and recomputed partitions pick the
same row.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def _cols(xs) -> list[Column]:
    if isinstance(xs, (str, Column)):
        xs = [xs]
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def latest_by(df: DataFrame, keys, order: Sequence[Column]) -> DataFrame:
    """One row per ``keys``: the first row under ``order``. NULL keys form
    one group (as SQL ``PARTITION BY`` / ``DISTINCT ON`` do)."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*_cols(order))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def latest_then(df: DataFrame, keys, order: Sequence[Column], keep: Column) -> DataFrame:
    """Rank first, then filter: keeps a key only if its latest row passes
    ``keep`` (filtering before the ranking would resurrect older rows)."""
    return latest_by(df, keys, order).filter(keep)


def priority_dedupe(df: DataFrame, keys, ranks: Sequence[Column],
                    tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Keep one row per key, preferring the smallest rank expression first."""
    return latest_by(df, keys, [r.asc_nulls_last() for r in ranks] + list(tiebreak))


def rank_when(cond: Column) -> Column:
    """1 when ``cond`` holds, else 2 (NULL counts as not holding)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(2))


def text_lookup(texts: DataFrame, key, text: str, *, lang: str | None = None,
                langs: Sequence[str] | None = None, lang_ci: bool = False,
                order: Sequence[Column] = (), key_name: str | None = None,
                restrict: DataFrame | None = None) -> DataFrame:
    """Text dictionary: one text per key, in the wanted language(s).

    ``key`` may be an expression (e.g. a zero-stripped id); it is projected
    once as ``key_name``. ``restrict`` (a one-column frame of keys in play)
    turns the lookup into a semi join first, so only needed keys are ranked.
    """
    kcol = F.col(key) if isinstance(key, str) else key
    name = key_name or (key if isinstance(key, str) else "key")
    t = texts
    if langs is not None:
        lc = F.lower(F.col(lang)) if lang_ci else F.col(lang)
        t = t.filter(lc.isin([x.lower() if lang_ci else x for x in langs]))
    t = t.withColumn(name, kcol)
    if restrict is not None:
        t = t.join(restrict.select(F.col(restrict.columns[0]).alias(name)), name, "left_semi")
    ranked = latest_by(t, name, list(order) + [F.col(text).asc_nulls_last()])
    return ranked.select(name, text)
