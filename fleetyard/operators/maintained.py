"""The latest row of every key, kept up to date from changes instead of ranked anew.

Yesterday's winners and today's changes decide most keys: a row that came in or
was changed competes with the winner. Only where a winner itself was changed or
deleted can another row, of any age, be next; those few keys are ranked again
from the table, which is restricted to them first.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetyard.operators.keyed import latest_by


def _same(names: Sequence[str], left: DataFrame, right: DataFrame) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right[n])
    return cond


def refreshed_latest(winners: DataFrame, written: DataFrame, deleted: DataFrame, table: DataFrame,
                     keys: Sequence[str], ids: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The winners after a set of changes: as ``latest_by(table, keys, order)``.

    ``winners``: the winners before. ``written``: rows inserted or changed, as
    they are now. ``deleted``: ids of rows that are gone. ``table``: the rows
    after the changes (read only for keys whose winner was touched). ``ids``
    name a row; a changed row may have another key than before.
    """
    touched = written.select(*ids).union(deleted.select(*ids)).distinct()
    hit = winners.join(touched, _same(ids, winners, touched), "left_semi")
    again = hit.select(*keys).distinct()                       # keys to be ranked anew
    kept = winners.join(touched, _same(ids, winners, touched), "left_anti")
    rivals = written.select(*winners.columns)
    rivals = rivals.join(again, _same(keys, rivals, again), "left_anti")
    ranked = latest_by(kept.unionByName(rivals), list(keys), order)
    rows = table.select(*winners.columns)
    return ranked.unionByName(latest_by(rows.join(again, _same(keys, rows, again), "left_semi"), list(keys), order))
