"""Parts consumption kept by day slices, so that a longer window is merged, not rescanned.

The aggregate of a slice of days (per equipment and material: orders, quantity,
last date and its order) is written once. An order has one creation date, so it
is in one slice: counts and sums of slices add up, dates and last orders are
greatest values, and merging slices gives exactly the aggregate of the window.

Slices are aligned to the calendar (whole multiples of ``days`` since 1970), so
tomorrow's window uses today's slices; the ends of a window that fill no slice
are read from the source. A slice is entered in a ledger when its rows are
written; only slices that lie wholly before ``settled`` days ago are kept, since
younger orders may still get reservations.
"""
from __future__ import annotations

import datetime as _dt
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetyard.functions.dates import as_date
from fleetyard.plans.parts import consumption, described, parts_agg
from fleetyard.sources import shared_files as files

EPOCH = _dt.date(1970, 1, 1)


def merged(states: DataFrame) -> DataFrame:
    """States of slices as one: the columns of ``parts_agg``."""
    return states.groupBy("equnr", "matnr").agg(
        F.sum("qtd_ocorrencias").alias("qtd_ocorrencias"), F.sum("qtd_total").alias("qtd_total"),
        F.max("__last").alias("__last")).select(
        "equnr", "matnr", "qtd_ocorrencias", "qtd_total", F.col("__last.d").alias("ultima_data"), "__last")


@dataclass(frozen=True)
class PartsState:
    spark: SparkSession
    path: str
    days: int = 45
    settled: int = 0

    def _days(self, number: int) -> tuple[_dt.date, _dt.date]:
        first = EPOCH + _dt.timedelta(days=number * self.days)
        return first, first + _dt.timedelta(days=self.days - 1)

    def _file(self, number: int) -> str:
        return f"{self.path}/ledger/{self.days}-{number:06d}.json"

    def whole(self, as_of, ini: int, fim: int) -> range:
        """Numbers of the slices that lie wholly in the window and are settled."""
        day = as_date(as_of)
        low, high = day - _dt.timedelta(days=ini), day - _dt.timedelta(days=max(fim, self.settled))
        first = -(-(low - EPOCH).days // self.days)
        return range(first, max(first, ((high - EPOCH).days + 1) // self.days))

    def missing(self, as_of, ini: int, fim: int) -> list[int]:
        return [n for n in self.whole(as_of, ini, fim) if not files.exists(self.spark, self._file(n))]

    def fill(self, src, as_of, ini: int, fim: int) -> list[int]:
        """Compute the slices of the window that are not kept yet, in one pass over the
        source, and return their numbers."""
        todo = self.missing(as_of, ini, fim)
        if not todo:
            return []
        day = as_date(as_of)
        self._write(src, as_of, (day - self._days(todo[0])[0]).days, (day - self._days(todo[-1])[1]).days, todo)
        return todo

    def _write(self, src, as_of, ini: int, fim: int, todo: list[int], ends: range | None = None) -> list[str]:
        """Aggregate the window by slices in one pass, enter the slices ``todo`` in the ledger
        and return the folders of the others: of slices outside ``ends``, where it is given."""
        n = F.col("slice")
        rows = consumption(src, as_of, ini, fim).withColumn("slice", self._number(F.to_date("erdat")))
        rows = rows.filter(n.isin(todo) | ((n < ends.start) | (n >= ends.stop) if ends else F.lit(False)))
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        parts = parts_agg(rows, ["slice"])
        parts.write.partitionBy("slice").parquet(folder)
        schema = parts.drop("slice").schema.json()
        for i in todo:
            files.write_record(self.spark, self._file(i), {"folder": f"{folder}/slice={i}", "schema": schema})
        if not ends:
            return []
        day = as_date(as_of)
        first, last = (((day - _dt.timedelta(days=d)) - EPOCH).days // self.days for d in (ini, fim))
        return [f"{folder}/slice={i}" for i in [*range(first, ends.start), *range(ends.stop, last + 1)]]

    def _number(self, date):
        return F.floor(F.datediff(date, F.lit(EPOCH)) / self.days).cast("int")

    def states(self, as_of, ini: int, fim: int, others: list[str] = ()) -> list[DataFrame]:
        """Kept states of the window's whole slices, and those in the folders ``others``; a
        slice without rows has no folder."""
        out = []
        records = [files.read_record(self.spark, self._file(n)) for n in self.whole(as_of, ini, fim)]
        paths = [p for p in (*[r["folder"] for r in records], *others) if files.exists(self.spark, p)]
        if paths:
            out.append(self.spark.read.schema(StructType.fromJson(json.loads(records[0]["schema"]))).parquet(*paths))
        return out

    def aggregate(self, src, as_of, ini: int, fim: int) -> DataFrame:
        """``parts_agg`` of the window: kept slices merged with what the source has at its ends.

        Where slices are missing, they and the ends are computed in one pass over the
        source; the ends are written beside the slices and are not in the ledger.
        """
        day, whole = as_date(as_of), self.whole(as_of, ini, fim)
        if not whole:
            return parts_agg(consumption(src, as_of, ini, fim))
        if todo := self.missing(as_of, ini, fim):
            parts = self.states(as_of, ini, fim, self._write(src, as_of, ini, fim, todo, whole))
        else:
            first, last = (day - self._days(whole[0])[0]).days, (day - self._days(whole[-1])[1]).days
            parts = self.states(as_of, ini, fim)
            parts += [parts_agg(consumption(src, as_of, ini, first + 1))] if ini > first else []
            parts += [parts_agg(consumption(src, as_of, last - 1, fim))] if last > fim else []
        out = parts[0] if parts else parts_agg(consumption(src, as_of, ini, fim)).limit(0)
        for p in parts[1:]:
            out = out.unionByName(p)
        return merged(out)

    def history(self, src, as_of, ini: int = 365, fim: int = 0) -> DataFrame:
        """J15 over the window, from kept slices."""
        return described(src, self.aggregate(src, as_of, ini, fim))
