"""Yard events by polling: each poll reads what is new and a little before it.

A poll asks the source for events above a high-water mark less an overlap, in
which rows may still come in late (numbered early, committed late), be corrected
or withdrawn. What it finds there is compared, by event number, with what the poll
before saw, and the difference updates the latest event per asset
(``refreshed_latest``): an asset whose latest event was corrected or withdrawn is
ranked again from the source, the others are settled by their winners and the
new rows.

Kept between polls: the winners (a row per asset) and the events of the overlap.
A poll writes both to a folder of its own and enters it in a record with the new
mark; older folders go after the next poll, so what is stored follows assets and
overlap, not history. A poll that fails leaves the state of the one before.
"""
from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetyard.operators.keyed import latest_by
from fleetyard.operators.keyed_diff import DELETE, SAME, keyed_diff
from fleetyard.operators.maintained import refreshed_latest
from fleetyard.plans.yard import YARD
from fleetyard.sources import shared_files as files
from fleetyard.streaming.yard_state import PAYLOAD, in_yard

COLUMNS = ["asset", "id", "created_at_form", *PAYLOAD]


def _order():
    return [F.col("created_at_form").desc_nulls_last(), F.col("id").desc()]


def _events(src) -> DataFrame:
    """Events with an asset, keyed as the reports key them."""
    ev = src.table(YARD).filter(F.col("n_armac").isNotNull())
    return ev.withColumn("asset", F.upper(F.trim("n_armac"))).select(*COLUMNS)


@dataclass(frozen=True)
class YardPoll:
    spark: SparkSession
    path: str
    overlap: int = 10_000           # event numbers

    def _records(self) -> list[str]:
        return [n for n in files.names(self.spark, f"{self.path}/polls") if n.endswith(".json") and not n.startswith("_")]

    def last(self) -> dict | None:
        names = self._records()
        return files.read_record(self.spark, f"{self.path}/polls/{names[-1]}") if names else None

    def _read(self, record: dict, what: str) -> DataFrame:
        return self.spark.read.parquet(f"{record['folder']}/{what}")

    def poll(self, src) -> dict:
        """Take in what the source has now; the record of this poll."""
        before = self.last()
        events = _events(src)
        number = 1 + (before["number"] if before else 0)
        folder = f"{self.path}/state/{number:08d}-{uuid.uuid4().hex}"
        if before is None:
            winners, floor = latest_by(events, "asset", _order()), None
            seen = events
        else:
            floor = before["mark"] - self.overlap
            seen = events.filter(F.col("id") > floor)
            diff = keyed_diff(self._read(before, "recent"), seen, ["id"])
            rest = [c for c in COLUMNS if c != "id"]
            written = diff.filter(~F.col("op").isin(SAME, DELETE)).select("id", *[F.col("new")[c].alias(c) for c in rest])
            deleted = diff.filter(F.col("op") == DELETE).select("id")
            winners = refreshed_latest(self._read(before, "winners"), written, deleted, events, ["asset"], ["id"], _order())
        mark = seen.agg(F.max("id")).first()[0]
        mark = max(x for x in (mark, before and before["mark"], 0) if x is not None)
        winners.select(*COLUMNS).write.parquet(f"{folder}/winners")
        seen.filter(F.col("id") > mark - self.overlap).write.parquet(f"{folder}/recent")
        record = {"number": number, "mark": mark, "folder": folder}
        if not files.write_record(self.spark, f"{self.path}/polls/{number:08d}.json", record):
            files.remove(self.spark, folder)
            raise RuntimeError(f"poll {number} was made by somebody else meanwhile")
        self._forget(number - 1)
        return record

    def _forget(self, number: int) -> None:
        """Remove polls before ``number``; a reader of the last one is not disturbed."""
        for name in self._records():
            if int(name.removesuffix(".json")) < number:
                old = files.read_record(self.spark, f"{self.path}/polls/{name}")
                files.remove(self.spark, old["folder"])
                files.remove(self.spark, f"{self.path}/polls/{name}")

    def winners(self) -> DataFrame:
        """The latest event of every asset as of the last poll."""
        record = self.last()
        if record is None:
            raise FileNotFoundError(f"no poll in {self.path}")
        return self._read(record, "winners")

    def current(self) -> DataFrame:
        """Assets in the yard: the rows of the ``yard_current`` report."""
        return in_yard(self.winners().withColumnRenamed("asset", "n_armac")
                       .withColumnRenamed("created_at_form", "data_entrada"))
