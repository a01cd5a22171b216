"""Destination tables in versions: a report is merged in by key, rows that left go.

A version is a folder of changes (inserted and changed rows whole, keys of
deleted ones) against the version before, so a delivery writes what changed
and not the table. Versions are entered by record, the next number is given once:
of two merges at one time the second fails and can be run again. Reading a
version takes the last whole copy before it and the changes since, and keeps
each key's last row. ``compact`` writes a whole copy, so that reading does not
grow with the number of versions; older versions stay readable.
"""
from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetyard.operators.keyed import latest_by
from fleetyard.operators.keyed_diff import DELETE, INSERT, REPEATED, SAME, UPDATE, keyed_diff
from fleetyard.sources import shared_files as files


@dataclass(frozen=True)
class VersionedTable:
    spark: SparkSession
    path: str
    keys: tuple[str, ...]

    @staticmethod
    def at(spark: SparkSession, path: str, keys: Sequence[str]) -> VersionedTable:
        return VersionedTable(spark, path.rstrip("/"), tuple(keys))

    def _records(self, kind: str) -> dict[int, dict]:
        folder = f"{self.path}/{kind}"
        return {int(n.removesuffix(".json")): files.read_record(self.spark, f"{folder}/{n}")
                for n in files.names(self.spark, folder) if n.endswith(".json") and not n.startswith("_")}

    def versions(self) -> dict[int, dict]:
        """Number -> record (counts of inserted, changed and deleted keys, label)."""
        return self._records("versions")

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version (default: the last)."""
        known = self.versions()
        if not known:
            raise FileNotFoundError(f"no version in {self.path}")
        version = max(known) if version is None else version
        if version not in known:
            raise FileNotFoundError(f"no version {version} in {self.path}")
        copies = [v for v in self._records("copies") if v <= version]
        start = max(copies, default=0)
        parts = [self.spark.read.parquet(self._records("copies")[start]["folder"])
                 .withColumns({"__version": F.lit(start), "__op": F.lit(INSERT)})] if start else []
        parts += [self.spark.read.parquet(known[v]["folder"]).withColumn("__version", F.lit(v))
                  for v in sorted(known) if start < v <= version]
        log = parts[0]
        for p in parts[1:]:
            log = log.unionByName(p)
        if len(parts) > 1:
            log = latest_by(log, list(self.keys), [F.col("__version").desc()])
        return log.filter(F.col("__op") != DELETE).drop("__version", "__op")

    def merge(self, report: DataFrame, label: str | None = None) -> dict[str, int]:
        """Make ``report`` (one row per key) the next version; counts of its changes.

        Without a change there is no new version. A key with several rows is an error.
        """
        known = self.versions()
        number = max(known, default=0) + 1
        old = self.read() if known else report.limit(0)
        columns = [c for c in report.columns if c not in self.keys]
        if sorted(old.columns) != sorted(report.columns):
            raise ValueError(f"columns {report.columns} are not those of the table, {old.columns}")
        diff = keyed_diff(old, report, self.keys, columns)
        rows = diff.filter(F.col("op") != SAME).select(
            *self.keys, *[F.col("new")[c].alias(c) for c in columns], F.col("op").alias("__op"))
        folder = f"{self.path}/changes/{number:08d}-{uuid.uuid4().hex}"
        rows.write.parquet(folder)
        found = {r["__op"]: r["n"] for r in self.spark.read.parquet(folder).groupBy("__op").agg(F.count(F.lit(1)).alias("n")).collect()}
        if found.get(REPEATED):
            files.remove(self.spark, folder)
            raise ValueError(f"{found[REPEATED]} keys with several rows")
        counts = {op: found.get(op, 0) for op in (INSERT, UPDATE, DELETE)}
        if known and not any(counts.values()):
            files.remove(self.spark, folder)
            return counts
        if not files.write_record(self.spark, f"{self.path}/versions/{number:08d}.json", {"folder": folder, "label": label, **counts}):
            files.remove(self.spark, folder)
            raise RuntimeError(f"version {number} was written by somebody else meanwhile; merge again")
        return counts

    def changes(self, version: int) -> DataFrame:
        """What a version changed: the rows and __op."""
        return self.spark.read.parquet(self.versions()[version]["folder"])

    def compact(self) -> int:
        """Write the last version as a whole copy; its number."""
        number = max(self.versions())
        if number not in self._records("copies"):
            folder = f"{self.path}/whole/{number:08d}-{uuid.uuid4().hex}"
            self.read(number).write.parquet(folder)
            if not files.write_record(self.spark, f"{self.path}/copies/{number:08d}.json", {"folder": folder}):
                files.remove(self.spark, folder)
        return number
