"""Slice by slice runs with a ledger: a slice that is done stays done.

A job over several storage locations or day windows is cut into slices (only jobs
whose rows of one slice do not depend on the others). Each
slice is computed and written to a folder of its own attempt, then entered in
the run's ledger, which names that folder. A run that ends early leaves its
finished slices in the ledger; running it again computes only the others. Rows
of an attempt that never got into the ledger are not read. The first start of
a run records job, date, parameters and slices: a rerun with others is refused.

    run = SliceRun.start(src, out_dir, "pecas_historico", "2025-03-01", as_of=...)
    run.work(src)            # again after a failure: only what is missing
    run.rows()               # all slices together
"""
from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetyard.functions.dates import slice_bounds, slice_count
from fleetyard.plans import parts, reservations
from fleetyard.sources import shared_files as files
from fleetyard.sources.dictionaries import PICKING_LOCATIONS

# (slice name, parameters of the report, columns that the slice adds)
Slice = tuple[str, dict, dict]


def by_location(params: dict) -> list[Slice]:
    """One slice per storage location."""
    return [(v, {"lgorts": (v,)}, {}) for v in params.get("lgorts") or PICKING_LOCATIONS]


def by_days(params: dict) -> list[Slice]:
    """One slice per ``slice_days`` days of the window, the oldest first; column fatia."""
    ini, fim, size = params["ini"], params["fim"], params["slice_days"]
    out = []
    for i in range(slice_count(ini, fim, size)):
        a, b = slice_bounds(i, ini, fim, size)
        out.append((f"{i:04d}", {"ini": a, "fim": b}, {"fatia": i}))
    return out


@dataclass(frozen=True)
class SlicedJob:
    report: Callable[..., DataFrame]
    cut: Callable[[dict], list[Slice]]
    defaults: dict
    uses_as_of: bool = False
    # (src, as_of, slices' parameters by name) -> source rows of all these slices, read
    # in one pass, with column __slice; the report takes those of its slice as ``rows``
    shared: Callable[..., DataFrame] | None = None


SLICED: dict[str, SlicedJob] = {
    "reservas_separacao": SlicedJob(reservations.reservation_picking, by_location, {"lgorts": list(PICKING_LOCATIONS)}),
    "pecas_historico": SlicedJob(parts.parts_history, by_days, {"ini": 365, "fim": 0, "slice_days": 45}, uses_as_of=True,
                                shared=parts.sliced_consumption),
}


@dataclass(frozen=True)
class SliceRun:
    spark: SparkSession
    folder: str
    job: str
    as_of: str | None
    params: dict

    @staticmethod
    def start(src, out_dir: str, job: str, run_id: str, as_of=None, **params) -> SliceRun:
        """Begin the run ``run_id`` below ``out_dir``, or take it up again."""
        spec = SLICED[job]
        unknown = set(params) - set(spec.defaults)
        if unknown:
            raise TypeError(f"job {job!r} takes no parameter(s) {sorted(unknown)}")
        given = {**spec.defaults, **params}
        run = SliceRun(src.spark, f"{out_dir.rstrip('/')}/{job}/{run_id}", job, None if as_of is None else str(as_of), given)
        record = {"job": job, "as_of": run.as_of, "params": {k: list(v) if isinstance(v, tuple) else v for k, v in given.items()},
                  "slices": [name for name, _, _ in run.slices()]}
        if not files.write_record(run.spark, f"{run.folder}/run.json", record):
            before = files.read_record(run.spark, f"{run.folder}/run.json")
            if before != record:
                raise ValueError(f"run {run_id!r} was begun as {before}, not as {record}")
        return run

    def slices(self) -> list[Slice]:
        return SLICED[self.job].cut(self.params)

    def done(self) -> dict[str, dict]:
        """Slices in the ledger: name -> record (folder, attempt)."""
        names = [n for n in files.names(self.spark, f"{self.folder}/ledger") if n.endswith(".json")]
        return {n.removesuffix(".json"): files.read_record(self.spark, f"{self.folder}/ledger/{n}") for n in names}

    def missing(self) -> list[Slice]:
        done = self.done()
        return [s for s in self.slices() if s[0] not in done]

    def work(self, src, at_once: int = 2) -> list[str]:
        """Compute the missing slices, ``at_once`` at a time, and return their names.

        A slice that fails does not hold up the others; its error is raised when
        they are through.
        """
        todo = self.missing()
        folder = f"{self.folder}/shared/{uuid.uuid4().hex}"
        rows = self._shared(src, todo, folder)
        with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
            task = inheritable_thread_target(self.spark)(lambda s: self._one(src, s, rows))
            results = [pool.submit(task, s) for s in todo]
        if rows is not None:
            files.remove(self.spark, folder)
        for r in results:
            r.result()
        return [name for name, _, _ in todo]

    def _shared(self, src, todo: list[Slice], folder: str) -> DataFrame | None:
        """What several slices read of the source, read and joined once and kept by slice
        while they run."""
        shared = SLICED[self.job].shared
        if shared is None or len(todo) < 2:
            return None
        df = shared(src, self.as_of, {name: cut for name, cut, _ in todo})
        df.write.partitionBy("__slice").parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def _one(self, src, part: Slice, rows: DataFrame | None = None) -> None:
        name, cut, adds = part
        spec = SLICED[self.job]
        kw = {k: v for k, v in self.params.items() if k != "slice_days"} | cut
        if spec.uses_as_of:
            kw["as_of"] = self.as_of
        if rows is not None:
            kw["rows"] = rows.filter(F.col("__slice") == name).drop("__slice")
        df = spec.report(src, **kw).withColumns({k: F.lit(v) for k, v in adds.items()})
        attempt = uuid.uuid4().hex
        folder = f"{self.folder}/data/{name}-{attempt}"
        df.write.parquet(folder)
        # of two attempts at one slice the first in the ledger counts
        if not files.write_record(self.spark, f"{self.folder}/ledger/{name}.json", {"folder": folder, "attempt": attempt}):
            files.remove(self.spark, folder)

    def complete(self) -> bool:
        return not self.missing()

    def rows(self) -> DataFrame:
        """The rows of all slices; an error while some are missing."""
        missing = [name for name, _, _ in self.missing()]
        if missing:
            raise ValueError(f"slices not done: {missing}")
        return self.spark.read.parquet(*[r["folder"] for r in self.done().values()])

    def tidy(self) -> int:
        """Remove what attempts left that are not in the ledger; how many there were.
        Only when nobody works on the run."""
        kept = {r["folder"].rpartition("/")[2] for r in self.done().values()}
        gone = [n for n in files.names(self.spark, f"{self.folder}/data") if n not in kept]
        for n in gone:
            files.remove(self.spark, f"{self.folder}/data/{n}")
        files.remove(self.spark, f"{self.folder}/shared")
        return len(gone)
