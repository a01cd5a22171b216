"""Front end of the scheduled jobs.

``python -m fleetyard jobs`` shows them; ``python -m fleetyard VERB NAME SOURCE
OUT [name=value ...]`` runs one. Verbs: ``run`` writes delivery documents,
``send`` a delivery that is whole or not there and never twice, ``snapshot`` a
table of its own, ``merge`` the next version of a table, by key, ``slices``
slice by slice (``id=NAME`` names the run; given again, only what is missing).
A source is ``parquet:<root>``, ``catalog:<database>``, ``testdata:<sf_dir>`` or
a ``jdbc:`` URL (user and password from the environment: FLEETYARD_DB_USER,
FLEETYARD_DB_PASSWORD; for the telemetry jobs' own database a second URL,
``telemetry=jdbc:...``, with FLEETYARD_TELEMETRY_USER and _PASSWORD). Further
words set the job's parameters (``ini=30``), ``as_of=YYYY-MM-DD``, ``spread=1``
(popular keys are measured and dealt over tasks), or for a database ``schema=``
and ``parts=`` (parts that each large table is read in, default 16); storage
locations are read as parallel slices.
"""
from __future__ import annotations

import os
import sys

from fleetyard.plans import jobs
from fleetyard.plans.jobs import JOBS, run
from fleetyard.sources.dictionaries import PICKING_LOCATIONS
from fleetyard.sources.tables import (CatalogTables, JdbcTables, ParquetTables, RoutedTables, key_ranges,
                                      value_slices)

# Tables of the telemetry database.
TELEMETRY = ("hourmeter", "hourmeter_invalid")


def login(prefix: str) -> dict:
    return {"user": os.environ.get(f"{prefix}_USER", ""), "password": os.environ.get(f"{prefix}_PASSWORD", "")}


def open_source(spark, where: str, schema: str | None = None, telemetry: str | None = None, parts: int = 16):
    kind, _, place = where.partition(":")
    if kind == "jdbc":
        main_source = JdbcTables(spark, where, login("FLEETYARD_DB"), schema=schema, keys=key_ranges(parts),
                                 slices={"resb": value_slices("lgort", PICKING_LOCATIONS) + other_locations()})
        if not telemetry:
            return main_source
        other = JdbcTables(spark, telemetry, login("FLEETYARD_TELEMETRY"))
        return RoutedTables(main_source, {name: other for name in TELEMETRY})
    if kind == "testdata":
        from fleetyard.sources.testdata import TestdataTables
        return TestdataTables(spark, place)
    readers = {"parquet": ParquetTables, "catalog": CatalogTables}
    if kind not in readers:
        raise SystemExit(f"a source begins with jdbc:, testdata:, {': or '.join(readers)}:, not {kind!r}")
    return readers[kind](spark, place)


def other_locations() -> list[str]:
    """The rest of the rows, so that slices by location leave none out."""
    known = " OR ".join(value_slices("lgort", PICKING_LOCATIONS))
    return [f"NOT ({known})", "lgort IS NULL"]


def settings(words: list[str]) -> dict:
    """``name=value`` words; whole numbers become integers, ``a,b`` lists."""
    out: dict = {}
    for word in words:
        name, eq, value = word.partition("=")
        if not eq:
            raise SystemExit(f"expected name=value, got {word!r}")
        out[name] = int(value) if value.lstrip("-").isdigit() else value.split(",") if "," in value else value
    return out


def main(argv: list[str] | None = None) -> int:
    words = list(sys.argv[1:] if argv is None else argv)
    match words:
        case ["jobs"]:
            for name in JOBS:
                given = ", ".join(f"{k}={v}" for k, v in JOBS[name].defaults.items())
                print(f"{name}: {JOBS[name].report.__doc__.split(chr(10))[0] if JOBS[name].report.__doc__ else ''} [{given}]")
        case [("run" | "send" | "snapshot" | "merge" | "slices") as verb, name, where, out, *more] if name in JOBS:
            from fleetyard.session import build_session
            given = settings(more)
            source = open_source(build_session(), where, given.pop("schema", None), given.pop("telemetry", None),
                                 given.pop("parts", 16))
            as_of = given.pop("as_of", None)
            if verb == "slices":
                from fleetyard.plans.slices import SliceRun
                work = SliceRun.start(source, out, name, str(given.pop("id")), as_of, **given)
                print(f"{work.folder}: {len(work.work(source))} slices")
            else:
                verbs = {"run": run, "send": jobs.send, "snapshot": jobs.snapshot, "merge": jobs.merge}
                print(verbs[verb](name, source, out, as_of=as_of, **given))
        case _:
            print(__doc__, file=sys.stderr)
            return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
