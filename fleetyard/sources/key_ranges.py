"""Equal-depth ranges of a key: parts of a table that hold about as many rows each.

A database read in equal strides of a key puts most rows in one connection
where keys cluster. Here the bounds are taken from the keys themselves (a sample
of them for a database, see ``JdbcTables``): sorted, and cut at every 1/n of the
rows. A key of several columns is cut in the order of all of them, so one value
that holds many rows is divided by the next column.

The parts are half-open and follow one another, so together they hold every row
once: rows below the first bound, from each bound to the next, from the last
bound on, and rows whose first column is NULL. A NULL in a later column comes
first among rows of equal earlier columns.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetyard.session import discard
from fleetyard.sources.delivery import number_rows

Bound = tuple


def equal_depth_bounds(keys: DataFrame, columns: Sequence[str], parts: int) -> list[Bound]:
    """At most ``parts`` - 1 bounds that cut the rows of ``keys`` into parts of about
    equal depth: the key at every 1/parts of the rows in key order.

    Rows are numbered by range partitions and offsets; only the bounds come to
    the driver. A key with NULL in its first column is not counted.
    """
    if parts < 2:
        return []
    rows = keys.select(*columns).filter(F.col(columns[0]).isNotNull())
    numbered, kept = number_rows(rows, [F.col(c).asc_nulls_first() for c in columns], total="__rows")
    try:
        at = F.array(*[F.expr(f"__rows * {i} div {parts}") for i in range(1, parts)])
        found = numbered.filter(F.array_contains(at, F.col("__row"))).select(*columns).distinct().collect()
    finally:
        discard(keys.sparkSession, kept)
    return sorted((tuple(r) for r in found), key=lambda b: [(v is not None, v) if v is not None else (False,) for v in b])


def literal(value) -> str:
    """A key value as SQL text."""
    if value is None or isinstance(value, bool):
        raise TypeError(f"no key value: {value!r}")
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def below(columns: Sequence[str], bound: Bound) -> str:
    """Predicate: the key comes before ``bound`` (true or false where the first column is not NULL)."""
    column, value = columns[0], bound[0]
    rest = below(columns[1:], bound[1:]) if len(columns) > 1 else ""
    if value is None:                     # NULL comes first: only an equal key's later columns can be below
        return f"({column} IS NULL AND {rest})" if rest else "1 = 0"
    less = f"{column} < {literal(value)}"
    return f"({less} OR ({column} = {literal(value)} AND {_null_first(columns[1], bound[1], rest)}))" if rest else f"({less})"


def _null_first(column: str, value, rest: str) -> str:
    return rest if value is None else f"({column} IS NULL OR {rest})"


def from_on(columns: Sequence[str], bound: Bound) -> str:
    """Predicate: the key is ``bound`` or comes after it; the complement of :func:`below`."""
    column, value = columns[0], bound[0]
    rest = from_on(columns[1:], bound[1:]) if len(columns) > 1 else ""
    if value is None:
        return f"({column} IS NOT NULL OR {rest})" if rest else "1 = 1"
    more = f"{column} > {literal(value)}"
    return f"({more} OR ({column} = {literal(value)} AND {rest}))" if rest else f"({column} >= {literal(value)})"


def range_predicates(columns: Sequence[str], bounds: Sequence[Bound], collate: str = "{}") -> list[str]:
    """One predicate per part, the NULL part last. ``collate`` wraps a column where
    the database would otherwise order text in another way than the bounds."""
    names = [collate.format(c) for c in columns]
    parts = []
    for low, high in zip([None, *bounds], [*bounds, None]):
        both = [from_on(names, low)] if low else []
        both += [below(names, high)] if high else []
        parts.append(" AND ".join(both) or f"{columns[0]} IS NOT NULL")
    return [*parts, f"{columns[0]} IS NULL"]


def depths(rows: DataFrame, columns: Sequence[str], bounds: Sequence[Bound]) -> DataFrame:
    """(part, rows, low, high): how many rows each part holds, and its least and greatest first column."""
    predicates = range_predicates(columns, bounds)
    part = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(predicates))):
        part = F.when(F.expr(p), i).otherwise(part)
    return rows.select(part.alias("part"), *columns).groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.min(columns[0]).alias("low"), F.max(columns[0]).alias("high"))
