"""Join helpers and the broadcast policy.

Only catalogue tables (status texts, activity / priority / order-type texts,
planner groups, storage locations, work centres, the system-user master) are
broadcast by hint: their size is bounded by the code catalogue or the
organisation, not by data volume. Every other lookup
is a plain join; Spark broadcasts it only if its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at runtime with the
real shuffle sizes) and otherwise uses a sort-merge / shuffled hash join.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Upper bound for a broadcast hint; override with the session setting
# ``fleetyard.broadcast.maxBytes``.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Planner size estimate of ``df`` (from file sizes and statistics; no job runs)."""
    try:
        v = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except Exception:  # noqa: BLE001 - no JVM-side plan (e.g. Spark Connect): size unknown
        return 1 << 62
    return int(v) if isinstance(v, int) else int(v.toString())


def code_table(df: DataFrame, max_bytes: int | None = None, inputs=None) -> DataFrame:
    """Broadcast a catalogue-sized table, behind a size check.

    The hint is given only when the planner's size estimate is under the
    limit; otherwise (or when the size is unknown) the join stays a plain
    join and Spark/AQE choose broadcast or shuffle from measured sizes.
    ``inputs``: the tables that ``df`` is joined from. Their sizes are summed
    instead (the estimate of a join is a product of sizes); only for joins
    that add columns to rows, so that the result is no larger than that.
    """
    limit = max_bytes
    if limit is None:
        limit = int(df.sparkSession.conf.get("fleetyard.broadcast.maxBytes",
                                             str(BROADCAST_MAX_BYTES)))
    size = sum(map(estimated_bytes, inputs)) if inputs else estimated_bytes(df)
    return F.broadcast(df) if size <= limit else df


# Estimated bytes of input that one partition of :func:`dealt_by_size` holds; more
# partitions than MOST_PARTITIONS mean that the size is not known.
TASK_BYTES, MOST_PARTITIONS = 2 << 20, 1 << 16


def dealt_by_size(on: str, *frames: DataFrame, task_bytes: int = TASK_BYTES) -> list[DataFrame]:
    """``frames``, to be joined on ``on``, hash-partitioned by it in as many
    partitions as their estimated size asks for.

    Shuffle partitions are merged by their compressed bytes, of which rows in
    sorters and hash tables take a multiple. In stages with several of these,
    partitions of a fixed share of the input keep the memory of a task the same
    whatever the input's size. Small or unknown sizes are left to Spark.
    """
    n = -(-sum(map(estimated_bytes, frames)) // task_bytes)
    if not 8 < n <= MOST_PARTITIONS:
        return list(frames)
    return [f.repartition(n, on) for f in frames]


def semi_restrict(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key appears in ``keys`` (no fan-out, no distinct needed)."""
    return df.join(keys, on, "left_semi")


def anti_restrict(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``keys`` (``NOT EXISTS``; NULL keys kept)."""
    return df.join(keys, on, "left_anti")


# Prefix of the stand-in keys; real keys never start with a control character.
_NO_MATCH = "\u0001"


def spread_key(key: Column, salt: Column, blank: bool = False) -> Column:
    """Join key for the left side of an outer join whose key is often missing.

    A shuffled join hashes every NULL key to the same partition, so rows
    without a key (reservations without an order, requisitions without a
    purchase order) would pile up in one task. Missing keys become a
    per-row stand-in that matches nothing, which spreads those rows over all
    partitions; the join result is unchanged because NULL never matched.
    ``blank=True`` also spreads blank keys: use it only where the right side
    has no blank keys, so blanks could not have matched either.
    ``salt`` must be deterministic (a row key), so recomputed partitions
    produce the same stand-ins.
    """
    missing = key.isNull() | (F.trim(key) == "") if blank else key.isNull()
    return F.when(missing, F.concat(F.lit(_NO_MATCH), salt.cast("string"))).otherwise(key)


def unspread(key) -> Column:
    """The key that :func:`spread_key` was made of."""
    c = F.col(key) if isinstance(key, str) else key
    return F.when(~c.startswith(_NO_MATCH), c)


_SALTS = 64


def salted_join(df: DataFrame, lookup: DataFrame, key: Column, on: str, salt: Column) -> DataFrame:
    """``df`` left-joined with a lookup (one row per ``on``) whose blank key is hot.

    NULL keys get stand-ins that match nothing, as in :func:`spread_key`. Rows
    with a blank key are dealt to _SALTS keys, and the lookup's row of the
    blank key, if it has one, is repeated for each of them. ``on`` is dropped.
    """
    blank = F.trim(F.col(on)) == ""
    salts = F.transform(F.sequence(F.lit(0), F.lit(_SALTS - 1)), lambda i: F.concat(F.lit("\u0002"), i.cast("string")))
    keys = F.when(blank, salts).otherwise(F.array(F.col(on)))
    right = lookup.withColumn("__salted", F.explode(keys)).drop(on)
    nth = F.pmod(F.xxhash64(salt), F.lit(_SALTS)).cast("string")
    left = F.when(F.trim(key) == "", F.concat(F.lit("\u0002"), nth)).otherwise(spread_key(key, salt))
    return df.withColumn("__salted", left).join(right, "__salted", "left").drop("__salted")
