"""What changed between two versions of a table, key by key, in one shuffle.

Both sides go to one grouping by the key; no join and no second pass. Values
are compared NULL-safe, column by column. A key that a side has more than once
cannot be paired: it is reported as ``repeated`` with the greatest row of each side.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INSERT, DELETE, UPDATE, SAME, REPEATED = "insert", "delete", "update", "same", "repeated"


def keyed_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """The keys, op, changed (names of changed columns), old and new (structs of ``columns``).

    ``columns``: those compared, by default all but the keys that both sides have.
    """
    if columns is None:
        columns = [c for c in new.columns if c in old.columns and c not in keys]
    for c in [*keys, *columns]:
        if old.schema[c].dataType != new.schema[c].dataType:
            raise TypeError(f"column {c} is {old.schema[c].dataType.simpleString()} and {new.schema[c].dataType.simpleString()}")

    def side(df: DataFrame, n: int) -> DataFrame:
        # (columns,) in a struct of its own: a row of NULLs is a row too
        row = F.struct(F.lit(True).alias("there"), *columns)
        return df.select(*keys, *[(row if i == n else F.lit(None)).alias(f"s{i}") for i in (0, 1)])

    empty = side(old, 0).schema["s0"].dataType
    both = side(old, 0).withColumn("s1", F.col("s1").cast(empty)).unionByName(side(new, 1).withColumn("s0", F.col("s0").cast(empty)))
    g = both.groupBy(*keys).agg(F.max("s0").alias("a"), F.max("s1").alias("b"), F.count("s0").alias("n0"), F.count("s1").alias("n1"))
    changed = F.filter(F.array(*[F.when(~F.col("a")[c].eqNullSafe(F.col("b")[c]), F.lit(c)) for c in columns])
                       if columns else F.array().cast("array<string>"), lambda x: x.isNotNull())
    op = (F.when((F.col("n0") > 1) | (F.col("n1") > 1), REPEATED).when(F.col("n0") == 0, INSERT)
          .when(F.col("n1") == 0, DELETE).when(F.size("changed") > 0, UPDATE).otherwise(SAME))
    paired = (F.col("n0") == 1) & (F.col("n1") == 1)
    g = g.withColumn("changed", F.when(paired, changed).otherwise(F.array().cast("array<string>")))
    return g.select(*keys, op.alias("op"), "changed", F.col("a").dropFields("there").alias("old"),
                    F.col("b").dropFields("there").alias("new"))


def change_counts(diff: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(what, n): how many keys had each op, and how many a change in each column; zeros too."""
    names = [INSERT, DELETE, UPDATE, SAME, REPEATED]
    aggs = [F.count_if(F.col("op") == n).alias(n) for n in names]
    aggs += [F.count_if(F.array_contains("changed", c)).alias(f"column {c}") for c in columns]
    wide = diff.agg(*aggs)
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("what"), F.col(f"`{c}`").alias("n")) for c in wide.columns]))
                       .alias("x")).select("x.*")
