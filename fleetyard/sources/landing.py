"""Landing zone: write source tables as Parquet laid out for pruning.

Reports filter the big tables on text dates and code lists; sorting each
file on that column gives tight row-group min/max statistics, so the pushed
filters (``PushedFilters`` in the scan) skip row groups instead of decoding
them. Used by the benchmark to land the derived test tables once, as a
replica extract would be landed in production.
"""
from __future__ import annotations

from pyspark.sql import SparkSession

from fleetyard.sources.tables import CatalogTables, ParquetTables

# table -> column the reports filter on (sort key inside each file)
SORT_KEYS = {
    "aufk": "erdat", "eban": "badat", "ekko": "bedat", "resb": "lgort", "ekbe": "vgabe",
    "relatorio_entrada_saida_uca": "created_at_form", "hourmeter": "event_datetime",
    "hourmeter_invalid": "event_datetime", "swwwihead": "wi_cd", "jest": "stat",
}


# Keys that part the rows of one filter value: a value that a third of the
# rows have (a history type, a status, a location) is cut by these.
ROW_KEYS = {"resb": ("rsnum", "rspos"), "ekbe": ("ebeln", "ebelp"), "jest": ("objnr",), "swwwihead": ("wi_id",)}


def _spread(df, n: int, key: str, name: str | None = None):
    more = [c for c in ROW_KEYS.get(name, ()) if c in df.columns]
    return df.repartitionByRange(n, key, *more)


def land(spark: SparkSession, src, names, root: str, files_per_table: int | None = None) -> ParquetTables:
    """Write ``src.table(name)`` for every name under ``root/name``."""
    n = files_per_table or max(1, spark.sparkContext.defaultParallelism)
    for name in names:
        df = src.table(name)
        key = SORT_KEYS.get(name)
        if key:
            df = _spread(df, n, key, name).sortWithinPartitions(key)
        df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")
    return ParquetTables(spark, root)


# Order-keyed tables joined with each other on the order number by the work
# order, reservation and parts reports: bucketed alike, they join in place.
BUCKET_KEYS = {"aufk": "aufnr", "afih": "aufnr", "afko": "aufnr", "resb": "aufnr"}


def land_bucketed(spark: SparkSession, src, names, database: str, location: str,
                  buckets: int) -> CatalogTables:
    """Write the tables into a catalog database; the order-keyed tables are
    bucketed and sorted by order number with the same bucket count."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for name in names:
        df = src.table(name)
        w = df.write.mode("overwrite").format("parquet")
        key = BUCKET_KEYS.get(name)
        if key:
            # one task writes a whole bucket: one file each, sorted
            w = df.repartition(buckets, key).write.mode("overwrite").format("parquet")
            w = w.bucketBy(buckets, key).sortBy(key)
        elif SORT_KEYS.get(name):
            w = _spread(df, buckets, SORT_KEYS[name], name).sortWithinPartitions(
                SORT_KEYS[name]).write.mode("overwrite").format("parquet")
        w.saveAsTable(f"{database}.{name}")
    return CatalogTables(spark, database)
