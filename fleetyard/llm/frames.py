"""Small helpers shared by the operators: reading, batches, scratch tables."""
from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetyard.session import checkpoint_dir, discard

# A batch that crosses to Python holds at most about this many bytes, or one longer row.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 2000
_BYTES_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Hold the session's Arrow batches to BATCH_BYTES, unless it has a limit of its own."""
    given = spark.conf.get(_BYTES_KEY, None)
    if given is None or given.lstrip("-").isdigit() and not 0 < int(given) < 1 << 31:
        spark.conf.set(_BYTES_KEY, str(BATCH_BYTES))


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):          # another C library
    def _trim(pad: int) -> int:
        return 0


def give_back() -> None:
    """Return memory that Arrow and numpy have freed to the system: a worker is reused
    by later stages, and a freed heap would otherwise stay with it."""
    pa.default_memory_pool().release_unused()
    _trim(0)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the whole text (UTF-8 bytes) of every row, whatever else the frame has."""
    bounded_batches(docs.sparkSession)
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.encode(docs[text_col], "UTF-8").alias("text"))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch | None],
                schema: str) -> DataFrame:
    """mapInArrow with a function on single batches, in slices of BATCH_ROWS rows."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                out = fn(batch.slice(at, BATCH_ROWS))
                if out is None:
                    continue
                if isinstance(out, pa.RecordBatch):
                    yield out
                else:
                    yield from out

    return map_stream(df, run, schema)


def map_stream(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow over bounded batches; freed memory is given back before each."""
    bounded_batches(df.sparkSession)

    def run(batches):
        def given():
            for batch in batches:
                yield batch
                give_back()

        yield from fn(given())
        give_back()

    return df.mapInArrow(run, schema)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones that no column of ``df`` has (whatever the case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written table, below the cluster's shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, kept: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage is cut,
    and lost executors cost a re-read instead of a recomputation. The folder
    is added to ``kept``, for ``remove``."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    if kept is not None:
        kept.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, kept: list[str]) -> None:
    """Delete written tables that nothing reads any more."""
    while kept:
        discard(spark, kept.pop())


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nothing refers to any more: it does so
    when the driver collects garbage, which a driver with memory to spare may not do for long."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
