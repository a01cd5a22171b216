"""Delivery: JSON encoding of report rows, fixed-size batch envelopes and
snapshot writes.

Batches are numbered without a single-partition step: the report is range
partitioned on its (total) delivery order and sorted inside each partition;
the assignment is written to the shared checkpoint folder, so a lost executor
cannot renumber rows and the report is computed once; per-partition counts
(one row per partition) give each partition its offset. A batch then holds at
most ``size`` rows, so the per-batch ``collect_list`` is bounded. ``deliver``
removes the written rows when the batches are out.
"""
from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetyard.session import discard, materialize

BATCH_ROWS = 2000
_LOW33 = (1 << 33) - 1


def _iso_ts(c: Column, with_tz: bool) -> Column:
    """``datetime.isoformat()``: microseconds only when non-zero; ``+00:00``
    appended for naive values when ``with_tz``."""
    base = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(c, "SSSSSS")
    s = F.concat(base, F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(F.lit("")))
    if with_tz:
        s = F.concat(s, F.lit("+00:00"))
    return F.when(c.isNotNull(), s)


def encode(c: Column, t: T.DataType, style: str = "runner") -> Column:
    """Render one value the way the delivery expects.

    ``runner``: timestamps ISO with ``+00:00`` when naive, dates ISO, decimals
    as text. ``legacy_yard``: dates become midnight UTC timestamps.
    ``legacy_receipts``: timestamps ISO without zone, decimals as numbers.
    """
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return _iso_ts(c, with_tz=style != "legacy_receipts")
    if isinstance(t, T.DateType):
        return (_iso_ts(c.cast("timestamp_ntz"), True) if style == "legacy_yard"
                else F.date_format(c, "yyyy-MM-dd"))
    if isinstance(t, T.DecimalType):
        return c.cast("double") if style == "legacy_receipts" else c.cast("string")
    if isinstance(t, T.BinaryType):
        return F.decode(c, "UTF-8")
    return c


def json_columns(df: DataFrame, style: str = "runner") -> DataFrame:
    """All columns of ``df`` encoded with :func:`encode`."""
    return df.select(*[encode(F.col(f.name), f.dataType, style).alias(f.name)
                       for f in df.schema.fields])


def to_json_rows(df: DataFrame, style: str = "runner") -> DataFrame:
    """One JSON object per row (NULL fields kept as ``null``)."""
    enc = json_columns(df, style)
    return enc.select(F.to_json(F.struct(*enc.columns), {"ignoreNullFields": "false"}).alias("json"))


def number_rows(df: DataFrame, order: Sequence[Column], partitions: int | None = None,
                col: str = "__row", total: str | None = None) -> tuple[DataFrame, str]:
    """The numbered rows and the folder they are kept in. 0-based global row number under ``order`` (must be total), computed
    with range partitioning and per-partition offsets (no global window over
    rows). ``total`` names an optional column with the overall row count."""
    n = partitions or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__mid", F.monotonically_increasing_id()))
    ranged, kept = materialize(ranged, "delivery")
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition: these windows and the broadcast are bounded by
    # the partition count, not by the data
    upto = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = counts.select("__pid", (F.sum("__n").over(upto) - F.col("__n")).alias("__off"),
                            F.sum("__n").over(every).alias("__tot"))
    out = ranged.join(F.broadcast(offsets), "__pid")
    out = out.withColumn(col, F.col("__off") + F.col("__mid").bitwiseAND(F.lit(_LOW33)))
    if total:
        out = out.withColumnRenamed("__tot", total)
    return out.drop("__pid", "__mid", "__off", "__tot"), kept


def batch_frame(df: DataFrame, order: Sequence[Column], size: int = BATCH_ROWS) -> tuple[DataFrame, str]:
    """Rows and the folder they are kept in. Rows have their 1-based batch number and batch metadata (``batch``,
    ``total_batches``, ``row_count``, ``total_rows``), all derived from the row
    number and the total: no aggregation over the batches."""
    b, kept = number_rows(df, order, total="total_rows")
    return (b.withColumn("batch", F.floor(F.col("__row") / size) + 1)
            .withColumn("total_batches",
                        F.greatest(F.lit(1), F.ceil(F.col("total_rows") / size)).cast("bigint"))
            .withColumn("row_count", F.least(F.lit(size).cast("bigint"),
                                             F.col("total_rows") - (F.col("batch") - 1) * size))), kept


def to_batches(df: DataFrame, order: Sequence[Column], job: str, started_at: str,
               size: int = BATCH_ROWS, style: str = "runner",
               internal: Sequence[str] = ()) -> tuple[DataFrame, str]:
    """(batch, json) documents and the folder of the rows behind them. One JSON envelope per batch, as the application receives them.

    ``runner``: ``{job, batch (1-based), total_batches, row_count, total_rows,
    started_at, sent_at, rows}``, and one empty batch when there are no rows.
    ``legacy``: ``{started_at, rows, batch_index (0-based), is_last}``, and a
    single ``{started_at, rows: [], is_last: true}`` when there are no rows.
    """
    enc_style = "runner" if style == "runner" else "legacy_receipts"
    payload = [encode(F.col(f.name), f.dataType, enc_style).alias(f.name) for f in df.schema.fields
               if f.name not in internal]
    b, kept = batch_frame(df, order, size)
    b = b.select("__row", "batch", "total_batches", "row_count",
                                            "total_rows", F.struct(*payload).alias("__r"))
    rows = b.groupBy("batch", "total_batches", "row_count", "total_rows").agg(
        F.sort_array(F.collect_list(F.struct("__row", "__r"))).alias("__rs"))
    rows = rows.withColumn("rows", F.transform("__rs", lambda x: x["__r"])).drop("__rs")
    sent = F.lit(_dt.datetime.now(_dt.timezone.utc).isoformat())
    if style == "runner":
        env = F.struct(F.lit(job).alias("job"), F.col("batch"), F.col("total_batches"),
                       F.col("row_count"), F.col("total_rows"), F.lit(started_at).alias("started_at"),
                       sent.alias("sent_at"), F.col("rows"))
        empty = F.struct(F.lit(job).alias("job"), F.lit(1).cast("bigint").alias("batch"),
                         F.lit(1).cast("bigint").alias("total_batches"),
                         F.lit(0).cast("bigint").alias("row_count"),
                         F.lit(0).cast("bigint").alias("total_rows"),
                         F.lit(started_at).alias("started_at"), sent.alias("sent_at"),
                         F.array().cast(rows.schema["rows"].dataType).alias("rows"))
    else:
        env = F.struct(F.lit(started_at).alias("started_at"), F.col("rows"),
                       (F.col("batch") - 1).alias("batch_index"),
                       (F.col("batch") == F.col("total_batches")).alias("is_last"))
        empty = F.struct(F.lit(started_at).alias("started_at"),
                         F.array().cast(rows.schema["rows"].dataType).alias("rows"),
                         F.lit(True).alias("is_last"))
    docs = rows.select(F.col("batch"), F.to_json(env, {"ignoreNullFields": "false"}).alias("json"))
    if b.isEmpty():         # looks at the written rows, not at the report
        docs = df.sparkSession.range(1).select(
            F.lit(1).cast("bigint").alias("batch"),
            F.to_json(empty, {"ignoreNullFields": "false"}).alias("json"))
    return docs, kept


def deliver(df: DataFrame, out_dir: str, order: Sequence[Column], job: str, started_at: str,
            size: int = BATCH_ROWS, style: str = "runner", internal: Sequence[str] = ()) -> None:
    """Write the batches as JSON lines (without the ``internal`` columns) and
    remove the rows kept for numbering."""
    docs, kept = to_batches(df, order, job, started_at, size, style, internal)
    try:
        docs.select("json").write.mode("errorifexists").text(out_dir)
    finally:
        discard(df.sparkSession, kept)


def batch_summary(df: DataFrame, order: Sequence[Column], key: str,
                  size: int = BATCH_ROWS) -> DataFrame:
    """Per batch: number, totals and first / last key (checks the numbering)."""
    b, _ = batch_frame(df, order, size)
    return b.groupBy("batch", "total_batches", "row_count", "total_rows").agg(
        F.min_by(key, "__row").alias("first_key"), F.max_by(key, "__row").alias("last_key"))


def run_log(spark, job: str, started_at: str, error: str | None = None) -> DataFrame:
    """Status row of a run (``{started_at, error}`` envelope when it failed)."""
    return spark.createDataFrame([(job, started_at, error)],
                                 "job string, started_at string, error string")


def write_snapshot(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a snapshot of a report to a folder of its own: a reader of the
    last one is not disturbed, and a failed write leaves it in place."""
    df.write.mode("errorifexists").format(fmt).save(path)
