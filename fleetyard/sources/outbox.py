"""Deliveries that are whole or not there, and recognised when sent again.

A delivery is written in two steps. Batches go to a draft folder through Spark's
own committer (a task that is killed leaves nothing); a manifest then lists every
batch with its row count and checksum, and the draft folder is renamed to the
delivery's name. Readers look at named deliveries only, so one that was cut off
is never seen.

The name is taken from what is delivered: a checksum over the rows, whatever
order they were computed in, the job and its cut into batches. The same
rows sent again get the same name and are not written a second time; every
envelope carries the name and its batch number, so a receiver can tell a batch it
has had.
"""
from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetyard.session import discard
from fleetyard.sources import shared_files as files
from fleetyard.sources.delivery import BATCH_ROWS, batch_frame, encode, json_columns


@dataclass(frozen=True)
class Sent:
    delivery: str
    folder: str
    repeated: bool


def _row_text(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def content_name(rows: DataFrame, columns: Sequence[str], job: str, size: int) -> str:
    """Name of a delivery: job, row count and a sum of row checksums (any order of rows)."""
    h = F.sha2(_row_text(columns), 256)
    halves = [F.sum(F.conv(F.substring(h, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")).alias(f"s{i}") for i in range(4)]
    r = rows.agg(F.count(F.lit(1)).alias("n"), *halves).first()
    text = "/".join(str(x) for x in (job, size, ",".join(columns), *r))
    return rows.sparkSession.range(1).select(F.sha2(F.lit(text), 256)).first()[0][:32]


def send(df: DataFrame, outbox: str, job: str, order: Sequence[Column], size: int = BATCH_ROWS,
         internal: Sequence[str] = ()) -> Sent:
    """Deliver the rows of ``df`` (without the ``internal`` columns) as envelopes of ``size`` rows.

    The report is computed once: numbered rows are kept while name, batches and
    manifest are made from them.
    """
    spark = df.sparkSession
    home = f"{outbox.rstrip('/')}/{job}"
    shown = [c for c in df.columns if c not in internal]
    rows, kept = batch_frame(df, order, size)
    try:
        name = content_name(json_columns(rows.select(*shown)), shown, job, size)
        folder = f"{home}/{name}"
        if files.exists(spark, folder):
            return Sent(name, folder, True)
        draft = f"{home}/_draft-{uuid.uuid4().hex}"
        try:
            _batches(rows, shown, job, name).write.parquet(f"{draft}/batches")
            _manifest(spark.read.parquet(f"{draft}/batches")).write.parquet(f"{draft}/manifest")
            files.write_record(spark, f"{draft}/delivery.json",
                               {"delivery": name, "job": job, "size": size,
                                "sent_at": _dt.datetime.now(_dt.timezone.utc).isoformat()})
            won = files.rename(spark, draft, folder)
        except BaseException:
            files.remove(spark, draft)
            raise
        if not won:                       # somebody sent the same rows meanwhile
            files.remove(spark, draft)
        return Sent(name, folder, not won)
    finally:
        discard(spark, kept)


def _batches(rows: DataFrame, shown: Sequence[str], job: str, name: str) -> DataFrame:
    """(batch, row_count, json): an empty report has one batch without rows."""
    keys = ["batch", "total_batches", "row_count", "total_rows"]
    fields = F.struct(*[encode(F.col(f.name), f.dataType).alias(f.name) for f in rows.schema.fields if f.name in shown])
    grouped = rows.select(*keys, F.struct("__row", fields.alias("r")).alias("x")).groupBy(*keys).agg(
        F.sort_array(F.collect_list("x")).alias("xs")).select(*keys, F.transform("xs", lambda x: x["r"]).alias("rows"))
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    none = rows.sparkSession.range(1).select(one.alias("batch"), one.alias("total_batches"), zero.alias("row_count"),
                                             zero.alias("total_rows"), F.array().cast(grouped.schema["rows"].dataType).alias("rows"))
    envelope = F.struct(F.lit(job).alias("job"), F.lit(name).alias("delivery"), *keys, "rows")
    return (none if rows.isEmpty() else grouped).select(
        "batch", "row_count", F.to_json(envelope, {"ignoreNullFields": "false"}).alias("json"))


def _manifest(batches: DataFrame) -> DataFrame:
    return batches.select("batch", "row_count", F.sha2("json", 256).alias("sha256"))


def deliveries(spark: SparkSession, outbox: str, job: str) -> list[str]:
    """Names of the whole deliveries of a job."""
    return [n for n in files.names(spark, f"{outbox.rstrip('/')}/{job}") if not n.startswith("_")]


def batches(spark: SparkSession, outbox: str, job: str, delivery: str) -> DataFrame:
    """(batch, row_count, json) of a delivery."""
    if delivery not in deliveries(spark, outbox, job):
        raise FileNotFoundError(f"no delivery {delivery} of {job}")
    return spark.read.parquet(f"{outbox.rstrip('/')}/{job}/{delivery}/batches")


def check(spark: SparkSession, outbox: str, job: str, delivery: str) -> DataFrame:
    """Batches that differ from the manifest: (batch, problem); none in a good delivery."""
    folder = f"{outbox.rstrip('/')}/{job}/{delivery}"
    have = _manifest(batches(spark, outbox, job, delivery)).groupBy("batch").agg(
        F.count(F.lit(1)).alias("times"), F.max("row_count").alias("rows"), F.max("sha256").alias("have"))
    want = spark.read.parquet(f"{folder}/manifest").withColumnRenamed("row_count", "want_rows")
    j = want.join(have, "batch", "full_outer")
    problem = (F.when(F.col("have").isNull(), "missing").when(F.col("sha256").isNull(), "not listed")
               .when(F.col("times") > 1, "repeated").when(F.col("have") != F.col("sha256"), "changed"))
    return j.select("batch", problem.alias("problem")).filter("problem IS NOT NULL")
