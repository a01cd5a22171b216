"""Incremental yard state with Structured Streaming.

The source jobs poll the yard events a few times a day and recompute the
latest event per asset. As a stream, the latest event per asset is a keyed
aggregate kept in the state store: ``max(struct(event time, row id, ...))``
picks the newest event (an event without time loses, the row id breaks
ties), exactly like the batch ranking. The stream emits changed assets in
``update`` mode; the sink appends them per micro-batch (idempotent per batch
id) and readers resolve the current row per asset, so an asset whose latest
event becomes an exit correctly leaves the yard.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetyard.operators.keyed import latest_by
from fleetyard.plans.yard import ENTRY
from fleetyard.sources import shared_files as files

PAYLOAD = ["tipo_relatorio", "tipo_equipamento", "marca", "modelo", "cliente", "situacao",
           "horimetro", "filial"]


def latest_event_per_asset(events: DataFrame) -> DataFrame:
    """Latest event per normalised asset code (batch or streaming input)."""
    ev = events.filter(F.col("n_armac").isNotNull())
    last = F.max(F.struct(F.col("created_at_form"), F.col("id"), *[F.col(c) for c in PAYLOAD]))
    return (ev.groupBy(F.upper(F.trim("n_armac")).alias("n_armac")).agg(last.alias("e"))
            .select("n_armac", F.col("e.created_at_form").alias("data_entrada"),
                    F.col("e.id").alias("id"), *[F.col(f"e.{c}").alias(c) for c in PAYLOAD]))


def in_yard(state: DataFrame) -> DataFrame:
    """Current yard rows from the latest-event state."""
    return state.filter(F.lower(F.trim("tipo_relatorio")) == ENTRY).select(
        "n_armac", F.col("tipo_equipamento").alias("equipamento"),
        F.upper(F.trim("marca")).alias("marca"), F.upper(F.trim("modelo")).alias("modelo"),
        "cliente", "situacao", "data_entrada", F.col("horimetro").alias("horimetro"),
        "filial")


def start(spark: SparkSession, source_dir: str, schema, sink_dir: str, checkpoint: str,
          trigger: dict | None = None) -> StreamingQuery:
    """Run the stream from a folder of event files into an append-only change
    log partitioned by micro-batch id (rewritten whole on a retried batch)."""
    events = spark.readStream.schema(schema).parquet(source_dir)

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .parquet(f"{sink_dir.rstrip('/')}/batch_id={batch_id}"))

    w = (latest_event_per_asset(events).writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint).foreachBatch(write))
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def _log(spark: SparkSession, sink_dir: str) -> tuple[DataFrame, int | None]:
    """The change log: the compacted state, if there is one, and the batches after it;
    and the last batch. Batches are told by their folder's name."""
    home = sink_dir.rstrip("/")
    base = [n for n in files.names(spark, f"{home}/_base") if n.endswith(".json") and not n.startswith("_")]
    record = files.read_record(spark, f"{home}/_base/{base[-1]}") if base else {"upto": -1, "folder": None}
    batches = sorted(int(n.partition("=")[2]) for n in files.names(spark, home) if n.startswith("batch_id="))
    later = [b for b in batches if b > record["upto"]]
    parts = [spark.read.parquet(record["folder"])] if record["folder"] else []
    parts += [spark.read.parquet(*[f"{home}/batch_id={b}" for b in later])] if later else []
    if not parts:
        raise FileNotFoundError(f"no change log in {sink_dir}")
    parts = [p.withColumn("batch_id", F.lit(-1)) if "batch_id" not in p.columns else p for p in parts]
    log = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return log, (later or [record["upto"]])[-1]


def compact(spark: SparkSession, sink_dir: str) -> int:
    """Replace the batches so far by the newest row of each asset; the last of them.

    The log's size then follows the number of assets. Later batches may be
    written meanwhile. The state is entered by record before batches go, and
    batches that it covers are not read any more.
    """
    home = sink_dir.rstrip("/")
    log, upto = _log(spark, sink_dir)
    folder = f"{home}/_state/{upto:010d}-{uuid.uuid4().hex}"
    latest_by(log, "n_armac", [F.col("batch_id").desc()]).write.parquet(folder)
    older = files.names(spark, f"{home}/_state")
    if not files.write_record(spark, f"{home}/_base/{upto:010d}.json", {"upto": upto, "folder": folder}):
        files.remove(spark, folder)           # compacted up to here already
        return upto
    for name in files.names(spark, home):
        if name.startswith("batch_id=") and int(name.partition("=")[2]) <= upto:
            files.remove(spark, f"{home}/{name}")
    for name in older:
        if f"{home}/_state/{name}" != folder:
            files.remove(spark, f"{home}/_state/{name}")
    return upto


def current_yard(spark: SparkSession, sink_dir: str) -> DataFrame:
    """Resolve the change log: newest state row per asset, then keep entries."""
    state = latest_by(_log(spark, sink_dir)[0], "n_armac", [F.col("batch_id").desc()])
    return in_yard(state)
