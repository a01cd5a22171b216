"""Session construction and lineage-cut helpers."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: ANSI casts, UTC wall clock, AQE with skew
# splitting, and parquet pushdown (all defaults in Spark 4, stated explicitly).
_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # AQE may replace a sort-merge join by a shuffled hash join when every
    # post-shuffle partition of the build side is under this size: no sort of
    # the (wide) stream side, and the per-task hash map stays bounded.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Keep compiled whole-stage classes across stages and reports: the
    # pipelines share many identical stage shapes (scans, lookups, ranking).
    "spark.sql.codegen.cache.maxEntries": "2000",
}


def build_session(master: str | None = None, app: str = "fleetyard",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session with the settings the reports assume.

    On a cluster pass ``master=None`` and let spark-submit decide; tests and
    the bench pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.ui.enabled", "false")
        conf.setdefault("spark.ui.showConsoleProgress", "false")
        conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, total_cores: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a large cluster run.

    Shuffle partitions follow the input volume (about ``target_partition_bytes``
    per task, at least two waves of the cluster's cores), AQE then coalesces
    small partitions and splits skewed ones; scan splits use the same target
    so every task's input fits comfortably in executor memory and spills
    rather than fails when a key is hot.
    """
    parts = -(-int(input_bytes) // target_partition_bytes)
    parts = max(2 * total_cores, parts)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when the session names none (local tests) do we set one of our own,
    under a fresh temporary folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: the server owns the folder
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = sc.master if sc is not None else ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="fleetyard-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def materialize(df: DataFrame, name: str = "part") -> tuple[DataFrame, str]:
    """Write ``df`` below the shared folder and read it back; the caller gives
    the folder to :func:`discard` when nothing needs it any more."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that :func:`materialize` wrote."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: materialises ``df`` in the shared checkpoint folder
    so recomputation after an executor loss re-reads it instead of replaying
    (possibly non-deterministic) upstream stages."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
