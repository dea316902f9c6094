"""Spark session and shared-storage helpers.

Every job in the library runs on whatever session the caller hands in; this
module only builds a session for tests, the bench and the command line, and
resolves the shared checkpoint folder that lineage cuts are written to.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

from .operators.joins import parse_bytes

# Settings the warehouse jobs are designed around.  AQE re-plans joins from
# measured shuffle sizes (runtime broadcast, partition coalescing, skew
# splitting); the static broadcast threshold only ever sees Catalyst's upper
# bound estimates, so a side is broadcast only when its size is bounded.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "strata", cpus: int | str = "*", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (a cluster passes its own)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("STRATA_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only a local session without the
    setting (tests) gets a fresh scratch folder; on a cluster a missing setting
    is an error, because a machine-local folder does not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-ckpt-"))
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


PARTITION_BYTES = 16 << 20  # shuffled bytes that AQE puts together for one task, at most


def bound_partitions(spark: SparkSession) -> None:
    """Adaptive execution joins small shuffle partitions up to its advisory size.  Narrow sorted
    rows compress well: the default 64 MB are gigabytes in the sorts and hash tables of one task."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if parse_bytes(spark.conf.get(name)) > PARTITION_BYTES:
        spark.conf.set(name, str(PARTITION_BYTES))
