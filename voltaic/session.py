"""Session construction and the few session settings the pipelines rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every pipeline assumes.  Time buckets (hour/day/month) are defined
# in UTC, as the reference stores TIMESTAMPTZ and truncates in UTC.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings that help at scale; applied only when the caller has not chosen.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str = "local[*]", app: str = "voltaic",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """A local session for tests and benches.  On a cluster, use the
    session the platform gives you and call :func:`ensure_defaults`."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("VOLTAIC_DRIVER_MEMORY", "16g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**DEFAULT_CONF, **REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_defaults(spark)
    return spark


def recommended_conf(shuffle_bytes: int, total_cores: int,
                     target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing for a cluster run whose largest shuffle moves ``shuffle_bytes``.

    Reports shuffle partial aggregates, not their input, so this is far below the table size;
    a full-table rewrite is the exception.

    * scan splits of ``target_partition_bytes`` (files.maxPartitionBytes);
    * an initial shuffle partition count large enough that no shuffle
      partition of a full-table shuffle exceeds the target (AQE coalesces the
      small ones back, and splits skewed ones in joins), rounded up to a
      multiple of the core count so waves are full;
    * AQE's advisory size set to the same target.
    """
    n = max(total_cores, -(-int(shuffle_bytes) // target_partition_bytes))
    n = -(-n // total_cores) * total_cores
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def ensure_defaults(spark: SparkSession) -> SparkSession:
    """Pin the required settings on an existing session (idempotent)."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged writes.

    ``spark.checkpoint.dir`` of the session, else a checkpoint folder that was already set on
    the context.  Without either, a scratch folder is made for a local master only: on a
    cluster the executors could not see it, so that raises.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="voltaic-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder."""
    import uuid
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
