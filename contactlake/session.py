"""Spark session settings used by every job in the package.

All times are UTC instants, so the session time zone is pinned to UTC. AQE is
on so that small aggregated sides are broadcast at run time, skewed join
partitions are split and tiny shuffle partitions are coalesced.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove RDD checkpoint files (the median's lineage cut) once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "contactlake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


MIB = 1 << 20


def scale_conf(input_bytes: int) -> dict[str, str]:
    """Shuffle and scan sizing for a job that reads ``input_bytes``.

    * scan splits of 256 MiB (fewer, fuller tasks at 100 TB: ~400k splits);
    * one shuffle partition per 128 MiB of input as AQE's starting point (at least 200),
      coalesced at run time towards 256 MiB, so a shuffle partition fits
      an executor core's memory share and spills rarely;
    * skew join splits a partition 5x the median and over 512 MiB (a hot key);
    * broadcast joins only below an explicit 64 MiB bound measured by AQE at run time.
    """
    parts = max(200, -(-input_bytes // (128 * MIB)))
    return {
        "spark.sql.files.maxPartitionBytes": str(256 * MIB),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MIB),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * MIB),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MIB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MIB),
    }


def input_size(spark: SparkSession, *paths: str) -> int:
    """Bytes under the given paths, summed by the cluster file system (no data read)."""
    jvm = spark.sparkContext._jvm
    total = 0
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(p):
            total += fs.getContentSummary(p).getLength()
    return total


def apply_scale_conf(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    """Set ``scale_conf`` on a running session (all are runtime SQL settings)."""
    conf = scale_conf(input_bytes)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def ensure_utc(spark: SparkSession) -> None:
    """Timestamps are UTC instants; runtime SQL conf, safe to set on any session."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and stage hand-over tables.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset
    (local tests) do we pick a scratch folder of our own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="contactlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    return os.path.join(checkpoint_root(spark), *parts)
