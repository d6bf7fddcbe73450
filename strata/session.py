"""Spark session helpers.

The library never hard-codes cluster sizing.  ``build_session`` is for tests,
the bench and local runs; on a cluster the session comes from the submitter
and only the settings the operators rely on are checked with ``ensure_defaults``.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every operator in this package assumes.
#  - ANSI mode: strict timestamp parsing (P3) raises instead of returning null.
#  - UTC session zone: month labels never shift with the driver's zone.
#  - AQE: runtime broadcast conversion (a measured-size broadcast with a
#    shuffle join as the fallback), partition coalescing and skew-join splits.
REQUIRED_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "strata",
    shuffle_partitions: int = 8,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Local/test session with the settings of ``REQUIRED_CONF``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(REQUIRED_CONF)
    conf.update(
        {
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        }
    )
    conf.update(extra_conf or {})
    # Only a local session gets a folder of this machine; a submitted one names
    # its own, or ``ensure_checkpoint_dir`` raises.
    if (master or "").startswith("local") and "spark.checkpoint.dir" not in conf and _active_checkpoint_dir() is None:
        conf["spark.checkpoint.dir"] = _scratch_dir("strata-ckpt-")
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_defaults(spark)
    return spark


def cluster_settings(
    input_bytes: int,
    total_cores: int,
    target_partition_bytes: int = 256 * 1024 * 1024,
    shuffle_fraction: float = 0.25,
    max_partitions: int = 100_000,
) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of Parquet.

    The shuffled volume is taken as ``shuffle_fraction`` of the input (scans
    read only the needed columns and aggregates combine on the map side).
    Shuffle partitions start at one per ``target_partition_bytes`` of it, at
    least two waves of the cores and at most ``max_partitions`` (map-status
    memory on the driver grows with the count); AQE then coalesces them to
    the advisory size, so one setting serves a small and a 100 TB run.  A
    partition above 5x the median and twice the target counts as skewed and
    is split by AQE.
    """
    shuffle_bytes = int(input_bytes * shuffle_fraction)
    wanted = -(-shuffle_bytes // target_partition_bytes)
    shuffle = min(max(2 * total_cores, wanted), max(max_partitions, 2 * total_cores))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def ensure_defaults(spark: SparkSession) -> None:
    """Apply the runtime SQL settings the operators rely on."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)


def _scratch_dir(prefix: str) -> str:
    base = os.environ.get("STRATA_SCRATCH") or tempfile.gettempdir()
    return tempfile.mkdtemp(prefix=prefix, dir=base)


def _active_checkpoint_dir() -> str | None:
    active = SparkSession.getActiveSession()
    if active is None:
        return None
    return active.sparkContext.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object store)
    folder and is used as is.  Only where it is unset (tests, local runs) a
    scratch folder is created.  ``localCheckpoint`` is never used: lineage is
    cut with reliable ``checkpoint()`` or a written stage table.
    """
    sc = spark.sparkContext
    active = sc._jsc.sc().getCheckpointDir()
    if active.isDefined():
        # Already set (setCheckpointDir adds a fresh sub-folder per call, so
        # it is called once only).
        return active.get()
    current = sc.getConf().get("spark.checkpoint.dir", None)
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        current = _scratch_dir("strata-ckpt-")
    sc.setCheckpointDir(current)
    return sc._jsc.sc().getCheckpointDir().get()
