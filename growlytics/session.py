"""Session construction and the shared scratch folder.

On a cluster the session comes configured: the shared folder for lineage
cuts, stream checkpoints and landing files is ``spark.checkpoint.dir``.  Only
when it is unset (local tests, the bench) do we create one under ``/tmp``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "growlytics") -> SparkSession:
    """A local session with the settings the operators assume.

    AQE coalesces small shuffles and splits skewed join partitions; the
    session time zone is pinned to UTC so timestamps compare with DuckDB.
    """
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="growlytics-wh-"))
        .config("spark.driver.memory", os.environ.get("GROWLYTICS_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Settings for a large cluster (100 TB class inputs).  AQE sizes the shuffle
# partitions at run time from the statistics of the map stage, so the initial
# number only has to be large enough for the biggest shuffle; skewed join
# partitions are split; broadcasts stay under a checked size.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.session.timeZone": "UTC",
}


def apply_cluster_conf(spark: SparkSession, overrides: dict | None = None) -> None:
    """Set the runtime-modifiable SQL settings above on an existing session
    (cluster-level settings such as memory come from the deployment)."""
    for k, v in {**CLUSTER_CONF, **(overrides or {})}.items():
        spark.conf.set(k, v)


_OVERRIDE: dict[str, str] = {}


def use_shared_base(spark: SparkSession, path: str) -> None:
    """Use ``path`` as this application's shared folder (e.g. a fresh
    sub-folder for a benchmark run).  ``spark.checkpoint.dir`` itself cannot
    change once the context is up."""
    _OVERRIDE[spark.sparkContext.applicationId] = path


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder: ``spark.checkpoint.dir`` from the session
    (the cluster's shared storage), else the context's checkpoint dir, else
    a local temporary folder.  The last is for a local master only: on a
    cluster a missing setting is an error, as no machine's own folder is
    seen by the others."""
    app = spark.sparkContext.applicationId
    if app in _OVERRIDE:
        return _OVERRIDE[app]
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc_dir = spark.sparkContext.getCheckpointDir()
    path = conf_dir or sc_dir
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the driver and all executors")
        path = tempfile.mkdtemp(prefix="growlytics-ckpt-")
        _OVERRIDE[app] = path
    if not sc_dir:
        spark.sparkContext.setCheckpointDir(path)
    return path


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh sub-folder of the shared folder (unique per call)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts, uuid.uuid4().hex])


def checkpointed(df):
    """Cut lineage with a reliable checkpoint into the shared checkpoint
    folder, computing ``df`` once: it is persisted while the checkpoint is
    written (otherwise writing the files recomputes it) and released after.
    Meant for small intermediate results that several consumers read."""
    from pyspark import StorageLevel

    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()
