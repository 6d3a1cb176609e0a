"""Session settings shared by jobs, tests and the bench.

Everything here is a plain SparkSession config.  On a cluster the session is
created by the platform; ``configure`` sets what results depend on (REQUIRED)
and leaves the cluster's own choices (shuffle partitions, checkpoint folder) alone.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on for correct results (time zone, ANSI casts)
# and for the plans we want (AQE re-planning, skew split, dynamic overwrite).
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Sizing for large inputs, applied only where the cluster left them unset:
# start with many shuffle partitions and let AQE coalesce them towards the
# advisory size, so partitions fit executor memory whatever the scale.
SIZING = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
}


def configure(spark: SparkSession, sizing: bool = False) -> SparkSession:
    """Set the settings results depend on; with ``sizing`` also the large-input
    sizing defaults (never overriding values the cluster already set)."""
    for k, v in REQUIRED.items():
        spark.conf.set(k, v)
    if sizing:
        for k, v in SIZING.items():
            if spark.conf.get(k, None) in (None, ""):
                spark.conf.set(k, v)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "racelake") -> SparkSession:
    """Session for tests and the local bench (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call-site capture for error messages costs several JVM round trips
        # per column expression while plans are built
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in REQUIRED.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_CKPT: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local master (tests) may run without it; a scratch folder is made then.
    On a cluster such a folder would be invisible to the other machines, so an
    unset ``spark.checkpoint.dir`` is an error there.
    """
    app = spark.sparkContext.applicationId
    if app in _CKPT:
        return _CKPT[app]
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="racelake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    _CKPT[app] = d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint dir for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)
