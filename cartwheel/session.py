"""SparkSession construction and the few session settings the engine relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every cartwheel job needs, whatever the cluster:
#  - UTC so that timestamps agree between engines and machines;
#  - duplicate JSON keys resolve "last wins", as Python's json module does;
#  - AQE with skew-join splitting and partition coalescing.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# (Dynamic partition overwrite is set per write by the warehouse writer, not
# on the session, so a caller's own overwrite writes keep their semantics.)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings cartwheel depends on to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "cartwheel") -> SparkSession:
    """A local session for tests and benchmarks (UI off, no server ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CARTWHEEL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system). Only when it is unset — tests, local runs — a scratch
    folder is created and registered.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    try:
        context = spark.sparkContext
    except Exception:      # Spark Connect: no driver-side context
        context = None
    if context is not None:
        configured = context.getConf().get("spark.checkpoint.dir", None)
        if configured:
            return configured
        current = context.getCheckpointDir()
        if current:
            return current
    path = tempfile.mkdtemp(prefix="cartwheel-ckpt-")
    if context is not None:
        context.setCheckpointDir(path)
        return context.getCheckpointDir() or path
    return path
