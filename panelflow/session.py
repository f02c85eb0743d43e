"""Session construction and the shared staging folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app_name: str = "panelflow",
                shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Session with the settings every operator here assumes.

    UTC pins naive feed timestamps (the reference left the zone to the
    machine). AQE re-plans joins and coalesces partitions at run time, and
    splits skewed join partitions.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.sources.partitionOverwriteMode", "dynamic"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # Listing many day folders runs as a Spark job with one task per path up
    # to this bound (default 10,000): size it to the cluster instead.
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism",
                   str(min(10_000, max(32, 4 * cores))))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Read from the session. Only a local session without one (tests) gets a
    folder made here; on a cluster a machine-local folder would lose rows,
    so that raises.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder every machine shares (master {master})")
        d = tempfile.mkdtemp(prefix="panelflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared folder for staged writes."""
    return f"{shared_dir(spark)}/panelflow-stage/{name}-{uuid.uuid4().hex}"
