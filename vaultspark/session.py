"""Session helpers.

Library code never creates its own session; it takes the caller's.  These
helpers are for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Local session with the settings the operators are written against.

    On a cluster, pass the cluster's own session instead; the only setting the
    operators rely on is ANSI mode (the Spark 4 default) so that bad casts fail.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName("vaultspark")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def single_jvm(master: str) -> bool:
    """Whether driver and executors are one process (``local``, ``local[8]``, ``local[*,3]``; not ``local-cluster``)."""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession, purpose: str | None = None) -> str:
    """Folder on the cluster's shared storage for checkpoints and written tables.

    Uses ``spark.checkpoint.dir`` from the session.  Only when it is unset and the
    master is a single local JVM (a test run) is a local folder created and
    registered as the checkpoint directory; anywhere else that is an error, as
    executors would write to disks of their own.  With ``purpose`` a fresh sub-folder is returned, so runs never
    clear or overwrite each other's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext; the server owns the setting
        sc = None
    if not base and sc is not None:
        base = sc.getCheckpointDir()
    if not base:
        if sc is None or not single_jvm(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="vaultspark-")
        sc.setCheckpointDir(base)
    elif sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    base = base.rstrip("/")
    if purpose is None:
        return base
    return f"{base}/vaultspark/{purpose}-{uuid.uuid4().hex}"
