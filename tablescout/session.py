"""Session helpers: the library always takes the caller's session."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder the cluster names.

    Reads the context's checkpoint directory or ``spark.checkpoint.dir``.
    Only a local-mode session (tests, single machine) may fall back to a
    temporary folder; on a cluster an unset directory is an error, since a
    machine-local folder would not survive the loss of that machine.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context on the client; the server's conf decides
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if not conf:
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        return conf
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if fallback is None and not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        conf = fallback or tempfile.mkdtemp(prefix="tablescout-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session configured the way tests and the bench use it."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tablescout")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
