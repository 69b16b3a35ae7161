"""Session helpers: one place for the configuration the engine relies on."""

from __future__ import annotations

import os
import re
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from stakeflow.errors import ArtifactError


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "stakeflow") -> SparkSession:
    """Return a session configured for local tests / benches.

    On a cluster the session is normally created by the launcher; this helper
    only fills in settings that are unset.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("STAKEFLOW_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # drop reliable-checkpoint files once their DataFrames are garbage collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    It is the session's ``spark.checkpoint.dir``; where that is unset, a folder
    below ``spark.sql.warehouse.dir`` in local sessions (tests).  On any other
    master it has to be set: executors cannot see a folder of the driver's machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", sc.master):
            raise ArtifactError("Set spark.checkpoint.dir to a folder that the driver and all executors share.")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def at_once(spark: SparkSession, run, parts) -> list:
    """``run(part)`` for a handful of independent parts, their Spark jobs side by side; results in the parts' order."""
    parts = list(parts)
    with ThreadPoolExecutor(max(1, min(len(parts), 4))) as pool:
        # each thread has local properties of its own
        held = [pool.submit(inheritable_thread_target(spark)(partial(run, p))) for p in parts]
        return [h.result() for h in held]


def shared_path(spark: SparkSession, name: str) -> str:
    """A path inside the checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)
