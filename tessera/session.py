"""SparkSession construction and checkpoint-directory handling.

On a cluster the session comes from the launcher and already names a shared
``spark.checkpoint.dir``; we only read it.  Local runs (tests, bench) get a
session built here and a fresh scratch checkpoint folder when none is set.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera") -> SparkSession:
    """Local session with AQE on, UI off and UTC time (for oracle parity)."""
    master = master or os.environ.get("TESSERA_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a scratch one only if unset.

    A cluster launcher sets ``spark.checkpoint.dir`` to shared storage; that
    value always wins.  Only a local session without one (tests) gets a fresh
    folder: on a cluster a machine's own folder would lose the files to other
    executors, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current
