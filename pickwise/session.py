"""Session helpers: a local session for tests/bench and the shared scratch folder.

Library operators never build a session themselves; they take DataFrames.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pickwise") -> SparkSession:
    """Session for tests and the local benchmark (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("PICKWISE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    The checkpoint directory comes from the session (``spark.checkpoint.dir`` or
    the context's checkpoint dir).  When neither is set, a single-machine session
    gets a temporary folder; any other session fails, because executors would not
    see each other's files.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="pickwise-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    leaf = f"{name or 'scratch'}-{uuid.uuid4().hex[:12]}"
    return base.rstrip("/") + "/" + leaf
