"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(app: str = "recurra", cpus: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # rows hashed on the account may join on (account, month) without another shuffle
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster.

    Only a ``local`` master may fall back to the machine's temporary folder.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    path = os.path.join(tempfile.gettempdir(), f"recurra-{os.getpid()}")
    os.makedirs(path, exist_ok=True)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is ever overwritten there."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def reliable_checkpoint(df):
    """Cut lineage through the reliable (replicated) checkpoint folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
