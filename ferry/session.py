"""Session helpers.

Scratch output (landed files of demos and tests) lives below the checkpoint
folder the cluster names in ``spark.checkpoint.dir``: it is shared by all
executors, so lost executors never take landed data with them. Only when no
such folder is configured *and* Spark runs in local mode (tests, the bench) do
we create one under ``/tmp``.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_OWN_CHECKPOINT_ROOT: str | None = None


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "ferry",
                  driver_memory: str = "16g", max_partition_bytes: str = "16m") -> SparkSession:
    """A local session configured the way the library expects a cluster to be.

    ``max_partition_bytes`` is small here so a few cores share a small landed
    file; on a cluster keep Spark's 128 MB (or more) so tasks stay few and large.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.files.maxPartitionBytes", max_partition_bytes)
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="ferry-warehouse-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session (set one only in local mode)."""
    global _OWN_CHECKPOINT_ROOT
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder (HDFS / object store) for it")
    if _OWN_CHECKPOINT_ROOT is None:
        _OWN_CHECKPOINT_ROOT = tempfile.mkdtemp(prefix="ferry-ckpt-", dir="/tmp")
    sc.setCheckpointDir(_OWN_CHECKPOINT_ROOT)
    return sc.getCheckpointDir() or _OWN_CHECKPOINT_ROOT


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path in this application's shared scratch area for one landed data set."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/ferry-scratch/{spark.sparkContext.applicationId}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch area; call it when no DataFrame reads from there any more."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers of any executor (once per Spark application)."""
    sc = spark.sparkContext
    if getattr(sc, "_ferry_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    made = os.path.join(tempfile.mkdtemp(prefix="ferry-package-"), "ferry.zip")  # Spark copies it to the executors
    with zipfile.ZipFile(made, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("ferry", os.path.relpath(path, root)))
    sc.addPyFile(made)
    sc._ferry_shipped = True
