"""Session helpers for tests, the benchmark and local runs.

Operators never build sessions; these helpers only serve entry points. The
shared working folder comes from the session's ``spark.checkpoint.dir`` (the
cluster names it); a local temporary folder is used only when it is unset.
"""

from __future__ import annotations

import os
import posixpath
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "trafficlens") -> SparkSession:
    """A ``local[cores]`` session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TRAFFICLENS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder (``spark.checkpoint.dir``).

    Only a local-mode session without one (tests) gets a temporary folder; on a
    cluster the folder must be shared storage named by the cluster, so its absence
    is an error rather than a silent machine-local fallback.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage (HDFS, S3, ...)")
        configured = tempfile.mkdtemp(prefix="trafficlens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured


_scratch_roots: set[str] = set()


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the session's shared folder (``spark.checkpoint.dir``).

    All of an application's scratch folders lie under one root, which the Hadoop
    file system deletes when the application ends.
    """
    root = posixpath.join(ensure_checkpoint_dir(spark), "trafficlens", spark.sparkContext.applicationId)
    if root not in _scratch_roots:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _scratch_roots.add(root)
    return posixpath.join(root, *parts, uuid.uuid4().hex)
