"""Session construction and the shared scratch location.

Cluster jobs must not write to a machine-local temp folder: lineage is cut
and intermediate tables are written under the shared folder that the
cluster names in ``spark.checkpoint.dir``.  We read that setting from the
session and only set our own (a local temp folder) where it is unset and the
master is local, as in tests; on a cluster an unset folder is an error.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoint files of dropped DataFrames are removed from the shared folder
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(
    app: str = "tagloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings every job here assumes.

    ``master`` is only set when given: on a cluster the submitter decides it.
    Session time zone is pinned to UTC so epoch <-> date conversions are
    deterministic.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Order: the SparkContext's checkpoint dir, then ``spark.checkpoint.dir``
    from the session conf; only if both are unset and the master is local
    (tests) a fresh local temp folder is made and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception as e:  # noqa: BLE001 — a Spark Connect session has no SparkContext
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share") from e
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not conf_dir:
        # local[...] runs in one process; local-cluster has executors of its own
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tagloom-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    path = os.path.join(root, f"{name}-{uuid.uuid4().hex}")
    _scratch.append(path)
    return path


_scratch: list[str] = []


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders made so far in this process; returns their number.

    For the end of a job: frames that still read them must not be used again.
    """
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _scratch:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def materialize(df):
    """Reliable checkpoint into the shared folder, computed once.

    A reliable checkpoint writes by re-running the plan unless it is
    persisted, so the rows are persisted for the write and released after.
    The result reads the checkpoint files: executor loss after this point
    does not recompute the lineage.
    """
    from pyspark import StorageLevel

    checkpoint_root(df.sparkSession)
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = held.checkpoint(eager=True)
    held.unpersist()
    return out
