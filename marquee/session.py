"""Session defaults and the shared scratch location.

Library code never decides where a cluster keeps its files: written
intermediate tables go under the checkpoint directory the cluster names in
``spark.checkpoint.dir`` (or the one already set on the context). Only where
none is set *and* the master is local — tests, one machine — a fresh directory
is created; on a cluster a missing setting is an error.
"""

from __future__ import annotations

import contextlib
import logging
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Session settings the library relies on. AQE re-plans joins and shuffles at
# runtime: it turns a small join side into a broadcast only after measuring
# it, splits skewed join partitions (including the left side of a left outer
# join) and splits or merges ``rebalance`` partitions before a partitioned
# write. Parquet output is Snappy, the reference lake format. How far AQE
# merges small shuffle partitions is left to the cluster.
SESSION_DEFAULTS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    master: str | None = None,
    app_name: str = "marquee",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for local runs, tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _set_by_cluster(spark: SparkSession, key: str) -> bool:
    """True when the cluster (spark-submit ``--conf``, spark-defaults) set
    ``key``. Under Spark Connect the launch configuration is not visible, so
    every key counts as the cluster's and is left alone."""
    try:
        return bool(spark.sparkContext.getConf().contains(key))
    except Exception:
        return True


def apply_session_defaults(spark: SparkSession, defaults: dict[str, str] | None = None) -> None:
    """Set each of the library's session defaults the cluster has not set."""
    for key, value in (SESSION_DEFAULTS if defaults is None else defaults).items():
        if not _set_by_cluster(spark, key):
            spark.conf.set(key, value)


# Shuffle sizing. AQE merges small shuffle partitions but never splits a
# non-skewed one, so the *initial* partition count bounds the largest task:
# 100 TB over the default 200 partitions would be 500 GB per task. When the
# cluster leaves the count unset, it is derived from the input's size.
SHUFFLE_TARGET_BYTES = 256 * 1024 * 1024
_SIZING_KEYS = (
    "spark.sql.shuffle.partitions",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
)


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (a metadata call, no job)."""
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hpath).getLength())


def size_shuffles(
    spark: SparkSession, total_bytes: int, target_bytes: int = SHUFFLE_TARGET_BYTES
) -> int | None:
    """Initial shuffle partition count for ``total_bytes`` of input.

    Only when neither ``spark.sql.shuffle.partitions`` nor AQE's
    ``initialPartitionNum`` was set by the cluster: then one partition per
    ``target_bytes`` of input, at least the session's current count, and AQE
    coalesces down from there. The bytes are those stored: for gzip input,
    which grows several times when read, pass a smaller target. Returns the
    count set, or ``None`` when the cluster's own setting stays.
    """
    if any(_set_by_cluster(spark, k) for k in _SIZING_KEYS):
        return None
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = max(current, -(-max(total_bytes, 0) // target_bytes))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(count))
    return count


def warn_without_adaptive(spark: SparkSession, logger: logging.Logger) -> bool:
    """Log a warning when AQE is off; return whether it is on.

    Without AQE the ``rebalance`` hint of the writers is a plain hash
    repartition and skewed join partitions are not split, so a partition
    value or join key holding a large share of the rows is handled by one
    task. The setting is the cluster's to make; it is only reported.
    """
    enabled = str(spark.conf.get("spark.sql.adaptive.enabled", "true")).lower() == "true"
    if not enabled:
        logger.warning(
            "spark.sql.adaptive.enabled is false: hot partition values and hot join keys "
            "will not be split across tasks"
        )
    return enabled


# Spark otherwise keeps a job's shuffle files until the driver's garbage collector
# finds the job's plan unused, in a short run never.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """While it lasts, a query's shuffle files are removed when the query ends.

    Persisted frames keep theirs. The cluster's own setting stays.
    """
    if _set_by_cluster(spark, SHUFFLE_CLEANUP):
        yield
        return
    old = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, old)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint directory of the session.

    A fresh directory is made only for a local master: on a cluster every
    executor would write to its own disk, so a missing setting raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context, only the session conf
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared directory") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a directory that all executors share")
        configured = tempfile.mkdtemp(prefix="marquee-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint directory."""
    root = checkpoint_root(spark)
    return os.path.join(root, "marquee", f"{name}-{uuid.uuid4().hex[:12]}")
