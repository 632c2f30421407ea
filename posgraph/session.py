"""Session construction and the shared scratch location.

On a cluster the session comes from the platform; ``get_session`` only fills
in settings that are unset.  Scratch data (materialised graph tables, cut
lineage) goes under ``spark.checkpoint.dir`` as the cluster names it; a
private directory is created only when the setting is absent (local runs,
tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings we rely on.  Applied only where the session leaves them unset.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def get_session(master: str | None = None, app_name: str = "posgraph",
                shuffle_partitions: int | None = None,
                extra: dict | None = None, input_bytes: int | None = None) -> SparkSession:
    """The active session if there is one (left as configured), else a new one.

    A new session gets ``DEFAULT_CONF``, ``recommended_conf(input_bytes)`` where
    the input volume is given, and ``extra``; an existing session
    (a cluster's) is never reconfigured, except that a checkpoint directory is
    set when none is named.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    sized = recommended_conf(input_bytes) if input_bytes else {}
    for k, v in (DEFAULT_CONF | sized).items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def recommended_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle sizing for a given input volume (to pass as ``extra`` or cluster conf).

    Initial shuffle partitions are sized so one partition holds about
    ``target_partition_bytes`` of input (at least 200); AQE then coalesces small
    partitions towards the same advisory size and splits skewed ones.
    """
    parts = max(200, int(input_bytes // target_partition_bytes) + 1)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory; a private one is made only if unset on a ``local`` master.

    On a cluster an unset directory raises: executors do not share local folders.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder shared by all executors (master {master})")
        configured = tempfile.mkdtemp(prefix="posgraph-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def checkpoint_dir(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint directory."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "posgraph", f"{name}-{uuid.uuid4().hex[:12]}")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleanup_lock, _cleanup_blocks, _cleanup_before = threading.Lock(), 0, None


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that run in the block go as each query ends.

    Otherwise they lie on the executors' disks until the driver happens to collect garbage, and a
    load of several steps holds the shuffles of all its steps.  The session's own setting is put
    back when the last of nested or concurrent blocks ends.
    """
    global _cleanup_blocks, _cleanup_before
    with _cleanup_lock:
        if not _cleanup_blocks:
            _cleanup_before = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _cleanup_blocks += 1
    try:
        yield
    finally:
        with _cleanup_lock:
            _cleanup_blocks -= 1
            if not _cleanup_blocks:
                spark.conf.unset(_CLEANUP) if _cleanup_before is None else spark.conf.set(_CLEANUP, _cleanup_before)


def matching_paths(spark: SparkSession, glob: str) -> list[str]:
    """The paths that match, through the Hadoop file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(glob)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return [f.getPath().toString() for f in found or []]


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of this library through the Hadoop file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system (works for any cluster store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small new file through the Hadoop file system, whole or not at all; one that exists raises."""
    jvm = spark.sparkContext._jvm
    target, part = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, os.path.join(os.path.dirname(path), f".{uuid.uuid4().hex}")))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(part, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(target) or not fs.rename(part, target):
        fs.delete(part, False)
        raise FileExistsError(f"{path} exists: another writer was first")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file through the Hadoop file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
