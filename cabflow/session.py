"""Session construction and the shared scratch location.

All staging output goes below ``spark.checkpoint.dir`` (a folder every executor can
reach on a cluster). Only when that setting is absent, as in local tests, a private
directory is created and registered.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "cabflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the options the jobs rely on (UTC zone, AQE, dynamic overwrite).

    ``shuffle_partitions`` defaults to the env var ``SPARK_SQL_SHUFFLE_PARTITIONS``
    or 96; AQE coalesces small partitions at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(
        shuffle_partitions or os.environ.get("SPARK_SQL_SHUFFLE_PARTITIONS", "96")
    )
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # getOrCreate may hand back an existing session: make the SQL options hold anyway.
    for k, v in conf.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder (``spark.checkpoint.dir``). Where none is configured a private
    one is made, but only for a local master: on a cluster a machine-local folder would leave
    parts of a table on machines that others cannot read."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="cabflow-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, name: str, root: str | None = None) -> str:
    """A fresh, unique path below the checkpoint folder (or ``root``) for one staged table. What is still there
    when the driver ends is deleted then."""
    root = (root or checkpoint_root(spark)).rstrip("/")
    path = f"{root}/cabflow/{name}-{uuid.uuid4().hex[:12]}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this run wrote, on whatever file system it is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


# Target bytes of input per shuffle partition when the job sizes itself from its input. Beyond
# ``MAX_WIDTH`` partitions their size grows instead: the bookkeeping of a shuffle is the product
# of its two sides, and Spark takes at most 100,000 buckets.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024
MAX_WIDTH = 50_000
# Staged tables: larger files, fewer of them.
TARGET_BUCKET_BYTES = 1024 * 1024 * 1024
MAX_BUCKETS = 50_000
MAX_SPLIT_BYTES = 1024 * 1024 * 1024


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of files matching ``paths`` (globs allowed), from file-system metadata
    only (no data is read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        for st in fs.globStatus(p) or []:
            total += fs.getContentSummary(st.getPath()).getLength()
    return int(total)


# Columnar input: a byte of Parquet becomes some ten bytes of shuffled rows, and far more in a sort. Partitions of
# 6 MB of it are about one advisory partition of adaptive execution. The dedup sorts a whole split before its shuffle:
# measured, one of 8 MB takes 287 MB of execution memory, one of 30 MB 959 MB.
TARGET_COLUMNAR_BYTES = 6 * 1024 * 1024
COLUMNAR_SPLIT_BYTES = 8 * 1024 * 1024
INITIAL_WIDTH = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SPLIT = "spark.sql.files.maxPartitionBytes"


def width_for_columnar(nbytes: int, current: int) -> int:
    """Shuffle partitions for that much Parquet input; never below ``current``, at most ``MAX_WIDTH``."""
    return max(current, min(-(-nbytes // TARGET_COLUMNAR_BYTES), MAX_WIDTH))


def widen(spark: SparkSession, nbytes: int) -> int:
    """Let lazy queries over that much Parquet input start with enough shuffle partitions; returns how many.
    Adaptive execution merges the small ones, but splits none: with the fixed default a partition, and what a task
    reads, sorts and spills, would grow with the input. Only ever raised; ``spark.sql.shuffle.partitions`` stays."""
    current = int(spark.conf.get(INITIAL_WIDTH, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    width = width_for_columnar(nbytes, current)
    if width > current:
        spark.conf.set(INITIAL_WIDTH, str(width))
    return width


def split_for_columnar(nbytes: int, current: int) -> int:
    """Bytes of an input split for that much Parquet input; never above ``current``, and not more than ``MAX_WIDTH``
    splits because of it."""
    return min(current, max(COLUMNAR_SPLIT_BYTES, -(-nbytes // MAX_WIDTH)))


@dataclass(frozen=True)
class Sizes:
    width: int  # shuffle partitions
    buckets: int  # of the staged feeds
    split_bytes: int  # of an input split


def sizes_for(nbytes: int, current: int) -> Sizes:
    """Shuffle width, bucket count and split size for that much input; never below ``current``
    partitions, never more than Spark or its bookkeeping takes."""
    width = min(max(current, -(-nbytes // TARGET_PARTITION_BYTES)), max(current, MAX_WIDTH))
    buckets = min(max(current, -(-nbytes // TARGET_BUCKET_BYTES)), MAX_BUCKETS)
    split = min(max(TARGET_PARTITION_BYTES, -(-nbytes // MAX_WIDTH)), MAX_SPLIT_BYTES)
    return Sizes(width, buckets, split)


@contextmanager
def configured(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Run a block with these settings, and restore the session's own after it."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# Spark deletes the shuffle files of a query when the query ends, not when its objects happen to be collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Run a write whose result replaces the work before it: its shuffle files go with it."""
    with configured(spark, {CLEANUP: "true"}):
        yield


@contextmanager
def sized_for(spark: SparkSession, sizes: Sizes | None) -> Iterator[None]:
    """Run a block with these settings, and restore the session's own after it."""
    if sizes is None:
        yield
        return
    with configured(spark, {
        "spark.sql.shuffle.partitions": str(sizes.width),
        INITIAL_WIDTH: str(sizes.width),
        "spark.sql.files.maxPartitionBytes": str(sizes.split_bytes),
    }):
        yield
