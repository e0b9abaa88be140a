"""Session defaults and the shared scratch location."""

from __future__ import annotations

import functools
import os
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("metricloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """All instants in this library are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is only made up for a local master: on a cluster the
    executors could not see it, so an unset folder is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _own_folder()


@functools.cache
def _own_folder() -> str:
    """One folder for the life of this process; the setting itself can't be changed at run time."""
    return tempfile.mkdtemp(prefix="metricloom-")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder below the caller's own root, in whatever store the path names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one run below the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def side_by_side(spark: SparkSession, calls: Mapping[str, Callable[[], object]]) -> dict[str, object]:
    """What independent calls return, by name; their Spark jobs share the cluster.

    For fits that leave most cores idle. The first call in order that fails raises its error.
    """
    target = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max(len(calls), 1)) as pool:
        begun = {name: pool.submit(target(call)) for name, call in calls.items()}
        return {name: running.result() for name, running in begun.items()}


#: Whether the files of a shuffle go with the query that wrote them; by default they stay until the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _writing = threading.Lock(), [0, "false"]  # writes that run now, and the setting before them


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries inside are removed when they end; writes of several threads share the setting."""
    with _lock:
        if not _writing[0]:
            _writing[1] = spark.conf.get(_CLEANUP, "false")
            spark.conf.set(_CLEANUP, "true")
        _writing[0] += 1
    try:
        yield
    finally:
        with _lock:
            _writing[0] -= 1
            if not _writing[0]:
                spark.conf.set(_CLEANUP, _writing[1])


def written_once(df: DataFrame, label: str, instead_of: Sequence[DataFrame] = ()) -> DataFrame:
    """Write a table to the shared folder and read it back.

    For results that several branches of a query read: each branch then scans only its own
    columns instead of repeating the joins, and a lost executor costs a re-read, not a
    recomputation. What was shuffled for it leaves the disk at once. ``instead_of`` names tables
    written before that nobody reads any more; they go as soon as this one is there.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with _shuffles_freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    for table in instead_of:
        remove_path(spark, table.__dict__["_written_to"])
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["_written_to"] = path
    return out
