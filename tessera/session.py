"""Session construction and shared-storage locations.

Scratch tables and checkpoints live under the directory the cluster names in
``spark.checkpoint.dir``.  There is no fallback to a machine-local folder: a
session without that setting is refused as soon as something must be written.
``build_session`` sets a folder of its own only for a local master where
the setting is absent (tests, the bench).
"""

from __future__ import annotations

import hashlib
import tempfile
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Concurrent jobs share the cores by pool; without pools this is first come, first served.
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Remove checkpoint files once their DataFrames are garbage collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app: str = "tessera",
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    if master and master.startswith("local") and "spark.checkpoint.dir" not in conf:
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="tessera-ckpt-")
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint directory, registered with the context."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError(
                "spark.checkpoint.dir is not set: point it to a folder shared by all executors "
                "(checkpoints and written intermediate tables go there)"
            )
        # One machine, one folder: driver and executors are the same process.
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path for a written intermediate table.

    Tables of one application share the folder
    ``<checkpoint dir>/tables/<application id>/``; ``clear_scratch`` removes it.
    """
    return f"{_tables_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _tables_folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}"


def _hadoop_path(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster's file system (local, HDFS, object stores)."""
    fs, jpath = _hadoop_path(spark, path)
    return bool(fs.exists(jpath))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written table through the cluster's file system."""
    fs, jpath = _hadoop_path(spark, path)
    fs.delete(jpath, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's written intermediate tables.

    Call it when no result that reads them is needed any more."""
    remove(spark, _tables_folder(spark))
    with _LOCK:
        _TABLES.clear()


def run_in_pools(spark: SparkSession, work: list[Callable], cost: list[float], parallelism: int, name: str = "work") -> list:
    """Results of ``work`` in the order given, from at most ``parallelism`` driver threads.

    The dearest (largest ``cost``) begin first, so that no long one is left alone at the end.  Every
    thread submits to a scheduler pool of its own: under ``spark.scheduler.mode=FAIR`` the running
    pieces share the cores evenly, otherwise the pools have no effect.  Threads
    inherit the caller's local properties (job group, description, tags).  The first failure is
    raised once the running pieces have ended; pieces not yet begun are dropped.
    """
    if not work:
        return []
    sc, slots = spark.sparkContext, threading.local()
    numbers, run = iter(range(max(1, min(parallelism, len(work))))), uuid.uuid4().hex[:8]

    def one(piece: Callable):
        if not hasattr(slots, "pool"):
            with _LOCK:
                slots.pool = f"{name}-{run}-{next(numbers)}"
        sc.setLocalProperty("spark.scheduler.pool", slots.pool)
        return piece()

    threads = ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(work))))
    try:
        order = sorted(range(len(work)), key=lambda i: (-cost[i], i))
        running = {i: threads.submit(inheritable_thread_target(spark)(one), work[i]) for i in order}
        return [running[i].result() for i in range(len(work))]
    finally:
        threads.shutdown(wait=True, cancel_futures=True)


_TABLES: dict[tuple[str, str], str] = {}
_LOCK = threading.RLock()


def materialized(spark: SparkSession, key: str, build, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``build()`` once per application to the shared folder and read it back.

    Used for derived inputs that many queries read (like a stored source
    table): later readers get a plain parquet scan with filter pushdown and
    column pruning instead of recomputing the derivation.  Safe under driver
    threads: a table is written by the first caller, others wait for it.
    """
    k = (spark.sparkContext.applicationId, key)
    with _LOCK:
        path = _TABLES.get(k)
        if path is None or not path_exists(spark, path + "/_SUCCESS"):
            name = "".join(c if c.isalnum() else "_" for c in key.split(":")[0])
            path = scratch_path(spark, f"{name}-{hashlib.md5(key.encode()).hexdigest()[:8]}")
            w = build().write.mode("overwrite")
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.parquet(path)
            _TABLES[k] = path
    return spark.read.parquet(path)
