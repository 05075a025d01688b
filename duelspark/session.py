"""Session helpers. Library functions never start a session or set a master;
these helpers are for tests, the bench and the driver entry point."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("duelspark")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only in local mode (tests) and only when the setting is absent a private
    folder is created; on a cluster an absent setting is an error."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a shared folder (HDFS/S3/...) for "
                               "checkpoints and stage boundaries; a machine-local folder does not "
                               "survive the loss of an executor")
        configured = tempfile.mkdtemp(prefix="duelspark-ckpt-")  # local mode (tests) only
    sc.setCheckpointDir(configured)
    return configured


# while a stage boundary is written: its shuffle files go when it ends; a generated method that the JVM would only
# interpret (over 8,000 bytes) is not used
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.codegen.hugeMethodLimit": "8000"}
_LOCK, _OPEN = threading.Lock(), {}  # per session: writes under way, the settings before the first of them


@contextmanager
def _writing(spark: SparkSession):
    """``WRITING`` holds inside the block; several threads may be in it."""
    key = spark._jsparkSession.sessionUUID()
    with _LOCK:
        n, before = _OPEN.get(key, (0, None))
        if n == 0:
            before = {k: spark.conf.get(k, None) for k in WRITING}
            for k, v in WRITING.items():
                spark.conf.set(k, v)
        _OPEN[key] = (n + 1, before)
    try:
        yield
    finally:
        with _LOCK:
            n, before = _OPEN.pop(key)
            if n > 1:
                _OPEN[key] = (n - 1, before)
            else:
                for k, v in before.items():
                    spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Stage boundary: write ``df`` once as Parquet under the cluster's
    checkpoint folder and read it back. Unlike ``checkpoint()`` the result
    keeps column pruning and filter pushdown for every later consumer, and
    it survives the loss of any executor. The shuffles behind it are needed no
    more and their files are removed at once, not at some later collection."""
    base = checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/duelspark/{label}-{uuid.uuid4().hex}"
    with _writing(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def kept(df: DataFrame):
    """Keep ``df`` (MEMORY_AND_DISK) across several actions inside the block;
    release it afterwards only if this block was the one that kept it."""
    from pyspark.storagelevel import StorageLevel
    mine = not df.is_cached
    if mine:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        if mine:
            df.unpersist()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
