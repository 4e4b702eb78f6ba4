"""Session and scratch-location helpers.

The library never hard-codes cluster settings. The only thing it needs from the session is a
shared folder for intermediate tables; it takes ``spark.checkpoint.dir`` as the cluster names it,
and sets a local one only when the session has none (tests, a laptop).
"""

from __future__ import annotations

import logging
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

#: Scratch paths handed out, by application.
_OWNED: dict[str, list[str]] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "warbler",
                  driver_memory: str | None = None) -> SparkSession:
    """A ``local[N]`` session for tests and the bench; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def app_id(spark: SparkSession) -> str:
    return spark.conf.get("spark.app.id", None) or "app"


def default_parallelism(spark: SparkSession) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # sessions without a local context (Spark Connect)
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def shared_root(spark: SparkSession) -> str | None:
    """The folder that ``spark.checkpoint.dir`` names: the same for every application."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root.rstrip("/") if root else None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or a directory set on the context). Only on a
    ``local`` master, where every task sees the driver's disk, is a private folder created and
    registered when neither exists, as tests do; a cluster must name one.
    """
    root = shared_root(spark)
    if root:
        return root
    try:
        sc = spark.sparkContext
    except Exception:  # no local context: the server must name the folder
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    current = sc.getCheckpointDir()
    if current:
        # The context appends an application folder; keep our tables next to it.
        return current.rstrip("/")
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    local = tempfile.mkdtemp(prefix="warbler-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder. The application owns it until
    ``release_scratch``."""
    path = f"{checkpoint_root(spark)}/warbler/{app_id(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _OWNED.setdefault(app_id(spark), []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Removes all scratch paths of this application; frames that read them can't be used any more.
    Returns their number."""
    paths = _OWNED.pop(app_id(spark), [])
    for path in paths:
        delete_path(spark, path)
    return len(paths)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove an intermediate folder this library wrote (any Hadoop file system). Sessions without
    a local context keep it; the folder is then the cluster's to expire."""
    try:
        sc = spark.sparkContext
        hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hpath, True)
    except Exception:  # scratch only: the job's result does not depend on it
        log.warning("could not remove %s", path, exc_info=True)


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
