"""Session set-up and the shared folder that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scratch scopes", default=())


def build_session(name: str = "tidemark", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  options: dict[str, str] | None = None) -> SparkSession:
    """A session with adaptive execution on; sizes are left to the cluster unless given."""
    builder = (SparkSession.builder.appName(name)
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (options or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode.

    Also makes sure ``DataFrame.checkpoint()`` writes there. A folder of the driver's own
    disk is refused on a cluster.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) \
        or context.getConf().get("spark.checkpoint.dir") \
        or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="tidemark-")
    if folder.startswith("file:") and not context.master.startswith("local"):
        raise RuntimeError(f"executors of a cluster can't share {folder}")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def application_folder(spark: SparkSession) -> str:
    """The folder below the shared one that holds all this application stages.

    It is removed when the driver's JVM ends, also after a failure: returned frames read staged
    tables for as long as the application lives, and nothing can read them after.
    """
    path = f"{shared_folder(spark)}/tidemark/{spark.sparkContext.applicationId}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        files.mkdirs(folder)
        files.deleteOnExit(folder)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the application's folder."""
    path = f"{application_folder(spark)}/{label}-{uuid.uuid4().hex}"
    for paths in _scopes.get():
        paths.append(path)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder, if it is there, in whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Removes what is staged inside the block when it ends, also by failure.

    No frame that reads a staged table may be used after the block, so results are
    written before it ends.
    """
    paths: list[str] = []
    token = _scopes.set((*_scopes.get(), paths))
    try:
        yield paths
    finally:
        _scopes.reset(token)
        for path in paths:
            remove_folder(spark, path)
