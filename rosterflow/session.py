"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "rosterflow", shuffle_partitions: str = "8") -> SparkSession:
    """Session for tests and the local bench; a cluster job brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the workers once per application, for functions that run there.

    Not needed where the package is installed on every node, and harmless there.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="rosterflow-code-"), "rosterflow"), "zip", os.path.dirname(root), os.path.basename(root))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can read, named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"rosterflow-{application}-")


# a thread has its own: a stream's batches run beside the caller's queries and must not delete what these stage
_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def staged_tables(spark: SparkSession) -> Iterator[None]:
    """Delete what a job stages inside the block when it ends, with all its outcomes read.

    Frames that still read staged tables must be written or collected before that.
    """
    own: list[str] = []
    outer = _staged.set(own)
    try:
        yield
    finally:
        _staged.reset(outer)
        paths = spark._jvm.org.apache.hadoop.fs
        for path in map(paths.Path, own):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if (own := _staged.get()) is not None:
        own.append(path)
    return path


def materialise(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Cuts the lineage at a table that outlives any executor, and later readers
    prune its columns and partitions.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
