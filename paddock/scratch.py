"""Tables written once so that later stages do not recompute their lineage.

The folder is one for the application below what the cluster names in
``spark.checkpoint.dir``, which every executor can reach.  Only a local session
without that setting gets a folder on the machine.  Either goes when the driver ends.
"""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"

_local_folder: str | None = None
_shared_folders: set[str] = set()
_made: list[str] | None = None


def _local() -> str:
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="paddock-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


def root(spark: SparkSession) -> str:
    """Shared scratch folder of this session."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if folder:
        return _shared(spark, f"{folder.rstrip('/')}/paddock-{spark.sparkContext.applicationId}")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    return _local()


def _shared(spark: SparkSession, folder: str) -> str:
    """Makes the folder of this application, which its driver deletes at the end."""
    if folder not in _shared_folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _shared_folders.add(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path that no other query of this or another session uses."""
    path = f"{root(spark)}/{name}-{uuid.uuid4().hex}"
    if _made is not None:
        _made.append(path)
    return path


@contextmanager
def recorded(paths: list[str]) -> Iterator[list[str]]:
    """Adds to ``paths`` what is stored meanwhile, so that the caller can release it."""
    global _made
    before, _made = _made, paths
    try:
        yield paths
    finally:
        _made = before


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored tables that nothing reads any more, and forget their paths."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    paths.clear()


def reads(df: DataFrame, paths: list[str]) -> bool:
    """Whether ``df`` still depends on any of these stored tables."""
    folders = [p.rsplit("/", 1)[1] for p in paths]
    return bool(folders) and any(f"/{folder}/" in file for file in df.inputFiles() for folder in folders)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files: nothing reads them after the write.

    Otherwise they stay until the driver's JVM collects garbage, which can be after the job.
    """
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def collect_garbage(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files, caches and broadcasts that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table and read it back.

    The copy survives the loss of executors and lets every consumer read only
    the columns it needs.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(make: Callable[[], DataFrame], name: str, *done: str) -> tuple[DataFrame, str]:
    """The table that ``make`` sets up, stored, and its path; what it stored on the way goes.

    So do the tables at the paths ``done``, which only it reads.
    """
    with recorded([]) as passing:
        df = make()
    with recorded([]) as kept:
        table = materialize(df, name)
    release(df.sparkSession, [*passing, *done])
    if _made is not None:
        _made.append(kept[0])
    return table, kept[0]


# bytes of values that every task may hold of a table
SMALL = 64 * 2**20


def small(df: DataFrame, most: int = SMALL) -> DataFrame:
    """``df`` for a broadcast if its counted rows are few, else as it is.

    A stored table is counted from its footers.  Texts count for 40 bytes, other values for 8.
    """
    width = sum(40 if kind == "string" else 8 for _, kind in df.dtypes)
    return F.broadcast(df) if df.count() * width <= most else df
