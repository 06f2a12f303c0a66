"""Shared storage for intermediate results.

Everything that has to outlive an executor is written as parquet below the
folder named by ``spark.checkpoint.dir``.  Only a local session that names none
gets a folder of its own.
"""

from __future__ import annotations

import sys
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from the session settings."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="echoloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/echoloom/{label}-{uuid.uuid4().hex}"


# Shuffle files of a job are of no use once its result is stored.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_open = threading.local()  # scopes of each thread, the innermost last


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that the block stores when it ends, but those that it stores as ``kept``.

    What the block returns has to rest on kept tables only.
    """
    scopes = _open.__dict__.setdefault("scopes", [])
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            _delete(spark, path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Let jobs that the block starts drop their shuffle files as they end."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def is_stored(df: DataFrame) -> bool:
    """Whether ``df`` is a table of :func:`materialize`."""
    return df in _paths


def release(*stored: DataFrame) -> None:
    """Delete tables of :func:`materialize` that nothing reads any more."""
    for df in stored:
        _delete(df.sparkSession, _paths.pop(df))


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df: DataFrame, label: str, kept: bool = False) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage and survives executor loss.

    Within :func:`released` the table lives as long as the block, a ``kept`` one as long as
    the block around it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    scopes = _open.__dict__.get("scopes", [])[: -1 if kept else None]
    if scopes:
        scopes[-1].append(path)
    with freed_shuffles(spark):
        df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    _paths[stored] = path
    return stored


def materialize_counted(
    df: DataFrame, label: str, counted: Column | None = None, kept: bool = False
) -> tuple[DataFrame, int]:
    """:func:`materialize` and the number of rows (where ``counted`` holds), from the same job."""
    seen = Observation(label)
    rows = F.count(F.lit(1)) if counted is None else F.count_if(counted)
    stored = materialize(df.observe(seen, rows.alias("rows")), label, kept)
    return stored, seen.get["rows"]


def send_with_tasks(module: str) -> None:
    """Send a module's functions along with the tasks, so executors need no install."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
