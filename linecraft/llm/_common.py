"""Shared helpers: tables in the cluster's shared folder, whole-table reads."""

from __future__ import annotations

import ctypes
import functools
import gc
import sys
import tempfile
import types
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="linecraft-shared-")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: the one ``spark.checkpoint.dir`` names.

    Where the setting is absent, a single-process session (``local[...]``,
    as in tests) gets a temporary folder of its own; a cluster gets an error,
    since a machine-local folder would not be seen by the other executors.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return _own_folder()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    path = f"{shared_root(df.sparkSession)}/linecraft-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._linecraft_path = path
    return back


def release(*frames: DataFrame | None) -> None:
    """Delete tables written by ``stored`` that nothing will read again."""
    for df in frames:
        path = getattr(df, "_linecraft_path", None)
        if path is not None:
            jvm = df.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            conf = df.sparkSession._jsc.hadoopConfiguration()
            p.getFileSystem(conf).delete(p.getParent(), True)


def process_cache() -> dict:
    """Objects that live as long as this Python process.

    Task functions are shipped by value and get fresh globals with every task;
    what is costly to load is kept here instead, once per worker.
    """
    name = "linecraft_process_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def release_memory() -> None:
    """Give freed memory back to the system. A worker process waits idle after
    its task, several of them in an executor, with all that it has not given
    back."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


def tidy(run):
    """A mapInArrow function that ends by releasing memory."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()

    return tidied


def table(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    """Columns of one whole table of a data directory."""
    return spark.read.schema(schema).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


DOCUMENTS = "doc_id bigint, text string"
