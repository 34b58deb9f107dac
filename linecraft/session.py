"""Settings read from the running session."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` or the folder set with ``setCheckpointDir``.
    There is no fallback to a machine-local folder: on a cluster that would
    not survive the loss of an executor or the driver's host.
    """
    d = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        raise RuntimeError(
            "no checkpoint folder: set spark.checkpoint.dir (a shared file system path) "
            "or pass a checkpoint location"
        )
    return d.rstrip("/")


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="linecraft-files-")


def new_folder(spark: SparkSession, name: str) -> str:
    """The path of a folder that no one else uses, under the shared checkpoint
    folder. A session of one process (``local[...]``) that names none gets one of
    its own; a cluster gets the error of :func:`checkpoint_root`."""
    master = spark.sparkContext.master
    alone = master == "local" or master.startswith("local[")
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    root = _own_folder() if alone and not named else checkpoint_root(spark)
    return f"{root}/{name}-{uuid.uuid4().hex}"
