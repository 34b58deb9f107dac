"""Partition layout helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Suffixes of compressed text that Hadoop cannot split: one file, one task.
UNSPLITTABLE_SUFFIXES = (".gz", ".deflate", ".lz4", ".snappy", ".zst", ".zstd")
DEFAULT_MAX_TASK_BYTES = 128 * 1024 * 1024


def _oversized(max_task_bytes: int):
    name = F.lower(F.col("_metadata.file_name"))
    unsplittable = F.lit(False)
    for suffix in UNSPLITTABLE_SUFFIXES:
        unsplittable = unsplittable | name.endswith(suffix)
    return unsplittable & (F.col("_metadata.file_size") > max_task_bytes)


def spread(df: DataFrame, max_task_bytes: int = DEFAULT_MAX_TASK_BYTES) -> DataFrame:
    """Spread the lines of oversized unsplittable files, and of no others.

    A gzip file is read by a single task however large it is. ``df`` is a scan
    of files (narrow steps may follow it); the rows of unsplittable files of
    more than ``max_task_bytes`` are dealt to other tasks by their position in
    the scan (stable when a task is retried, no hot key, no sort), and all
    other files are read in place beside them. Without such a file ``df`` comes
    back as it is, and splittable text is left to the scan's own splits.

    The two sides are the same scan under a filter on the files' size and
    suffix, so read options stay with it, no name is read back, and the files
    are listed once more by Spark's own planning only.
    """
    big = _oversized(max_task_bytes)
    large = df.where(big)
    if not _has_files(large):
        return df
    return df.where(~big).unionByName(large.repartition(F.monotonically_increasing_id()))


def _has_files(df: DataFrame) -> bool:
    """Whether a file scan has any file left after its filters on file metadata.

    Spark drops the other files when it plans the scan, so this is the number
    of planned partitions; no job runs.
    """
    return df._jdf.queryExecution().toRdd().getNumPartitions() > 0


def widen(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Deal a scan of too few tasks to ``min_partitions`` (default: twice the
    cluster's default parallelism).

    For sources whose splits are given by the file, such as a parquet file with
    one row group, before heavy per-row work. A scan that is wide enough
    comes back as it is, so a large table pays no shuffle. Rows are dealt by
    their position in the scan.
    """
    n = min_partitions or 2 * df.sparkSession.sparkContext.defaultParallelism
    if df._jdf.queryExecution().toRdd().getNumPartitions() >= n:
        return df
    return df.repartition(n, F.monotonically_increasing_id())
