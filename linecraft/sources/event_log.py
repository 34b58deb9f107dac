"""Spark application event logs as a line table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import read_lines

# Codecs whose stream framings the text reader does not read.
_UNREADABLE = "*.{lz4,lzf,snappy,lz4.inprogress,lzf.inprogress,snappy.inprogress}"
_NAMES_SHOWN = 10


class UnreadableLogError(ValueError):
    """A folder holds event logs in a codec that cannot be read."""


def read_event_log_lines(
    spark: SparkSession,
    paths: str | Iterable[str],
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """``path string, value string``: one JSON event per line, with the file
    it came from.

    ``paths`` are event-log directories (``spark.eventLog.dir``) or single
    log files. Directories are searched recursively, so single-file logs
    (``<app-id>[.<codec>][.inprogress]``) and rolling logs
    (``eventlog_v2_<app-id>/events_<n>_<app-id>[.<codec>]``) are both read;
    the empty status files of rolling logs add no line and hidden ``.crc``
    files are skipped by the file listing.

    Plain and ``.zstd`` logs (Spark's default codec) are read as text. Logs in
    the ``lz4``, ``lzf`` and ``snappy`` codecs use JVM stream framings that the
    text reader cannot read; if a path holds any, this raises
    :class:`UnreadableLogError` with (some of) their names, and reads none.
    """
    opts = {"recursiveFileLookup": "true"}
    opts.update(options or {})
    src = [paths] if isinstance(paths, str) else list(paths)
    # names only: the content column is not read
    bad = spark.read.format("binaryFile").options(**opts).option("pathGlobFilter", _UNREADABLE).load(src)
    names = [r[0] for r in bad.select(F.col("path")).limit(_NAMES_SHOWN).collect()]
    if names:
        raise UnreadableLogError(f"event logs in an unreadable codec (lz4, lzf or snappy): {', '.join(sorted(names))}")
    return read_lines(spark, src, options=opts, with_path=True)
