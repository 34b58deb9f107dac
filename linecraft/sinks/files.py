"""File sinks. Every write goes through Spark's commit protocol: a failed or
retried task leaves no partial file, and the output appears with a
``_SUCCESS`` marker only when the whole job commits. By default a write to an
existing path fails, as a text-file save does.

``options`` are handed to the one write they are given to; Hadoop file-system
keys (see :func:`linecraft.sources.object_store_options`) reach the file
system this way, as they do for reads."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from ..operators.words import word_count_text

Options = Mapping[str, str] | None


def _writer(df: DataFrame, mode: str, options: Options) -> DataFrameWriter:
    return df.write.mode(mode).options(**dict(options or {}))


def write_pairs_text(counts: DataFrame, path: str, mode: str = "errorifexists", options: Options = None) -> None:
    """``word, cnt`` pairs as text lines ``(word,cnt)``, one part file per
    partition."""
    _writer(word_count_text(counts), mode, options).text(path)


def write_records(
    records: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists", options: Options = None
) -> None:
    """Parsed records as typed columns: ``parquet`` (default) or ``json``
    lines."""
    if fmt not in ("parquet", "json"):
        raise ValueError(f"fmt must be 'parquet' or 'json', not {fmt!r}")
    writer = _writer(records, mode, options)
    if fmt == "json":
        writer.option("ignoreNullFields", "false").json(path)
    else:
        writer.parquet(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists", options: Options = None) -> None:
    """Any rows as JSON lines with null fields kept (used for the partition
    report)."""
    _writer(df, mode, options).option("ignoreNullFields", "false").json(path)


def write_text(
    df: DataFrame, path: str, col: str = "value", mode: str = "errorifexists", options: Options = None
) -> None:
    """One string column as text lines."""
    _writer(df.select(col), mode, options).text(path)


def file_system(spark: SparkSession, path: str, options: Options):
    jvm = spark._jvm
    given = jvm.PythonUtils.toScalaMap(dict(options or {}))
    conf = spark._jsparkSession.sessionState().newHadoopConfWithOptions(given)
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(conf)


def check_targets(spark: SparkSession, paths: list[str], mode: str, options: Options = None) -> None:
    """Raise before anything is written if a job's outputs cannot all be: one
    of them lies in another, or, under ``errorifexists``, one is there."""
    found = []
    for path in paths:
        p, fs = file_system(spark, path, options)
        full = str(fs.makeQualified(p).toString()).rstrip("/")
        if any((full + "/").startswith(x + "/") or (x + "/").startswith(full + "/") for x in found):
            raise ValueError(f"outputs must be different folders, none inside another: {paths}")
        found.append(full)
        if mode in EXIST_MODES and fs.exists(p):
            raise FileExistsError(f"output exists, nothing was written: {path}")


#: Save modes under which an output must not be there yet.
EXIST_MODES = ("errorifexists", "error", "default")


def beside(path: str, name: str) -> str:
    """A new folder next to ``path`` for what a job makes on the way."""
    return f"{path.rstrip('/')}.{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str, options: Options = None) -> None:
    """Delete a folder that a job itself made."""
    p, fs = file_system(spark, path, options)
    fs.delete(p, True)


def publish(spark: SparkSession, moves: list[tuple[str, str]], mode: str, options: Options = None) -> None:
    """Move finished folders to their places, all or none.

    ``moves`` are pairs (finished folder, output path); a folder is moved with a
    rename, so nothing is read or written again. Under ``overwrite`` an old
    output is put aside first. If a move fails, those before it are taken back,
    old outputs return, and the error is raised. Each output gets the
    ``_SUCCESS`` mark of a finished job.
    """
    done: list[tuple] = []

    def rename(fs, a, b):
        if not fs.rename(a, b):
            raise OSError(f"could not move {a.toString()} to {b.toString()}")
        done.append((fs, a, b))

    aside = []
    try:
        for source, target in moves:
            a, fs = file_system(spark, source, options)
            b, _ = file_system(spark, target, options)
            if not fs.exists(a):
                raise FileNotFoundError(f"nothing to move: {source}")
            if fs.exists(b):
                if mode in EXIST_MODES:
                    raise FileExistsError(f"output exists, nothing was moved there: {target}")
                old, _ = file_system(spark, beside(target, "old"), options)
                rename(fs, b, old)
                aside.append((fs, old))
            if b.getParent() is not None:
                fs.mkdirs(b.getParent())
            fs.create(spark._jvm.org.apache.hadoop.fs.Path(a, "_SUCCESS"), True).close()
            rename(fs, a, b)
    except BaseException:
        for fs, a, b in reversed(done):
            fs.rename(b, a)
        raise
    for fs, old in aside:
        fs.delete(old, True)
