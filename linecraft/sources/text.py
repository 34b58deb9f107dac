"""Line-oriented text sources."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import quote
from ..functions.text import split_lines


def read_lines(
    spark: SparkSession,
    paths: str | Iterable[str],
    options: Mapping[str, str] | None = None,
    with_path: bool = False,
) -> DataFrame:
    """One row per line of text files: ``value string`` (``path`` first when
    ``with_path``).

    ``paths`` may be files, directories or globs on any Hadoop file system.
    ``.gz``/``.bz2`` files are decompressed by suffix (a ``.gz`` file is one
    task; see :func:`linecraft.operators.layout.spread`). ``options`` are
    handed to this read only; Hadoop file-system keys such as
    ``fs.s3a.access.key``, ``fs.s3a.secret.key``, ``fs.s3a.session.token`` or
    ``fs.s3a.aws.credentials.provider`` reach the file system this way.
    Hadoop caches one file-system object per scheme and host, so for
    credentials that change while the application runs also pass
    ``fs.s3a.impl.disable.cache=true``.
    """
    reader = spark.read
    if options:
        reader = reader.options(**dict(options))
    src = [paths] if isinstance(paths, str) else list(paths)
    df = reader.text(src)
    if with_path:
        return df.select(F.col("_metadata.file_path").alias("path"), "value")
    return df


def object_store_options(
    access_key: str,
    secret_key: str,
    session_token: str | None = None,
    scheme: str = "s3a",
    fresh_file_system: bool = False,
) -> dict[str, str]:
    """Per-read options for an object store with given (temporary) keys.

    Getting the keys is the caller's business; this only names them the way
    the Hadoop connector expects. With a session token the temporary-keys
    provider is selected. ``fresh_file_system`` turns off Hadoop's
    file-system cache for the scheme, so keys that rotate while the
    application runs are not shadowed by the first ones used.
    """
    opts = {
        f"fs.{scheme}.access.key": access_key,
        f"fs.{scheme}.secret.key": secret_key,
    }
    if fresh_file_system:
        opts[f"fs.{scheme}.impl.disable.cache"] = "true"
    if session_token is not None:
        opts[f"fs.{scheme}.session.token"] = session_token
        opts[f"fs.{scheme}.aws.credentials.provider"] = (
            "org.apache.hadoop.fs.s3a.TemporaryAWSCredentialsProvider"
        )
    return opts


def lines_of(df: DataFrame, text_col: str = "text", keep: Iterable[str] = ()) -> DataFrame:
    """One row per line of a text column, as if each value were a file.

    Output: the ``keep`` columns and ``line string``. Line breaks follow the
    text-file reader (see :func:`linecraft.functions.split_lines`).
    """
    return df.select(*keep, F.explode(split_lines(quote(text_col))).alias("line"))


def read_table(spark: SparkSession, data_dir: str, name: str, schema: str | None = None) -> DataFrame:
    """A parquet table ``<data_dir>/<name>.parquet``.

    With ``schema`` (a DDL string, may list only the needed columns) the
    reader skips schema inference, which otherwise reads file footers before
    the query is even planned.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")
