"""Once-per-partition report of where a job's tasks ran.

Two forms with the same columns. :func:`partition_report` is a frame of its own
and covers every partition. :func:`report_marks` lets the report ride on a pass
that counts words anyway: its marks are counted like words, without Python, and
:func:`report_of_marks` turns their counts into the report of all partitions that
had a row; :func:`report_of_unread` adds the others.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.records import record_json
from . import _report_worker

# Ship the worker function by value: executors then need no copy of this
# package on their Python path.
cloudpickle.register_pickle_by_value(_report_worker)

REPORT_SCHEMA = (
    "partition_id int, attempt_number int, row_count bigint, created_at timestamp, "
    "host string, executor_dirs string, user_dir string, "
    "log_url_stdout string, log_url_stderr string"
)


def partition_report(df: DataFrame, count_rows: bool = True) -> DataFrame:
    """One row per partition of ``df``: partition id, task attempt, row count,
    time, host, executor directories, working directory and log URLs.

    The report is its own DataFrame, not a side effect, so a retried task
    cannot send a second message; ``attempt_number`` shows retries when the
    report is written by the same job that computes ``df``. ``df`` itself is
    the pass-through. Without ``count_rows`` there is no ``row_count`` and the
    worker takes no batch, as the original program, which leaves its iterator
    alone; Spark still reads the partition and drops its rows. No column of ``df`` is read, so a columnar scan reads
    none; the Python side only counts Arrow batches (``mapInArrow``, no
    pandas conversion).
    """
    flag = F.lit(None).cast("boolean").alias("__row")
    if count_rows:
        return df.select(flag).mapInArrow(_report_worker.report_one_partition, REPORT_SCHEMA)
    none = df.select(flag).mapInArrow(_report_worker.report_unread_partition, REPORT_SCHEMA)
    return none.drop("row_count")


#: Marks begin with the one character that no word holds (words are split on it).
MARK = " "

# Values of the task's JVM, taken when the row is computed.
_JVM = {
    "host": "substring_index(java_method('java.net.InetAddress', 'getLocalHost'), '/', 1)",
    "executor_dirs": "java_method('java.lang.System', 'getenv', 'SPARK_EXECUTOR_DIRS')",
    "user_dir": "java_method('java.lang.System', 'getProperty', 'user.dir')",
    "log_url_stdout": "java_method('java.lang.System', 'getenv', 'SPARK_LOG_URL_STDOUT')",
    "log_url_stderr": "java_method('java.lang.System', 'getenv', 'SPARK_LOG_URL_STDERR')",
}
_CLOCK = "cast(java_method('java.lang.System', 'currentTimeMillis') as bigint)"


def report_marks(count_rows: bool = True) -> Column:
    """``array<string>`` of a row's marks, to be computed right on the scan.

    The first row of a partition has a mark with the values of its task as
    JSON; with ``count_rows`` every row has one with the partition's number, so
    that the count of that mark is the partition's rows.
    """
    # The low 33 bits of the id are the row's place in its partition.
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    told = record_json(
        F.spark_partition_id().alias("partition_id"),
        F.expr(_CLOCK).alias("created_ms"),
        # a method that returns nothing gives the text null
        *[F.nullif(F.expr(sql), F.lit("null")).alias(name) for name, sql in _JVM.items()],
    )
    here = F.when(first, F.array(F.concat(F.lit(MARK), told))).otherwise(F.array().cast("array<string>"))
    if not count_rows:
        return here
    return F.concat(here, F.array(F.concat(F.lit(MARK), F.spark_partition_id().cast("string"))))


def report_of_marks(marks: DataFrame, count_rows: bool = True) -> DataFrame:
    """The report from counted marks (``word, cnt``): two rows per partition at
    most. A task's attempt is not known to the JVM's expressions and stays null;
    of a task that ran twice the later values are taken."""
    told = F.from_json(F.substring("word", 2, 1 << 20), "partition_id int, created_ms bigint, " + ", ".join(f"{k} string" for k in _JVM))
    is_told = F.substring("word", 2, 1) == "{"
    parts = marks.select(
        F.when(is_told, told).alias("told"),
        F.when(~is_told, F.col("cnt")).alias("rows"),
        F.when(~is_told, F.substring("word", 2, 20).cast("int")).alias("own"),
    )
    by = F.coalesce("told.partition_id", "own")
    one = parts.groupBy(by.alias("partition_id")).agg(
        F.max_by("told", "told.created_ms").alias("told"), F.sum("rows").alias("row_count")
    )
    report = one.select(
        "partition_id",
        F.lit(None).cast("int").alias("attempt_number"),
        F.col("row_count").cast("bigint").alias("row_count"),
        F.timestamp_millis("told.created_ms").alias("created_at"),
        *[F.col(f"told.{k}").alias(k) for k in _JVM],
    )
    return report if count_rows else report.drop("row_count")


def report_of_unread(df: DataFrame, partitions: list[int], count_rows: bool = True) -> DataFrame:
    """The report of some partitions of ``df`` that are known to hold no row:
    only these run, and they have nothing to read."""
    spark = df.sparkSession

    def tell(_):
        return _report_worker.report_one_partition(iter(()))

    rows = df.select(F.lit(None).cast("boolean").alias("__row")).rdd
    found = [b.to_pylist()[0] for b in spark.sparkContext.runJob(rows, tell, partitions)] if partitions else []
    report = spark.createDataFrame([tuple(r.values()) for r in found], REPORT_SCHEMA)
    return report if count_rows else report.drop("row_count")


def report_json(report: DataFrame) -> DataFrame:
    """``partition_id, json``: each report row as one JSON message, nulls kept,
    time as epoch millis."""
    return report.select(
        "partition_id",
        record_json(
            F.unix_millis("created_at").alias("created_at"),
            "host",
            "executor_dirs",
            "user_dir",
            "log_url_stdout",
            "log_url_stderr",
            "partition_id",
            "attempt_number",
            *(["row_count"] if "row_count" in report.columns else []),
        ).alias("json"),
    )
