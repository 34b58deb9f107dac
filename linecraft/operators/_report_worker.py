"""The per-partition function of the partition report.

This module is pickled by value (see ``partition_report.py``), so executors
run it without having the package installed; it must only import the
standard library, pyarrow and pyspark, and only inside the function.
"""


def report_unread_partition(batches):
    # The report of a partition without taking any of its batches.
    return report_one_partition(iter(()))


def report_one_partition(batches):
    # Runs in the Python worker of each task, once per partition (also for an
    # empty one). Only a null flag column crosses from the JVM, as Arrow
    # batches that are counted, never converted.
    import datetime
    import os
    import socket

    import pyarrow as pa
    from pyspark import TaskContext

    ctx = TaskContext.get()
    created = datetime.datetime.now(datetime.timezone.utc)
    rows = 0
    for batch in batches:
        rows += batch.num_rows
    env = os.environ
    schema = pa.schema(
        [
            ("partition_id", pa.int32()),
            ("attempt_number", pa.int32()),
            ("row_count", pa.int64()),
            ("created_at", pa.timestamp("us", tz="UTC")),
            ("host", pa.string()),
            ("executor_dirs", pa.string()),
            ("user_dir", pa.string()),
            ("log_url_stdout", pa.string()),
            ("log_url_stderr", pa.string()),
        ]
    )
    values = [
        ctx.partitionId(),
        ctx.attemptNumber(),
        rows,
        created,
        socket.gethostname(),
        env.get("SPARK_EXECUTOR_DIRS"),
        os.getcwd(),
        env.get("SPARK_LOG_URL_STDOUT"),
        env.get("SPARK_LOG_URL_STDERR"),
    ]
    yield pa.RecordBatch.from_arrays(
        [pa.array([v], type=f.type) for v, f in zip(values, schema)], schema=schema
    )
