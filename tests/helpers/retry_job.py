"""Run the word count and the partition report over input whose partition 1
fails on its first attempt (as if its executor were lost), with task retries
allowed; print the results as JSON."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession  # noqa: E402

from linecraft.operators import count_words, partition_report  # noqa: E402


def flaky(batches):
    from pyspark import TaskContext

    ctx = TaskContext.get()
    if ctx.partitionId() == 1 and ctx.attemptNumber() == 0:
        raise RuntimeError("simulated loss of the task's executor")
    yield from batches


spark = (
    SparkSession.builder.master("local[2,3]")
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
lines = spark.range(0, 1000, numPartitions=4).selectExpr("concat('w', CAST(id % 7 AS string), ' x') AS line")
unstable = lines.mapInPandas(flaky, lines.schema)
counts = {r.word: r.cnt for r in count_words(unstable).collect()}
report = [r.asDict() for r in partition_report(unstable).select("partition_id", "attempt_number", "row_count").collect()]
print(json.dumps({"counts": counts, "report": report}))
spark.stop()
