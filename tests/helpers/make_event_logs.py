"""Run tiny Spark applications that write event logs to argv[1]: a
single-file log, a rolling zstd log and a single-file zstd log."""

import sys

from pyspark.sql import SparkSession

CONFIGS = [
    {"spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"},
    {"spark.eventLog.rolling.enabled": "true", "spark.eventLog.compress": "true",
     "spark.eventLog.compression.codec": "zstd"},
    {"spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "true",
     "spark.eventLog.compression.codec": "zstd"},
]

for i, extra in enumerate(CONFIGS):
    b = (SparkSession.builder.master("local[1]").appName(f"evlog-{i}")
         .config("spark.ui.enabled", "false")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", sys.argv[1]))
    for k, v in extra.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.range(5).count()
    s.stop()
